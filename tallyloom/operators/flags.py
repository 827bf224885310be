"""Keyword flags: a rule table of patterns turned into 0/1 columns in one projection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import matches

# Bicycle component rules, flag name -> pattern tested on the lower-cased text.
DERAILLEUR_RULES = {
    "shimano dura-ace": "shimano dura-ace ",
    "shimano ultegra": "shimano ultegra ",
    "shimano 105": "shimano 105 ",
    "shimano tiagra": "shimano tiagra ",
    "Shimano sora": "shimano sora",
    "shimano deore": "shimano deore(?! xt)",
    "shimano slx": "shimano slx",
    "shimano grx": "shimano grx",
    "Shimano xt": "shimano deore xt |shimano xt ",
    "Shimano xtr": "shimano xtr",
    "Shimano saint": "shimano saint",
    "SRAM red": "sram red",
    "SRAM force": "sram force",
    "SRAM rival": "sram rival",
    "SRAM apex": "sram apex",
    "SRAM xx1": "sram xx1",
    "SRAM x01": "sram x01|sram xo1",
    "SRAM gx": "sram gx",
    "SRAM nx": "sram nx",
    "SRAM sx": "sram sx",
    "Campagnolo potenza": "campagnolo potenza",
    "Campagnolo super record": "campagnolo super record",
}
SHIFTER_RULES = {
    "shimano nexus": "shimano nexus",
    "shimano alfine": "shimano alfine",
}


def keyword_flags(df: DataFrame, name: str, rules: Mapping[str, str]) -> DataFrame:
    """One 0/1 column per rule; missing text gives 0."""
    return df.withColumns({flag: matches(F.col(name), pattern) for flag, pattern in rules.items()})


def component_flags(df: DataFrame, derailleur: str = "Rear Derailleur", shifter: str = "Shift Lever") -> DataFrame:
    """Flags of both component columns; the texts are dropped, missing numbers become 0."""
    flagged = keyword_flags(keyword_flags(df, derailleur, DERAILLEUR_RULES), shifter, SHIFTER_RULES)
    return flagged.drop(derailleur, shifter).na.fill(0)
