"""Code dictionaries written as a two-column sheet, and the readable frame made with them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import piece, replace_first
from . import columns
from .factors import levels_first_seen, levels_sorted, relevel
from .joins import decode
from .rows import carry_down

# Preferred order of levels in the employee table.
LEVEL_ORDER = {
    "BusinessTravel": ("Non-Travel", "Travel_Rarely", "Travel_Frequently"),
    "MaritalStatus": ("Single", "Married", "Divorced"),
}

# Fixed value: what stands between code and label in a dictionary cell such as "1 'Low'".
SEPARATOR = " '"


def parse_dictionary(sheet: DataFrame, name: str, entry: str, position: str) -> DataFrame:
    """Sheet rows to ``(column_name, key, value, position)``.

    The column name is given only on the first row of its block and is carried
    down in the order of ``position``; rows without an entry are dropped.
    """
    filled = carry_down(sheet, name, [position])
    text = F.col(entry)
    return filled.filter(text.isNotNull()).select(
        F.col(name).alias("column_name"),
        piece(text, SEPARATOR, 0).try_cast("double").alias("key"),
        replace_first(piece(text, SEPARATOR, 1), "'", "").alias("value"),
        position,
    )


def readable(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Codes replaced by labels, columns in name order."""
    return columns.sort_columns(decode(df, dictionary))


def readable_levels(
    df: DataFrame, dictionary: DataFrame, order: Mapping[str, Sequence[str]] = LEVEL_ORDER, position: str = "position"
) -> dict[str, DataFrame]:
    """Levels table of every text column of a readable frame.

    Decoded columns keep dictionary order, other text columns are sorted, and
    the named ones are put in the given order.
    """
    coded = {r["column_name"] for r in dictionary.select("column_name").distinct().collect()}
    out = {}
    for name in columns.textual(df):
        if name in coded:
            block = dictionary.filter(F.col("column_name") == name)
            out[name] = levels_first_seen(block, "value", position)
        else:
            out[name] = levels_sorted(df, name)
        if name in order:
            out[name] = relevel(out[name], order[name])
    return out
