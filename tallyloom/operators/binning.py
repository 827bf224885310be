"""Numbers to labelled bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import case_when
from .quantiles import cut_points

# Price bin borders, upper border included, and bin labels.
PRICE_BORDERS = (2.77, 4.05)
PRICE_LABELS = ("low", "medium", "high")

# Probabilities from which data-driven price borders are taken.
PRICE_PROBS = (0.0, 0.33, 0.66, 1.0)


def bin_by(col: Column, borders: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the first border that is not below the value; missing values get the last label."""
    if len(labels) != len(borders) + 1:
        raise ValueError("one label more than borders is needed")
    return case_when([(col <= F.lit(b), l) for b, l in zip(borders, labels)], labels[-1])


def bin_by_quantile(df: DataFrame, name: str, out: str, probs=PRICE_PROBS, labels=PRICE_LABELS) -> DataFrame:
    """Bins whose borders are inner quantiles of the column itself."""
    borders = cut_points(df, name, probs)[1:-1]
    return df.withColumn(out, bin_by(F.col(name), borders, labels))
