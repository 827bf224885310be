"""Position of a value among sorted constants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Up to this many constants the comparison is written out, which stays in generated code.
_WRITTEN_OUT = 32


def how_many_reached(constants: Sequence[float], value: Column, strictly: bool = False) -> Column:
    """Number of constants that are not above the value (or strictly below it)."""
    if not constants:
        return F.lit(0)
    marks = [F.lit(float(c)) for c in constants]
    if len(marks) > _WRITTEN_OUT:
        test = (lambda c: c < value) if strictly else (lambda c: c <= value)
        return F.size(F.filter(F.array(*marks), test))
    hits = [((m < value) if strictly else (m <= value)).cast("int") for m in marks]
    return F.coalesce(sum(hits[1:], hits[0]), F.lit(0))
