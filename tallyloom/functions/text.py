"""Text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def replace_first(col: Column, literal: str, by: str) -> Column:
    """Replace only the first occurrence of a literal."""
    head = F.substring_index(col, literal, 1)
    tail = F.substr(col, F.char_length(head) + F.lit(len(literal) + 1))
    return F.when(F.contains(col, F.lit(literal)), F.concat(head, F.lit(by), tail)).otherwise(col)


def piece(col: Column, separator: str, index: int) -> Column:
    """Piece of a split text; ``index`` counts from 0, negative counts from the end."""
    parts = F.split(col, re.escape(separator))
    if index >= 0:
        return F.get(parts, F.lit(index))
    return F.try_element_at(parts, F.lit(index))


def first_match(col: Column, pattern: str) -> Column:
    """First match of a pattern, missing when nothing matches."""
    return F.regexp_substr(col, F.lit(pattern))


def join_text(*cols: Column, sep: str = "") -> Column:
    """Concatenation in which one missing part makes the result missing."""
    parts: list[Column] = []
    for col in cols:
        if parts and sep:
            parts.append(F.lit(sep))
        parts.append(col.cast("string"))
    return F.concat(*parts)


def template(text: str, **cols: Column) -> Column:
    """``template("Customer: {who}", who=col)``; a missing part makes the result missing."""
    parts: list[Column] = []
    for chunk in re.split(r"(\{\w+\})", text):
        if chunk.startswith("{") and chunk[1:-1] in cols:
            parts.append(cols[chunk[1:-1]].cast("string"))
        elif chunk:
            parts.append(F.lit(chunk))
    return F.concat(*parts)


def matches(col: Column, pattern: str) -> Column:
    """Case-insensitive pattern test as 0.0/1.0; missing text counts as no match."""
    return F.coalesce(F.lower(col).rlike(pattern).cast("double"), F.lit(0.0))
