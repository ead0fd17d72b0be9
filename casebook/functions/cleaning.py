"""Text cleaning: placeholder text to NULL, unit stripping, text lists to arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that mean "no value".
NULL_TEXTS = ("", "null")


def null_text(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.when(~F.trim(c).isin(*NULL_TEXTS), c)


def to_int_array(c) -> Column:
    """'3, 12' -> [3, 12]; NULL/'' /'null' -> NULL (STRING_TO_ARRAY + ::INT[])."""
    return F.split(null_text(c), r",\s*").try_cast("array<int>")


def number_in(c, to: str = "decimal(6,2)") -> Column:
    """Strip units ('23.4 km', '25mins') and cast; text without a number is NULL."""
    c = F.col(c) if isinstance(c, str) else c
    num = F.regexp_extract(c, r"[0-9]+(\.[0-9]+)?", 0)
    return F.when(num != "", num).try_cast(to)


def to_timestamp_or_null(c) -> Column:
    return null_text(c).try_cast("timestamp_ntz")
