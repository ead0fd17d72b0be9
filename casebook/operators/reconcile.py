"""Key reconciliation between two tables (anti joins both ways)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def keys_missing(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct ``key`` values of ``left`` absent from ``right`` (SQL EXCEPT)."""
    return left.select(key).distinct().join(right.select(key), key, "left_anti")


def reconcile_summary(left: DataFrame, right: DataFrame, key: str,
                      left_only: str = "left_only", right_only: str = "right_only") -> DataFrame:
    """Counts of distinct keys present on one side only (full-join summary)."""
    a = keys_missing(left, right, key).agg(F.count(F.lit(1)).alias(left_only))
    return a.withColumn(right_only, keys_missing(right, left, key).agg(F.count(F.lit(1))).scalar())
