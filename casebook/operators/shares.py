"""Percent-of-total and percent-of-group without a single-task window.

A window with no PARTITION BY moves every row to one task. The total is
instead a scalar subquery (an aggregate evaluated once, its value used in
the projection); group totals are an aggregate joined back on the group
key, which AQE can split when one key is hot. A zero total gives NULL
(``try_divide``) instead of failing the job under ANSI mode, as SQL engines
that return NULL do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_grand_total(df: DataFrame, value_col: str, out: str = "total") -> DataFrame:
    """Attach the grand total of ``value_col`` to every row."""
    return df.withColumn(out, df.agg(F.sum(value_col)).scalar())


def with_total_share(df: DataFrame, value_col: str, out: str, scale: int = 2,
                     factor: float = 100.0) -> DataFrame:
    """``out = round(factor * value / sum(value), scale)`` as DOUBLE."""
    t = "_total_" + out
    return (with_grand_total(df, value_col, t)
            .withColumn(out, F.round(F.try_divide(F.lit(factor) * F.col(value_col).cast("double"),
                                                  F.col(t).cast("double")), scale))
            .drop(t))


def percent_of_group(df: DataFrame, by, value_col: str, out: str, scale: int = 2,
                     factor: float = 100.0) -> DataFrame:
    """Share of each row's value in its group's total."""
    by = [by] if isinstance(by, str) else list(by)
    t = "_gtotal_" + out
    totals = df.groupBy(*by).agg(F.sum(value_col).alias(t))
    return (df.join(totals, on=by, how="left")
              .withColumn(out, F.round(F.try_divide(F.lit(factor) * F.col(value_col).cast("double"),
                                                    F.col(t).cast("double")), scale))
              .drop(t))
