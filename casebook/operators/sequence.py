"""Per-group sequence numbers that stay split when one group is hot."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F


def sequence_number(df: DataFrame, by, day_col: str, tiebreak, out: str = "seq") -> DataFrame:
    """``row_number() over (partition by by order by day_col, tiebreak...)``.

    Computed as (rows of the group on earlier days) + (row number within the
    group's day). The first term comes from per-(group, day) counts, the
    second from a window partitioned by (group, day), so a group holding a
    third of all rows is spread over its days instead of one task.
    """
    by = [by] if isinstance(by, str) else list(by)
    tiebreak = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak)
    per_day = df.groupBy(*by, day_col).agg(F.count(F.lit(1)).alias("_n"))
    wcum = W.partitionBy(*by).orderBy(day_col).rowsBetween(W.unboundedPreceding, -1)
    offsets = per_day.withColumn("_off", F.coalesce(F.sum("_n").over(wcum), F.lit(0))).drop("_n")
    within = F.row_number().over(W.partitionBy(*by, day_col).orderBy(*tiebreak))
    return (df.withColumn("_r", within).join(offsets, by + [day_col], "left")
              .withColumn(out, (F.col("_off") + F.col("_r")).cast("bigint"))
              .drop("_r", "_off"))
