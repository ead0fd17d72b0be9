"""Consecutive global row numbers without a single-partition window.

``row_number() over (order by k)`` with no partition moves every row to one
task. Here the rows are range-partitioned and sorted by the key (a
distributed sort), each row gets ``monotonically_increasing_id`` (the
partition index in the upper bits, the position in the lower 33 bits),
partition sizes are counted (one row per partition), a window over those
few rows gives each partition's starting number, and the number of a row
is start + position + 1. The tagged rows are written once to the shared
folder, so both uses read the same ids (a re-run sort could place ties
differently).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.sources.io import materialize


def global_row_number(df: DataFrame, order_cols, out: str = "row_id",
                      stage: str = "row_number_stage") -> DataFrame:
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    s = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    s = s.withColumn("_part", F.shiftright("_mid", 33)).withColumn(
        "_pos", F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)))
    s = materialize(s, stage)
    sizes = s.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.withColumn("_start", F.coalesce(
        F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return (s.join(broadcast_if_small(starts), "_part")             # one row per partition
             .withColumn(out, (F.col("_start") + F.col("_pos") + 1).cast("bigint"))
             .drop("_mid", "_part", "_pos", "_start"))


def row_number_by(df: DataFrame, by, order_cols, out: str = "row_number",
                  stage: str = "row_number_by_stage") -> DataFrame:
    """``row_number() over (partition by by order by order_cols)`` for groups of any size.

    The rows are range-partitioned and sorted by (by, order_cols), so a hot
    group is spread over several partitions in which its rows are
    contiguous. Counting rows per (group, partition) gives a small table (a
    group spans at most all partitions); a window over it gives each piece's
    offset, and the number of a row is offset + its place in the piece + 1.
    The tagged rows are staged once in the shared folder, so every use sees
    the same placement.
    """
    by = [by] if isinstance(by, str) else list(by)
    order_cols = [order_cols] if isinstance(order_cols, str) else list(order_cols)
    s = df.orderBy(*by, *order_cols).withColumn("_mid", F.monotonically_increasing_id())
    s = materialize(s.withColumn("_part", F.shiftright("_mid", 33)), stage)
    pieces = s.groupBy(*by, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0))).drop("_n")
    return (s.join(pieces, by + ["_part"])
             .withColumn(out, (F.col("_off") + F.col("_mid") - F.col("_first") + 1).cast("bigint"))
             .drop("_mid", "_part", "_first", "_off"))
