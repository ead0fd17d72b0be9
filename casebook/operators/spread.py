"""Partitions by rows, for hash tables that hold a row or more for every row of the input.

Scan splits and coalesced shuffle partitions are sized in compressed bytes over
the cores at hand, so the rows of a task, and with them its hash tables, grow
with the input. ``spread`` deals the rows by the grouping columns to a stated
number of tasks (``tasks_for``) instead; the aggregation that follows needs no
shuffle of its own and no table before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 400_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    return max(-(-rows // ROWS_PER_TASK), spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, tasks: int | None, *cols: str) -> DataFrame:
    """``df`` dealt to ``tasks`` partitions by ``cols``; as it is without ``tasks``."""
    return df.repartition(tasks, *cols) if tasks else df
