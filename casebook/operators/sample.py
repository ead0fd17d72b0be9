"""Row samples that do not depend on how the rows are laid out.

A LIMIT without an order takes whatever comes first. Here a row's place in the
draw is a digest of its key and a seed, and the sample is the k rows with the
smallest digests: a heap of k rows a task, merged. The sample of a union is the
sample of the samples, so parts can be drawn separately and merged later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def draw(keys, seed: int = 0) -> Column:
    """The digest that orders the draw: MD5 of the seed and the key columns (nulls count as empty)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys)))


def bottom_k(df: DataFrame, keys, k: int, by=None, seed: int = 0, out: str = "draw") -> DataFrame:
    """``k`` rows of ``df`` (of each group of ``by``), with the digest in ``out``.

    The whole sample is one top-k a task; with groups, each task keeps at most k rows a
    group before the shuffle (for k up to spark.sql.optimizer.windowGroupLimitThreshold).
    ``keys`` should identify a row; rows with equal keys are ordered by their other columns.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(out), *(F.col(c).cast("string") for c in keys), *(F.col(c).cast("string") for c in rest)]
    drawn = df.withColumn(out, draw(keys, seed))
    if by is None:
        return drawn.orderBy(*order).limit(k)
    by = [by] if isinstance(by, str) else list(by)
    return drawn.withColumn("_place", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_place") <= k).drop("_place")


def merge_samples(a: DataFrame, b: DataFrame, k: int, by=None, out: str = "draw") -> DataFrame:
    """The sample of two inputs' union from the samples of each (drawn with one seed)."""
    both = a.unionByName(b)
    order = [F.col(out), *(F.col(c).cast("string") for c in both.columns if c != out)]
    if by is None:
        return both.orderBy(*order).limit(k)
    by = [by] if isinstance(by, str) else list(by)
    return both.withColumn("_place", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("_place") <= k).drop("_place")
