"""Ranking operators written so that one hot group never lands in one task.

``rank() == 1`` on a date is the same as "order value equals the group's
minimum"; the minimum is a map-side-combined aggregate, so the rows of a
group that holds a third of the table are reduced on every mapper before
the shuffle. Dense ranks over an ordering key are ranks among that key's
distinct values: the distinct values per group (days, months) are bounded
by the calendar, not by the row count, so only that small table is
windowed and the result is joined back on (group, value).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from casebook.sources.io import materialize


def _cols(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def first_rows(df: DataFrame, by, order_col: str, desc: bool = False) -> DataFrame:
    """Rows whose ``order_col`` is the group's first value (ties kept).

    Same rows as ``rank() over (partition by by order by order_col) == 1``.
    """
    by = _cols(by)
    agg = F.max(order_col) if desc else F.min(order_col)
    if not by:                                   # global: compare with a scalar subquery
        return df.filter(F.col(order_col) == df.agg(agg).scalar())
    edge = df.groupBy(*by).agg(agg.alias(order_col))
    return df.join(edge, on=by + [order_col], how="left_semi").select(*df.columns)


def dense_rank_by(df: DataFrame, by, order_col: str, out: str = "dense_rank",
                  desc: bool = False) -> DataFrame:
    """Add ``dense_rank`` of ``order_col`` within ``by`` (ties share a rank)."""
    by = _cols(by)
    o = F.col(order_col).desc() if desc else F.col(order_col).asc()
    keys = df.select(*by, order_col).distinct()
    ranked = keys.withColumn(out, F.row_number().over(W.partitionBy(*by).orderBy(o)))
    return df.join(ranked, on=by + [order_col], how="left")


def rank_by(df: DataFrame, by, order_col: str, out: str = "rank",
            desc: bool = False) -> DataFrame:
    """Add SQL ``rank()`` of ``order_col`` within ``by``, for groups and value sets of any size.

    rank = 1 + number of rows with a strictly earlier value. Per-(group,
    value) counts are sorted across the cluster, so a group may span many
    partitions; a window over one total per (group, partition) gives each
    piece's offset, a window inside the piece the rest.
    """
    by = _cols(by)
    o = F.col(order_col).desc() if desc else F.col(order_col).asc()
    counts = df.groupBy(*by, order_col).agg(F.count(F.lit(1)).alias("_n"))
    s = counts.orderBy(*by, o).withColumn("_part", F.shiftright(F.monotonically_increasing_id(), 33))
    s = materialize(s, "rank_counts")
    pieces = s.groupBy(*by, "_part").agg(F.sum("_n").alias("_t"))
    before = W.partitionBy(*by).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    inside = W.partitionBy(*by, "_part").orderBy(o).rowsBetween(W.unboundedPreceding, -1)
    rank = F.col("_off") + F.coalesce(F.sum("_n").over(inside), F.lit(0)) + 1
    ranked = s.join(pieces, [*by, "_part"]).withColumn(out, rank.cast("int")).drop("_n", "_part", "_off")
    return df.join(ranked, on=by + [order_col], how="left")


def top_values(df: DataFrame, order_col: str, n: int, desc: bool = False) -> DataFrame:
    """Rows whose ``order_col`` is among the n first distinct values (``dense_rank <= n`` without a global window)."""
    o = F.col(order_col).desc() if desc else F.col(order_col).asc()
    cut = df.where(F.col(order_col).isNotNull()).select(order_col).distinct().orderBy(o).limit(n)
    return df.join(cut, order_col, "left_semi").select(*df.columns)


def top_per_group(df: DataFrame, by, order: Sequence, n: int,
                  method: str = "dense_rank", out: str | None = None) -> DataFrame:
    """Rows ranked ``<= n`` within each group, ties kept for rank methods.

    The ``rank <= n`` filter plans as WindowGroupLimit, which also runs a
    partial limit on each mapper before the shuffle.
    """
    fn = {"dense_rank": F.dense_rank, "rank": F.rank, "row_number": F.row_number}[method]
    w = W.partitionBy(*_cols(by)) if by else W.partitionBy()
    col = out or "_rk"
    res = df.withColumn(col, fn().over(w.orderBy(*order))).filter(F.col(col) <= n)
    return res if out else res.drop(col)


def top_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """Global top-n (TakeOrderedAndProject: each task keeps n, driver merges)."""
    return df.orderBy(*order).limit(n)
