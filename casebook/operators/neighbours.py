"""Windows over a whole result (LAG, LEAD, moving means) without one task for all rows.

``lag() over (order by k)`` has no partition, so Spark sorts everything in one
task. Here the rows get consecutive numbers by a range sort, are cut into blocks
of numbers, and every block also receives the few rows next to it that its
windows look at. Inside a block the window is an ordinary one, partitioned by
block; the borrowed rows are dropped afterwards.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casebook.operators.rowid import global_row_number

BLOCK = 100_000


def over_all(df: DataFrame, order_cols, columns: dict[str, Callable[..., Column]], back: int = 0, ahead: int = 0,
             block: int = BLOCK, stage: str = "whole_result") -> DataFrame:
    """``df`` with window ``columns`` over all its rows in the order of ``order_cols``.

    Each column is a function of a window (ordered, to be framed if wanted) that looks
    at most ``back`` rows back and ``ahead`` rows ahead. The order should be total;
    rows that tie follow each other in any order.
    """
    if max(back, ahead) > block:
        raise ValueError("a window may not look further than one block")
    numbered = global_row_number(df, order_cols, "_row", stage).withColumn("_home", F.floor((F.col("_row") - 1) / block))
    place = (F.col("_row") - 1) % block
    blocks = F.array_compact(F.array(F.col("_home"), F.when(place >= block - back, F.col("_home") + 1) if back else F.lit(None).cast("long"),
                                     F.when(place < ahead, F.col("_home") - 1) if ahead else F.lit(None).cast("long")))
    w = W.partitionBy("_block").orderBy("_row")
    out = numbered.withColumn("_block", F.explode(blocks)).withColumns({c: f(w) for c, f in columns.items()})
    return out.where("_block = _home").drop("_row", "_home", "_block")
