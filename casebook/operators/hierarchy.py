"""Parent-child hierarchies: iterative expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.sources.io import materialize


def ancestors(edges: DataFrame) -> DataFrame:
    """All (id, ancestor_id, depth) pairs of an ``(id, parent_id)`` table, with the shortest depth.

    The recursive-CTE pattern (UNION semantics) by doubling: the pairs within
    2**k steps joined with themselves give those within 2**(k+1), so a chain
    of any length is whole after log2(length) rounds; there is no depth limit.
    It stops when a round changes neither the number of pairs nor a depth,
    also on a cyclic hierarchy. Every round is written to the shared folder,
    so no round is worked out again.
    """
    first = edges.filter(F.col("id").isNotNull() & F.col("parent_id").isNotNull())
    reached = materialize(first.select("id", F.col("parent_id").alias("ancestor_id"), F.lit(1).alias("depth")).distinct(),
                          "ancestors")
    size = reached.agg(F.count(F.lit(1)), F.sum("depth")).first()
    while True:
        on = reached.select(F.col("id").alias("ancestor_id"), F.col("ancestor_id").alias("next"),
                            F.col("depth").alias("more"))
        further = reached.join(on, "ancestor_id").select("id", F.col("next").alias("ancestor_id"),
                                                         (F.col("depth") + F.col("more")).alias("depth"))
        reached = materialize(reached.unionByName(further).groupBy("id", "ancestor_id")
                              .agg(F.min("depth").alias("depth")), "ancestors")
        now = reached.agg(F.count(F.lit(1)), F.sum("depth")).first()
        if now == size:
            return reached
        size = now
