"""Connected components of a link table by alternating star contraction.

Each round replaces a node's links by links to the smallest node it knows
(large star: larger neighbours; small star: smaller ones). All steps are
grouped minima (combined before the shuffle) and joins on narrow rows, so a
node with very many links is never gathered in one place. Every round is
written to the shared folder; rounds grow with the logarithm of the longest
chain, there is no limit on them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import stage


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
    up = both.where("dst > src").join(low, "src")
    return up.select(F.col("dst").alias("src"), F.col("m").alias("dst")).where("src <> dst").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
    low = down.groupBy("src").agg(F.min("dst").alias("m"))
    moved = down.join(low, "src").select(F.col("dst").alias("src"), F.col("m").alias("dst"))
    return moved.union(low.select("src", F.col("m").alias("dst"))).where("src <> dst").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node with a link; label = smallest node of its component.

    ``edges`` has long columns ``src`` and ``dst``; an empty table gives an empty one.
    """
    e = stage(edges.select("src", "dst").where("src <> dst").distinct(), "components")
    before = None
    while True:
        mark = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        e = stage(_small_star(_large_star(e)), "components")
    nodes = e.select(F.col("src").alias("node"), F.col("dst").alias("label"))
    return nodes.union(e.select(F.col("dst").alias("node"), F.col("dst").alias("label"))).distinct()
