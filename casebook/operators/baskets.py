"""Most frequent 3-item combinations, exact, for baskets of any size.

1. Baskets are reduced to distinct (basket, item) rows.
2. Baskets of up to ``SMALL`` items become one sorted array each and are listed
   in place (at most C(SMALL, 3) triples): one shuffle, no join.
3. Larger baskets are never expanded inside one row. A lower bound ``floor`` on
   the best support (the best triple of the small baskets, or of the
   ``seed_items`` most frequent items in the large ones) drops items, then pairs,
   whose support over all baskets is below it. Pairs are rows (basket, i1, i2) of
   a join on the basket; a triple is two frequent pairs that share basket and
   first item, if the third pair is frequent too.
4. Both counts add up. What step 3 has dropped stays below the floor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.operators.spread import spread
from casebook.sources.io import materialize

SMALL = 16                  # C(16, 3) = 560 triples


def _pairs(bi: DataFrame, basket: str) -> DataFrame:
    a = bi.select(basket, F.col("item").alias("i1"))
    b = bi.select(basket, F.col("item").alias("i2"))
    return a.join(b, basket).where("i1 < i2")


def _triple_counts(pairs: DataFrame, basket: str, out: str) -> DataFrame:
    second = pairs.select(basket, "i1", F.col("i2").alias("i3"))
    third = pairs.select(basket, F.col("i1").alias("i2"), F.col("i2").alias("i3"))
    t = pairs.join(second, [basket, "i1"]).where("i2 < i3").join(third, [basket, "i2", "i3"], "left_semi")
    return t.groupBy("i1", "i2", "i3").agg(F.count(F.lit(1)).alias(out))


def _listed(items: DataFrame, size: int) -> DataFrame:
    """The combinations of ``size`` items of every (short, sorted) array ``items``: columns i1, i2, ..."""
    rest = F.col("items")
    names = []
    for k in range(1, size + 1):
        items = items.select(*names, rest.alias("rest")).select(*names, "rest", F.posexplode("rest").alias("at", f"i{k}"))
        names.append(f"i{k}")
        rest = F.slice("rest", F.col("at") + 2, F.size("rest"))
    return items.select(*names)


def _large_counts(bi: DataFrame, large: DataFrame, small: DataFrame, listed: DataFrame, basket: str, seed_items: int) -> DataFrame:
    """(i1, i2, i3, f): counts in the large baskets of every triple that may be the best."""
    own = materialize(bi.join(broadcast_if_small(large), basket, "left_semi"), "basket_large")
    support = bi.groupBy("item").agg(F.count(F.lit(1)).alias("s"))
    seed = support.orderBy(F.desc("s"), "item").limit(seed_items).select("item")
    among = own.join(broadcast_if_small(seed), "item", "left_semi")
    best = listed.select("f").union(_triple_counts(_pairs(among, basket), basket, "f").select("f"))
    floor = materialize(best.agg(F.coalesce(F.max("f"), F.lit(1)).alias("floor")), "basket_floor").scalar()
    often = support.where(F.col("s") >= floor).select("item")
    pairs = _pairs(own.join(often, "item", "left_semi"), basket)
    here = materialize(pairs.groupBy("i1", "i2").agg(F.count(F.lit(1)).alias("s")), "basket_pair_counts")
    there = _listed(small, 2).join(here.select("i1", "i2"), ["i1", "i2"], "left_semi").groupBy("i1", "i2").agg(F.count(F.lit(1)).alias("s"))
    often = here.union(there).groupBy("i1", "i2").agg(F.sum("s").alias("s")).where(F.col("s") >= floor).select("i1", "i2")
    pairs = materialize(pairs.join(often, ["i1", "i2"], "left_semi"), "basket_pairs")
    return _triple_counts(pairs, basket, "f")


def top_triples(df: DataFrame, basket: str, item: str, seed_items: int = 12,
                names=("product_1", "product_2", "product_3"), count_name="buying_freq", tasks: int | None = None) -> DataFrame:
    """The triple(s) found in most baskets. Null items do not count; rows with a null basket belong to none."""
    rows = df.select(F.col(basket), F.col(item).alias("item"))
    rows = rows.where(F.col("item").isNotNull() & F.col(basket).isNotNull())
    bi = materialize(spread(rows, tasks, basket, "item").distinct(), "basket_items")
    sizes = bi.groupBy(basket).agg(F.count(F.lit(1)).alias("n"))
    large = materialize(sizes.where(F.col("n") > SMALL).select(basket), "basket_sizes")
    small = (bi.join(broadcast_if_small(large), basket, "left_anti").groupBy(basket)
               .agg(F.sort_array(F.collect_list("item")).alias("items")))
    counts = materialize(_listed(small.where(F.size("items") > 2), 3).groupBy("i1", "i2", "i3")
                         .agg(F.count(F.lit(1)).alias("f")), "basket_triples")
    if not large.isEmpty():
        more = _large_counts(bi, large, small, counts, basket, seed_items)
        counts = materialize(counts.union(more).groupBy("i1", "i2", "i3").agg(F.sum("f").alias("f")), "basket_all_triples")
    top = counts.where(F.col("f") == counts.agg(F.max("f")).scalar())
    return top.select(F.col("i1").alias(names[0]), F.col("i2").alias(names[1]), F.col("i3").alias(names[2]), F.col("f").alias(count_name))
