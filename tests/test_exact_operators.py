"""Custom exact operators against brute force on small fixtures with a hot value."""

import itertools
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from casebook.operators.baskets import top_triples
from casebook.operators.quantiles import percentile_disc
from casebook.sources.io import staged_paths


def _pdisc(vals, p):
    s = sorted(vals)
    return s[max(math.ceil(p * len(s)), 1) - 1]


@pytest.mark.parametrize("seed", [1, 2])
def test_percentile_disc_matches_definition(spark, seed):
    rnd = random.Random(seed)
    vals = [rnd.randint(0, 500) for _ in range(2000)] + [250] * 1000      # a third is one value
    df = spark.createDataFrame([(v,) for v in vals], "v int")
    ps = [0.1, 0.25, 0.5, 0.75, 0.99]
    got = percentile_disc(df, "v", ps, [f"p{i}" for i in range(len(ps))]).first()
    assert [got[f"p{i}"] for i in range(len(ps))] == [_pdisc(vals, p) for p in ps]


@pytest.mark.parametrize("vals, kind", [
    ([1e300, -1e300] + [k / 7 for k in range(500)], "double"),                      # all but two in one bucket
    ([float("inf"), float("-inf"), 1.5, 1.5, 2.0], "double"),
    ([7] * 40, "bigint"),                                                           # one value
    ([2 ** 62 + k for k in range(50)] * 2, "bigint"),                               # equal as DOUBLE
    (["b", "a", "c", "a"], "string")])
def test_percentile_disc_of_awkward_values(spark, vals, kind):
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], f"v {kind}")
    ps = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    got = percentile_disc(df, "v", ps, [f"p{i}" for i in range(len(ps))]).first()
    assert [got[f"p{i}"] for i in range(len(ps))] == [_pdisc(vals, p) for p in ps]


def test_percentile_disc_sorts_only_what_holds_a_position(spark):
    df = spark.range(100_000).select(F.col("id").alias("v"))
    before = set(staged_paths(spark))
    assert percentile_disc(df, "v", [0.25, 0.5], ["a", "b"]).first() == (24_999, 49_999)
    sorted_ = [p for p in staged_paths(spark) if p not in before and "percentile_places" in p]
    assert spark.read.parquet(sorted_[0]).count() <= 2 * (100_000 // 4096 + 1)


@pytest.mark.parametrize("sizes", [(3, 20), (17, 30), (2, 16)])
def test_top_triples_with_small_and_large_baskets(spark, sizes):
    """Baskets on both sides of the limit for listing in place, null items and baskets."""
    rnd = random.Random(sum(sizes))
    items = [f"i{k:02d}" for k in range(30)]
    rows = [(t, it) for t in range(60) for it in rnd.sample(items, rnd.randint(*sizes))] + [(1, None), (None, "i00"), (None, "i01"), (None, "i02")]
    baskets = {}
    for t, it in rows:
        if t is not None and it is not None:
            baskets.setdefault(t, set()).add(it)
    c = Counter(tri for b in baskets.values() for tri in itertools.combinations(sorted(b), 3))
    want = sorted((*tri, n) for tri, n in c.items() if n == max(c.values()))
    df = spark.createDataFrame(rows, "txn int, item string")
    assert sorted(tuple(r) for r in top_triples(df, "txn", "item", seed_items=5).collect()) == want


def test_top_triples_matches_brute_force(spark):
    rnd = random.Random(7)
    items = [f"i{k:02d}" for k in range(12)]
    rows = []
    for t in range(400):
        size = 40 if t == 0 else rnd.randint(1, 5)                 # one very large basket
        for it in rnd.sample(items, min(size, len(items))):
            rows.append((t, it))
            if rnd.random() < 0.2:
                rows.append((t, it))                                # repeated lines
    df = spark.createDataFrame(rows, "txn int, item string")
    baskets = {}
    for t, it in rows:
        baskets.setdefault(t, set()).add(it)
    c = Counter(tri for b in baskets.values() for tri in itertools.combinations(sorted(b), 3))
    best = max(c.values())
    want = sorted((a, b, d, n) for (a, b, d), n in c.items() if n == best)
    got = sorted(tuple(r) for r in top_triples(df, "txn", "item", seed_items=4).collect())
    assert got == want


def test_top_triples_with_large_baskets(spark):
    rnd = random.Random(11)
    items = [f"i{k:02d}" for k in range(14)]
    rows = []
    for t in range(300):
        size = rnd.choice([10, 12, 14]) if t < 3 else rnd.randint(1, 6)   # three very large baskets
        rows += [(t, it) for it in rnd.sample(items, size)]
    df = spark.createDataFrame(rows, "txn int, item string")
    baskets = {}
    for t, it in rows:
        baskets.setdefault(t, set()).add(it)
    c = Counter(tri for b in baskets.values() for tri in itertools.combinations(sorted(b), 3))
    best = max(c.values())
    want = sorted((a, b, d, n) for (a, b, d), n in c.items() if n == best)
    got = sorted(tuple(r) for r in top_triples(df, "txn", "item", seed_items=4).collect())
    assert got == want


def test_top_triples_with_a_basket_of_2000_items(spark):
    """Its 1.3 billion triples are never listed: pairs below the best known support go first."""
    rows = [(0, f"x{k:04d}") for k in range(2000)]
    rows += [(t, f"x{k:04d}") for t in range(1, 6) for k in (3, 5, 8, 13 + t)]
    got = [tuple(r) for r in top_triples(spark.createDataFrame(rows, "txn int, item string"), "txn", "item").collect()]
    assert got == [("x0003", "x0005", "x0008", 6)]


def test_percentile_disc_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v int")
    assert percentile_disc(df, "v", [0.5], ["p"]).first().p is None
