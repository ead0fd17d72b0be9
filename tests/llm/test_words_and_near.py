import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from casebook.llm import near_dedup as N
from casebook.llm.common import TIDY, stage_tidy, unstage
from casebook.llm.components import connected_components
from casebook.llm.words import shingle_sets, slices, word_hashes
from casebook.sources.io import staged_paths
from tests.llm.conftest import WORD, ascii_lower


def brute(rows, width, pct):
    """doc_id -> (set size, component) over all pairs."""
    sets = {}
    for i, (doc, text) in enumerate(rows):
        w = WORD.findall(ascii_lower(text))
        sets[i] = frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None:
                both = len(sets[a] & sets[b])
                if 100 * both >= pct * (len(sets[a]) + len(sets[b]) - both):
                    root[find(a)] = find(b)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[find(i)] = min(doc, low.get(find(i), doc))
    return sorted(((doc, len(sets[i]), low.get(find(i)), doc == low.get(find(i))) for i, (doc, _) in enumerate(rows)), key=repr)


def check(df, rows, width, pct):
    got = sorted((tuple(r) for r in N.near_duplicates(df, width, pct).select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)
    assert got == brute(rows, width, pct)


def test_word_hashes_do_not_depend_on_slices():
    texts = ["a b  c", "", "A b", "über\tB", "x" * 50, "b c a b c"]
    whole = []
    for size in (5, 1000):
        out = []
        for _, data, off in slices(pa.array(texts), size):
            h, rows = word_hashes(data, off)
            out += [h[a:b].tolist() for a, b in zip(rows[:-1], rows[1:])]
        whole.append(out)
    assert whole[0] == whole[1]
    assert [len(x) for x in whole[0]] == [len(WORD.findall(t)) for t in texts]
    assert whole[0][0][0] == whole[0][2][0] and whole[0][0][1] == whole[0][3][1]


def test_shingle_sets_of_short_texts():
    arr = pa.array(["a b c d", "a b", "", None, "a b c a b c"])
    sizes = [len(s) for _, d, o in slices(arr) for s in shingle_sets(d, o, 3)]
    assert sizes == [2, 1, 0, 0, 3]


def test_fixture_cases(docs):
    check(docs, [(r.doc_id, r.text) for r in docs.collect()], 3, 85)


def test_empty_table(empty):
    assert N.near_duplicates(empty).collect() == []


@pytest.mark.parametrize("list_rows,block,heavy,values,ids,banded", [
    (64, 256, 50, 1 << 20, 1 << 21, 1024), (2, 4, 1, 1 << 20, 1 << 21, 1024), (2, 4, 1, 5, 0, 0), (2, 4, 1, 0, 0, 8)])
def test_random_groups_against_all_pairs(spark, monkeypatch, list_rows, block, heavy, values, ids, banded):
    """Chains of edits, exact copies and shared passages; the small limits force the block path,
    bands of set sizes, few values in the order's bit set and documents picked by a join."""
    monkeypatch.setattr(N, "HEAVY_VALUES", values)
    monkeypatch.setattr(N, "WANTED_IDS", ids)
    monkeypatch.setattr(N, "BANDED", banded)
    monkeypatch.setattr(N, "LIST_ROWS", list_rows)
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "HEAVY_LIST", heavy)
    rnd = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(25)]
    rows = []
    for g in range(6):
        text = [rnd.choice(vocabulary) for _ in range(rnd.choice([6, 30, 60, 120]))]
        for _ in range(14):
            if rnd.random() < 0.7:
                text = list(text)
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
            rows.append((len(rows), " ".join(text + (passage if rnd.random() < 0.3 else []))))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    check(df, rows, 3, 85)
    check(df, rows, 5, 80)


@pytest.mark.parametrize("pct", [50, 80, 85, 100])
def test_sizes_that_can_pass_lie_in_neighbouring_bands(spark, pct):
    band = [r.band for r in spark.range(1, 3000).select(N._band(F.col("id"), pct).alias("band")).collect()]
    for n in range(1, 3000):
        assert 0 <= band[n - 1] - band[-(-n * pct // 100) - 1] <= 1


def test_block_pairs_of_a_value_that_every_class_holds(spark, monkeypatch):
    """Blocks meet within two bands of sizes only."""
    monkeypatch.setattr(N, "BLOCK", 8)
    lists = spark.range(2000).selectExpr("7L as v", "id as cls", "id as label", "10 * cast(pow(1.2, id % 40) as long) as n")
    pairs = {}
    for limit in (1000, 10000):
        monkeypatch.setattr(N, "BANDED", limit)
        home, pair = N._block_pairs(lists, 85)
        assert home.count() == 2000
        pairs[limit] = pair.count()
    assert pairs[1000] * 5 < pairs[10000]


def _signed_lists(spark, sets, v=7):
    rows = [(v, i, len(s), i, *map(int, N._signature(s))) for i, s in enumerate(sets)]
    return spark.createDataFrame(rows, "v long, cls long, n long, label long, s1 long, s2 long")


def test_signatures_keep_every_pair_above_the_threshold(spark):
    """Sets of many sizes with 0 to 30 % of their values exchanged: what passes the exact test passes the signature's."""
    rnd = np.random.default_rng(5)
    for pct in (50, 80, 85, 100):
        sets = []
        for n in (1, 2, 7, 12, 40, 150, 700, 4000):
            first = rnd.integers(0, 1 << 64, n, dtype=np.uint64)
            for share in (0, 0.02, 0.05, 0.08, 0.1, 0.15, 0.3):
                other = first.copy()
                other[:int(n * share)] = rnd.integers(0, 1 << 64, int(n * share), dtype=np.uint64)
                sets.append(np.unique(other))
        got = {(r.a, r.b) for r in N._cross_pairs(_signed_lists(spark, sets), pct).collect()}
        for i, x in enumerate(sets):
            for j in range(i + 1, len(sets)):
                shared = len(np.intersect1d(x, sets[j]))
                if 100 * shared >= pct * (len(x) + len(sets[j]) - shared):
                    assert (i, j) in got


def test_sets_that_share_a_value_by_chance_make_no_pairs(spark):
    """One value in 60 unrelated sets and two near ones: one pair is moved, two members go to blocks."""
    rnd = np.random.default_rng(6)
    sets = [np.unique(np.append(rnd.integers(0, 1 << 64, 300, dtype=np.uint64), np.uint64(9))) for _ in range(61)]
    sets.append(np.unique(np.append(sets[60][:-5], rnd.integers(0, 1 << 64, 5, dtype=np.uint64))))
    lists = _signed_lists(spark, sets)
    assert [tuple(r) for r in N._cross_pairs(lists, 85).collect()] == [(60, 61)]
    assert sorted(r.cls for r in N._live(lists, 85).collect()) == [60, 61]


@pytest.mark.parametrize("list_rows", [0, 64])
def test_only_what_the_result_reads_stays_staged(docs, monkeypatch, list_rows):
    monkeypatch.setattr(N, "LIST_ROWS", list_rows)
    before = staged_paths(docs.sparkSession)
    out = N.near_duplicates(docs, 3, 85)
    left = {p.rsplit("/", 2)[-2] for p in staged_paths(docs.sparkSession) if p not in before}
    assert {p for p in left if p.startswith("near_")} == {"near_rows", "near_component_ids"}
    assert out.count() == docs.count()


def test_staging_deletes_its_shuffle_files(spark):
    """The setting holds for the write alone; the table is whole."""
    df = spark.range(1000).groupBy((F.col("id") % 70).alias("k")).count()
    tracker = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    had = tracker.shuffleStatuses().size()
    out = stage_tidy(df, "tidy")
    assert tracker.shuffleStatuses().size() <= had
    assert out.count() == 70 and spark.conf.get(TIDY, None) is None
    unstage(out)
    assert not any("/tidy/" in p for p in staged_paths(spark))


def test_shared_counts():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(1, 50)).astype(np.uint64)) for _ in range(40)]
    got = N.shared_counts(sets)
    for i in range(40):
        for j in range(i + 1, 40):
            assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_components(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "src long, dst long")).collect()))
    near = defaultdict(set)
    for a, b in links:
        if a != b:
            near[a].add(b)
            near[b].add(a)
    want = {}
    for s in sorted(near):
        todo = [s]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = s
                todo += near[x]
    assert got == want
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []
    assert Counter(got.values())[0] == 61
