"""MinHash near-duplicate groups from bottom-k sketches of one hash function.

A document's set holds the 64-bit hashes of its distinct word shingles
(``words.shingle_sets``). Equal sets form a class and are handled once.

1. Candidates. Two sets of similarity >= t share one of their
   ``n - ceil(t * n) + 1`` smallest values in any common order, so every class
   retains that many of its smallest hashes (bottom-k, k following the set
   size): no qualifying pair is lost, there is no cap. The order is the hash
   order, except that values held by very many documents come last (a
   fixed-size bit set names them; it changes the order only).
2. Inverted lists of the retained values. Each list first links its members
   to its smallest member only, so a large group of near copies costs one
   pair per member, not all pairs.
3. Signature: of each of ``BINS`` ranges of hashes the smallest value's last
   bit. A differing bit takes a value that one set alone holds, so as many
   bits as a pair above t can differ in are known from its sizes; where the
   odds of differing in so many are under 1e-12 the limit is lower. Pairs
   beyond it are dropped where they are made, before they are moved: values
   that sets share by chance give pairs with the square of the input.
   Union-sketch estimate of the others: of the SKETCH smallest values of both
   sketches together, the share held by both. Pairs far below t are dropped
   (at t = 0.85 a true pair fails with odds under 1e-12; sets that fit into
   their sketch are compared exactly).
4. Exact Jaccard on the full sets, recomputed from the texts of the classes
   still in play.
5. Components of the confirmed links. Lists whose members are not all in one
   component are then completed: pairs between different components for
   lists up to ``LIST_ROWS`` members, and blocks of members compared inside
   tasks for longer ones, which emit only the links that join components. In
   lists up to ``LIVE_ROWS`` members only those take part whose signature lets
   another one of the list be near. Very long lists are cut by set size first:
   blocks whose sizes rule the threshold out do not meet.

A staged table is deleted once its last reader has run, and the shuffle files
of a step with its end, so the disk holds one step at a time.

Null or wordless texts have the empty set: a component of their own. So have
rows without doc_id (their component_id is null). Rows that repeat a doc_id
are answered one by one. Other columns are ignored.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import BIT_INDEX, bit_set, bits_by, hashed_bit, in_bits, stage_tidy as stage, unstage
from casebook.llm.components import connected_components
from casebook.llm.words import mix, shingle_sets, slices
from casebook.sources.io import drop_stages, staged_paths

SKETCH = 64                 # values per union sketch
BINS = 128                  # bits of a signature
HEAVY_LIST = 50             # a value retained by more documents than this is ordered last
HEAVY_VALUES = 1 << 20      # ordered last: the most frequent, so that their bit set stays sparse
WANTED_IDS = 1 << 21        # more documents than this are picked by a join, not by the bit set of their ids
LIST_ROWS = 64              # longest list completed by pairs of rows
LIVE_ROWS = 1 << 13         # longest list whose members are tried by signature before they go to blocks
BLOCK = 256                 # classes per block of a longer list
BANDED = 4 * BLOCK          # lists with more classes at home are cut by set size
ORDER_BITS = BIT_INDEX


def retained(n: int, pct: int) -> int:
    return n - (pct * n + 99) // 100 + 1


def _digests(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit digests of a set."""
    if not len(s):
        return 0, 0
    m = mix(s ^ np.uint64(0x5851F42D4C957F2D))
    first = mix(np.add.reduce(m, keepdims=True))
    return int(first.view(np.int64)[0]), int(np.add.reduce(mix(m + np.uint64(0x14057B7EF767814F))).view(np.int64))


_EDGES = np.arange(BINS, dtype=np.uint64) * np.uint64((1 << 64) // BINS)


def _signature(s: np.ndarray) -> np.ndarray:
    """Two longs: the last bit of the smallest value in each of ``BINS`` equal ranges of hashes, 0 in empty ones."""
    at = np.searchsorted(s, _EDGES)
    held = at < np.append(at[1:], len(s))
    bits = np.zeros(BINS, np.uint8)
    bits[held] = s[at[held]] & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def _differing_bits(pct: int) -> int:
    """Signature bits in which a pair above the threshold differs at most, but for odds under 1e-12.

    A bit differs at even odds if the smallest value of its range is held by one set alone; of such
    draws without replacement the binomial tail is an upper bound.
    """
    p, tail, k = (100 - pct) / 200, 0.0, BINS
    while k and (tail := tail + math.comb(BINS, k) * p**k * (1 - p)**(BINS - k)) < 1e-12:
        k -= 1
    return k


def _may_be_near(a, b, pct: int):
    """Neither the sizes nor the signatures of (n, s1, s2) and (n, s1, s2) rule the threshold out."""
    (n, s1, s2), (m, r1, r2) = ([F.col(x) for x in side] for side in (a, b))
    differ = F.bit_count(s1.bitwiseXOR(r1)) + F.bit_count(s2.bitwiseXOR(r2))
    return (_alike_sizes(n, m, pct) & (differ <= _differing_bits(pct))
            & (differ.cast("long") * (100 + pct) <= (n + m) * (100 - pct)))


def _heavy(values: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return in_bits(bits, (mix(values) >> np.uint64(64 - ORDER_BITS)).astype(np.int64))


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def _lists(parts, kind=None) -> pa.Array:
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    off = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(p) for p in parts], out=off[1:])
    return pa.ListArray.from_arrays(pa.array(off), pa.array(_signed(flat), pa.int64()))


def _head_values(width: int, pct: int):
    """Half as many values again as are retained, flat: only counted, to find frequent ones."""
    def run(batches):
        for b in batches:
            for _, data, off in slices(b.column("text")):
                parts = [s[:retained(len(s), pct) * 3 // 2] for s in shingle_sets(data, off, width) if len(s)]
                if parts:
                    yield pa.RecordBatch.from_arrays([pa.array(_signed(np.concatenate(parts)))], ["v"])
    return run


def _sets(width: int, pct: int, bits: np.ndarray):
    """Set size, two digests of the set, signature, sketch and retained values of every document."""
    def run(batches):
        for b in batches:
            for lo, data, off in slices(b.column("text")):
                n, d1, d2, marks, sketch, keep = [], [], [], [], [], []
                for s in shingle_sets(data, off, width):
                    n.append(len(s))
                    x, y = _digests(s)
                    d1.append(x)
                    d2.append(y)
                    marks.append(_signature(s))
                    sketch.append(s[:SKETCH])
                    h = _heavy(s, bits)
                    keep.append((np.concatenate([s[~h], s[h]]) if h.any() else s)[:retained(len(s), pct)] if len(s) else s)
                ids = b.column("doc_id").slice(lo, len(n))
                s1, s2 = (pa.array([m[k] for m in marks], pa.int64()) for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), s1, s2, _lists(sketch), _lists(keep)],
                    ["doc_id", "n_shingles", "cls", "check", "s1", "s2", "sketch", "kept_values"])
    return run


def _full_sets(width: int, bits: np.ndarray | None):
    """Whole sets of the documents whose id may be in the bit set (of all without one)."""
    def run(batches):
        for b in batches:
            if bits is not None:
                bit = b.column("bit").to_numpy(zero_copy_only=False)
                b = b.filter(pa.array(in_bits(bits, bit.astype(np.int64))))
            for lo, data, off in slices(b.column("text")) if b.num_rows else ():
                sets = list(shingle_sets(data, off, width))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, len(sets)), pa.array([_digests(s)[0] for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "cls", "members"])
    return run


def _estimate(pct: int):
    """Keeps the pairs whose union sketch does not rule the threshold out."""
    def run(batches):
        for b in batches:
            a, c = b.column("a_sketch"), b.column("b_sketch")
            av, ao = a.values.to_numpy(), a.offsets.to_numpy()
            cv, co = c.values.to_numpy(), c.offsets.to_numpy()
            keep = np.zeros(b.num_rows, bool)
            for i in range(b.num_rows):
                x, y = av[ao[i]:ao[i + 1]].view(np.uint64), cv[co[i]:co[i + 1]].view(np.uint64)
                both = np.sort(np.concatenate([x, y]))
                twice = both[1:] == both[:-1]
                if len(x) < SKETCH and len(y) < SKETCH:          # both sets are whole
                    shared = int(twice.sum())
                    keep[i] = 100 * shared >= pct * (len(both) - shared)
                    continue
                first = np.concatenate([[True], ~twice])
                union = both[first][:SKETCH]
                shared = int((both[1:][twice] <= union[-1]).sum())
                keep[i] = shared * 100 >= (pct - 45) * len(union)
            yield b.select(["a", "b"]).filter(pa.array(keep))
    return run


def _verify(pct: int):
    def run(batches):
        for b in batches:
            a, c = b.column("a_set"), b.column("b_set")
            keep = []
            for x, y in zip(a, c):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= pct * (len(x) + len(y) - shared))
            yield b.select(["a", "b"]).filter(pa.array(keep, pa.bool_())).rename_columns(["src", "dst"])
    return run


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes above the diagonal: frequent values by matrix product, rare ones counted by pair."""
    m = len(sets)
    v = np.concatenate(sets)
    d = np.repeat(np.arange(m), [len(s) for s in sets])
    o = np.argsort(v, kind="stable")
    v, d = v[o], d[o]
    start = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    size = np.diff(np.append(start, len(v)))
    out = np.zeros((m, m), np.float32)
    often = np.flatnonzero(size >= 16)
    for k in range(0, len(often), 4096):
        part = often[k:k + 4096]
        grid = np.zeros((m, len(part)), np.float32)
        at = np.concatenate([np.arange(start[i], start[i] + size[i]) for i in part])
        grid[d[at], np.repeat(np.arange(len(part)), size[part])] = 1
        out += grid @ grid.T
    out = np.triu(out, 1).astype(np.int64)
    for c in range(2, 16):                       # within a value, documents are in ascending order
        rows = d[start[size == c][:, None] + np.arange(c)] if (size == c).any() else None
        for i in range(c) if rows is not None else ():
            for j in range(i + 1, c):
                out += np.bincount(rows[:, i] * m + rows[:, j], minlength=m * m).reshape(m, m)
    return out


def _block_links(pct: int):
    """Links inside one pair of blocks that join different components: at most one per class."""
    def run(pdf):
        import pandas as pd
        pdf = pdf.drop_duplicates("cls").sort_values("cls")
        sets = [np.frombuffer(x, np.uint64) for x in pdf["members"]]
        n, label = np.array([len(s) for s in sets]), pdf["label"].to_numpy()
        shared = shared_counts(sets)
        ok = 100 * shared >= pct * (n[:, None] + n[None, :] - shared)
        ok &= label[:, None] != label[None, :]
        i, j = np.nonzero(np.triu(ok, 1))
        root = {x: x for x in label.tolist()}

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        out, cls = [], pdf["cls"].to_numpy()
        for x, y in zip(i.tolist(), j.tolist()):
            p, q = find(label[x]), find(label[y])
            if p != q:
                root[p] = q
                out.append((cls[x], cls[y]))
        return pd.DataFrame(out, columns=["src", "dst"], dtype="int64")
    return run


class _Corpus:
    """What the steps share: the texts, the classes and the parameters."""

    def __init__(self, docs: DataFrame, width: int, pct: int):
        self.docs, self.width, self.pct = docs, width, pct
        texts = docs.select("text")
        frequent = (texts.mapInArrow(_head_values(width, pct), "v long")
                         .groupBy("v").count().where(F.col("count") > HEAVY_LIST))
        self.sets = stage(docs.select("doc_id", "text").mapInArrow(
            _sets(width, pct, self._order_bits(frequent)),
            "doc_id long, n_shingles long, cls long, check long, s1 long, s2 long, sketch array<long>, kept_values array<long>"), "near_sets")
        self.rows = stage(self.sets.select("doc_id", "n_shingles", "cls"), "near_rows")
        some = (self.sets.where("n_shingles > 0 and doc_id is not null").groupBy("cls")
                    .agg(F.min("doc_id").alias("rep"), F.min("n_shingles").alias("n"), F.max("n_shingles").alias("n2"),
                         F.min("check").alias("c1"), F.max("check").alias("c2"), F.min("s1").alias("s1"), F.min("s2").alias("s2"),
                         F.first("sketch").alias("sketch")))
        self.classes = stage(some, "near_classes")
        if self.classes.where("n <> n2 or c1 <> c2").limit(1).count():
            raise RuntimeError("two different sets share a 64-bit digest; change the digest constant")

    @staticmethod
    def _order_bits(frequent: DataFrame) -> np.ndarray:
        """Bit set of the most frequent values (from a power of two of holders on), by the hash that ``_heavy`` uses."""
        frequent = stage(frequent, "near_frequent")
        level = F.length(F.bin("count"))
        sizes = dict(frequent.groupBy(level.alias("level")).count().collect())        # at most 64 rows
        least, n = 65, 0
        while least > 1 and n + sizes.get(least - 1, 0) <= HEAVY_VALUES:
            least -= 1
            n += sizes.get(least, 0)
        bits = bits_by(frequent.where(level >= least).select("v"), lambda b: (
            mix(b.column("v").to_numpy().view(np.uint64)) >> np.uint64(64 - ORDER_BITS)).astype(np.int64))
        unstage(frequent)
        return bits

    def signatures(self, side: str) -> DataFrame:
        return self.classes.select(F.col("cls").alias(side), *(F.col(x).alias(f"{side}_{x}") for x in ("n", "s1", "s2")))

    def sets_of(self, wanted: DataFrame, name: str) -> DataFrame:
        """``(cls, members)`` for the classes in ``wanted``, from their representatives' texts."""
        reps = stage(self.classes.join(wanted.distinct(), "cls", "left_semi").select("cls", "rep"), "near_wanted")
        docs = self.docs.select("doc_id", "text", hashed_bit("doc_id").alias("bit")).where("doc_id is not null")
        bits = bit_set(reps, "rep") if reps.count() <= WANTED_IDS else None
        if bits is None:
            docs = docs.join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
        found = docs.mapInArrow(_full_sets(self.width, bits), "doc_id long, cls long, members binary")
        found = stage(found.join(reps.withColumnRenamed("rep", "doc_id"), ["doc_id", "cls"]).select("cls", "members"), name)
        unstage(reps)
        return found

    def confirmed(self, pairs: DataFrame, name: str) -> DataFrame:
        """Of the pairs (a, b) those that pass the sketch estimate and the exact test."""
        sk = self.classes.select("cls", "sketch")
        likely = (pairs.join(sk.withColumnsRenamed({"cls": "a", "sketch": "a_sketch"}), "a")
                       .join(sk.withColumnsRenamed({"cls": "b", "sketch": "b_sketch"}), "b")
                       .select("a", "b", "a_sketch", "b_sketch")
                       .mapInArrow(_estimate(self.pct), "a long, b long"))
        likely = stage(likely, f"near_likely_{name}")
        one = self.sets_of(likely.select(F.col("a").alias("cls")).union(likely.select("b")), f"near_members_{name}")
        links = (likely.join(one.withColumnsRenamed({"cls": "a", "members": "a_set"}), "a")
                       .join(one.withColumnsRenamed({"cls": "b", "members": "b_set"}), "b")
                       .select("a", "b", "a_set", "b_set")
                       .mapInArrow(_verify(self.pct), "src long, dst long"))
        links = stage(links, f"near_links_{name}")
        unstage(likely, one)
        return links


def _lists_of(c: _Corpus) -> DataFrame:
    """Retained values held by at least two classes: (v, cls, n, hub, hub_n)."""
    post = c.sets.where("n_shingles > 0 and doc_id is not null").select("cls", F.col("n_shingles").alias("n"), F.explode("kept_values").alias("v"))
    ends = (post.groupBy("v").agg(F.min("cls").alias("hub"), F.min_by("n", "cls").alias("hub_n"), F.max("cls").alias("hi"))
                .where("hub <> hi").drop("hi"))
    lists = stage(post.join(ends, "v"), "near_lists")
    unstage(c.sets)
    return lists


def _alike_sizes(a: str, b: str, pct: int):
    return F.least(a, b) * 100 >= F.greatest(a, b) * pct


def _sides(lists: DataFrame, pct: int):
    """The lists twice, and what two members of a list have to fulfil to be a pair between components."""
    x, y = (lists.select(F.col("v").alias(f"{s}_v"), F.col("cls").alias(s), *(F.col(k).alias(f"{s}_{k}") for k in ("n", "label", "s1", "s2")))
            for s in "ab")
    near = _may_be_near(("a_n", "a_s1", "a_s2"), ("b_n", "b_s1", "b_s2"), pct)
    return x, y, (F.col("a_v") == F.col("b_v")) & (F.col("a_label") != F.col("b_label")) & near


def _cross_pairs(lists: DataFrame, pct: int) -> DataFrame:
    """Distinct pairs between components within the (short) lists."""
    x, y, near = _sides(lists, pct)
    return x.join(y, near & (F.col("a") < F.col("b"))).select("a", "b").distinct()


def _live(lists: DataFrame, pct: int) -> DataFrame:
    """The members of the (longer) lists that some other member may be near to."""
    x, y, near = _sides(lists, pct)
    return x.join(y, near, "left_semi").select(F.col("a_v").alias("v"), F.col("a").alias("cls"), F.col("a_n").alias("n"), F.col("a_label").alias("label"))


def _band(n, pct: int):
    """Sizes a pair above the threshold can have lie in one band or in neighbouring ones."""
    return F.floor(F.log(n) / F.lit(max(math.log(100 / pct), 1e-6) * (1 + 1e-9))).cast("long")


def _block_pairs(lists: DataFrame, pct: int) -> tuple[DataFrame, DataFrame]:
    """Blocks of the classes in ``lists`` (cls, label, block), and the pairs of blocks that share a list (b1, b2, pair)."""
    home = stage(lists.groupBy("cls", "label", "n").agg(F.min("v").alias("p")), "near_homes")
    count = home.groupBy("p").agg(F.count(F.lit(1)).alias("c"))
    home = home.join(count, "p").withColumn("band", F.when(F.col("c") > BANDED, _band(F.col("n"), pct)))
    count = home.groupBy("p", "band").agg(F.count(F.lit(1)).alias("m")).select(F.col("p").alias("p2"), F.col("band").alias("band2"), "m")
    home = home.join(count, (F.col("p") == F.col("p2")) & F.col("band").eqNullSafe(F.col("band2")))
    part = F.pmod(F.xxhash64("cls"), F.ceil(F.col("m") / BLOCK).cast("long"))
    home = stage(home.select("cls", "label", "band", F.xxhash64("p", F.coalesce("band", F.lit(-1).cast("long")), part).alias("block")), "near_blocks")
    held = lists.join(home.select("cls", "block", "band"), "cls").select("v", "block", "band").distinct()
    other = held.select(F.col("v").alias("v2"), F.col("block").alias("block2"), F.col("band").alias("band2"))
    alike = held.band.isNull() | other.band2.isNull() | (F.abs(held.band - other.band2) <= 1)
    pair = held.join(other, (held.v == other.v2) & (held.block <= other.block2) & alike).select(
        F.col("block").alias("b1"), F.col("block2").alias("b2")).distinct()
    return home.select("cls", "label", "block"), pair.select("b1", "b2", F.xxhash64("b1", "b2").alias("pair"))


def _blocks(c: _Corpus, lists: DataFrame) -> DataFrame:
    """Links between components found in long lists, compared block by block inside tasks."""
    old = staged_paths(c.docs.sparkSession)
    home, pair = _block_pairs(lists, c.pct)
    pair = stage(pair, "near_block_pairs")
    members = c.sets_of(home.select("cls"), "near_block_members")
    sets = stage(members.join(home, "cls"), "near_block_sets")
    unstage(members)
    sides = pair.select("pair", F.col("b1").alias("block")).union(pair.where("b1 <> b2").select("pair", "b2"))
    links = stage(sides.join(sets, "block").select("pair", "cls", "label", "members")
                       .groupBy("pair").applyInPandas(_block_links(c.pct), "src long, dst long"), "near_block_links")
    drop_stages(c.docs.sparkSession, [p for p in staged_paths(c.docs.sparkSession)[:-1] if p not in old])
    return links


def near_duplicates(docs: DataFrame, width: int = 5, pct: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links texts with ``100 * shared >= pct * union`` over shingles of
    ``width`` words; ``component_id`` is the smallest doc_id reachable.
    """
    c = _Corpus(docs, width, pct)
    lists = _lists_of(c)
    hubs = lists.where(F.col("cls") != F.col("hub")).where(_alike_sizes("n", "hub_n", pct))
    hubs = hubs.select(F.col("hub").alias("a"), F.col("cls").alias("b")).distinct().join(c.signatures("a"), "a").join(c.signatures("b"), "b")
    links = c.confirmed(hubs.where(_may_be_near(("a_n", "a_s1", "a_s2"), ("b_n", "b_s1", "b_s2"), pct)).select("a", "b"), "hubs")
    labels = connected_components(links)

    about = c.classes.select("cls", "s1", "s2").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    known = lists.select("v", "cls", "n").distinct().join(about.withColumn("label", F.coalesce("label", "cls")), "cls")
    known = stage(known, "near_labelled")
    unstage(lists)
    open_ = known.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("l1"), F.max("label").alias("l2"))
    open_ = stage(open_.where("l1 <> l2").select("v", "m"), "near_open")
    held = known.join(open_, "v")
    parts = [links, c.confirmed(_cross_pairs(held.where(F.col("m") <= LIST_ROWS), pct), "cross")]
    if not open_.where(F.col("m") > LIST_ROWS).isEmpty():
        long_ = _live(held.where((F.col("m") > LIST_ROWS) & (F.col("m") <= LIVE_ROWS)), pct)
        long_ = stage(long_.union(held.where(F.col("m") > LIVE_ROWS).select(long_.columns)), "near_long")
        if not long_.isEmpty():
            parts.append(_blocks(c, long_))
        unstage(long_)
    unstage(known, open_)
    if not all(p.isEmpty() for p in parts[1:]):
        labels = connected_components(functools.reduce(DataFrame.union, parts))

    ids = c.classes.select("cls", "rep").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    ids = ids.withColumn("label", F.coalesce("label", "cls"))
    low = ids.groupBy("label").agg(F.min("rep").alias("component_id"))
    ids = stage(ids.join(low, "label").select("cls", "component_id"), "near_component_ids")
    unstage(c.classes, *parts)
    linked = F.expr("n_shingles > 0 and doc_id is not null")
    rows = c.rows.select("doc_id", "n_shingles", F.when(linked, F.col("cls")).alias("cls"))
    out = rows.join(ids, "cls", "left")
    own = F.when(linked, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
