"""The trie of conversation prefixes, with singletons screened out by a count-min sketch.

A prefix of d turns is known by d and two 64-bit sums (exclusive or) over its
turns, each hashed with its place, role and text. Most prefixes of a corpus
belong to one conversation only. A count-min sketch over all prefixes is never
too low, so an estimate of one proves a singleton: its node is written by the
task that reads it. Only prefixes that may be shared are grouped exactly.

For these, the smallest member owns the node. A conversation owns the nodes of
its path from some depth on, and its owned nodes form one chain that hangs on
a node of a smaller conversation. So what a chain sums up (saved tokens, its
leaf) is added once for every member row above it, and totals over subtrees
need one grouping, no walk from node to node. Groups are aggregated before
they are shuffled, owners of large groups come back by a broadcast of a bounded
number of nodes, and sums along a conversation are cut into stretches of turns.

Results for odd input: rows without conv_id belong to no conversation and are
left out; null roles and texts are empty; null turns come first; turns with
equal numbers follow each other by role, then by the hash of the text, and
repeated rows are turns of their own; other columns are not read; an empty
table has no nodes. Texts of any length enter by their hash only.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from casebook.llm.common import stage
from casebook.llm.sketch import CountMin, cells_for
from casebook.llm.words import mix
from casebook.operators.broadcast import broadcast_if_small
from casebook.operators.rowid import row_number_by

WORD = r"[^\x20\x09-\x0D]+"
STRETCH = 1024                      # turns of one conversation that are summed up in one group
SKETCH_BITS = (12, 25)              # cells of a sketch row: at most 2**25, 64 MB for both rows
LARGE_NODES = 10_000                # at most so many owners are broadcast
PIECE = 4096                        # conversation ids in one piece of a list to be hashed


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, k, turn_hash, words)``: turns numbered from 1; texts are read here and not again."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    t = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("_turn"), role.alias("_role"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("turn_hash"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    return row_number_by(t, "conv_id", [F.asc_nulls_first("_turn"), "_role", "turn_hash"], "k", "llm/trie_turns").drop("_turn", "_role")


def shared_heads(turns: DataFrame, family: int = 20, heads: int = 4) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with the first turns of their family's first one.

    ``(conv_id, depth, turn_hash, words, length)`` and ``(conv_id, length)``: the first
    h = crc32(conv_id) % heads turns are those of conversation conv_id - conv_id % family
    (all if it has fewer), the others the conversation's own after its first h.
    """
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h")
    convs = turns.groupBy("conv_id").agg(F.max("k").alias("own")).select(
        "conv_id", "own", (F.col("conv_id") - F.col("conv_id") % family).alias("base"), h)
    first = turns.where((F.col("conv_id") % family == 0) & (F.col("k") < heads)).withColumnRenamed("conv_id", "base")
    lent = convs.select(F.col("conv_id").alias("base"), F.least(F.col("own"), F.lit(heads - 1)).alias("lent"))
    convs = convs.join(lent, "base", "left").withColumn("given", F.least("h", F.coalesce("lent", F.lit(0))))
    convs = stage(convs.select("conv_id", "base", "h", "given", (F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "trie_convs")
    head = convs.join(first, "base").where("k <= h").select("conv_id", F.col("k").alias("depth"), "turn_hash", "words", "length")
    rest = turns.join(convs, "conv_id").where("k > h").select("conv_id", (F.col("k") - F.col("h") + F.col("given")).alias("depth"), "turn_hash", "words", "length")
    return head.unionAll(rest), convs.select("conv_id", "length")


def along(rows: DataFrame, names: list[str], total, combine, down: bool = False) -> DataFrame:
    """``names`` as running totals along every conversation, by depth (from the end with ``down``).

    Done in stretches: no sorted group holds more than STRETCH rows, and a
    conversation's stretches are summed up from one row each. ``total`` is the
    aggregate (F.sum or F.bit_xor), ``combine`` adds two of its values.
    """
    turn = F.desc if down else F.asc
    rows = rows.withColumn("_stretch", F.floor(F.col("depth") / STRETCH))
    inner = W.partitionBy("conv_id", "_stretch").orderBy(turn("depth")).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("conv_id").orderBy(turn("_stretch")).rowsBetween(W.unboundedPreceding, -1)
    long = rows.where(F.col("length") >= STRETCH).groupBy("conv_id", "_stretch").agg(*(total(c).alias(f"_{c}") for c in names))
    long = long.select("conv_id", "_stretch", *(total(f"_{c}").over(before).alias(f"_{c}") for c in names))
    out = rows.select("*", *(total(c).over(inner).alias(f"_in_{c}") for c in names)).join(long, ["conv_id", "_stretch"], "left")
    return out.select(*(c for c in rows.columns if c != "_stretch" and c not in names),
                      *(combine(F.col(f"_in_{c}"), F.coalesce(f"_{c}", F.lit(0).cast("long"))).alias(c) for c in names))


def prefixes(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv_id, depth, length, words, a, b)``: every prefix with its hashes, the empty one included."""
    hashed = rebuilt.select("conv_id", "depth", "length", "words", F.xxhash64("depth", "turn_hash").alias("a"),
                            F.xxhash64("turn_hash", "depth", F.lit("b")).alias("b"))
    zero = F.lit(0).cast("long")
    root = convs.select("conv_id", zero.alias("depth"), "length", zero.alias("words"), zero.alias("a"), zero.alias("b"))
    return along(hashed, ["a", "b"], F.bit_xor, Column.bitwiseXOR).unionByName(root)


def _hash(b: pa.RecordBatch) -> np.ndarray:
    a, c, d = (b.column(k).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for k in ("a", "b", "depth"))
    return mix(a + mix(c + d * np.uint64(0x9E3779B97F4A7C15)))


def _screen(sketch):
    def run(batches):
        for b in batches:
            shared = (sketch.estimate(_hash(b)) > 1) | (b.column("depth").to_numpy() == 0)
            yield b.append_column("shared", pa.array(shared))
    return run


def _lists(batches):
    """Sorted (owner, depth, conv_id) rows as pieces of comma-joined ids."""
    for b in batches:
        cols = [b.column(k).to_numpy() for k in ("owner", "depth", "conv_id")]
        ends = np.append(np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1, len(cols[0]))
        out, at = [], 0
        for e in ends.tolist():
            for lo in range(at, e, PIECE):
                ids = cols[2][lo:min(e, lo + PIECE)].tolist()
                out.append((cols[0][lo], cols[1][lo], ids[0], ",".join(map(str, ids))))
            at = e
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [()] * 4, kinds)], ["owner", "depth", "first", "ids"])


def _digests(batches):
    """One SHA-256 a node over its pieces in order; only the running digest is held."""
    key, state = None, None

    def rows(done):
        return pa.RecordBatch.from_arrays([pa.array([d[0][0] for d in done], pa.int64()), pa.array([d[0][1] for d in done], pa.int64()),
                                           pa.array([d[1] for d in done], pa.string())], ["owner", "depth", "ends_sha256"])
    for b in batches:
        done = []
        for owner, depth, ids in zip(b.column("owner").to_pylist(), b.column("depth").to_pylist(), b.column("ids").to_pylist()):
            if key == (owner, depth):
                state.update(b"," + ids.encode())
            else:
                if key is not None:
                    done.append((key, state.hexdigest()))
                key, state = (owner, depth), hashlib.sha256(ids.encode())
        yield rows(done)
    if key is not None:
        yield rows([(key, state.hexdigest())])


def _owned(shared: DataFrame) -> DataFrame:
    """Every possibly shared prefix row with its node's owner, number of members and longest member.

    Large nodes (a bounded number: rows / LARGE_NODES members or more) come back by a
    broadcast, so no join key is hot.
    """
    nodes = stage(shared.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n_convs"),
                                                       F.max("length").alias("longest")), "trie_nodes")
    total = nodes.agg(F.sum("n_convs")).first()[0] or 0
    least = max(64, -(-total // LARGE_NODES))
    large = stage(nodes.where(F.col("n_convs") >= least), "trie_large")
    marked = shared.join(broadcast_if_small(large), ["depth", "a", "b"], "left")
    rest = marked.where("owner is null").drop("owner", "n_convs", "longest").join(nodes.where(F.col("n_convs") < least), ["depth", "a", "b"])
    return marked.where("owner is not null").unionByName(rest).drop("a", "b")


def trie(rebuilt: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node: ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``.

    ``rebuilt`` and ``convs`` as ``shared_heads`` returns them.
    """
    p = stage(prefixes(rebuilt, convs), "trie_prefixes")
    sketch = CountMin(p.where("depth > 0").select("depth", "a", "b"), _hash, cells_for(p.count(), 4, *SKETCH_BITS))
    p = stage(p.mapInArrow(_screen(sketch), "conv_id long, depth long, length long, words long, a long, b long, shared boolean"), "trie_screened")
    owned = stage(_owned(p.where("shared").drop("shared")), "trie_owned")
    own = F.col("owner") == F.col("conv_id")
    # every conversation: where its chain hangs, what the chain saves, whether it ends in a leaf
    chain = owned.groupBy("conv_id").agg(
        F.max("length").alias("length"), F.max(F.when(~own, F.col("depth"))).alias("up"), F.max_by(F.when(~own, F.col("owner")), F.when(~own, F.col("depth"))).alias("host"),
        F.sum(F.when(own, (F.col("n_convs") - 1) * F.col("words")).otherwise(0)).alias("chain_saved"),
        F.max(F.when(F.col("depth") == F.col("length"), (own & (F.col("longest") == F.col("length"))).cast("int"))).alias("leaf"))
    chain = stage(chain.withColumn("leaf", F.coalesce("leaf", F.lit(1))), "trie_chains")
    # a chain's saving from each of its nodes down
    below = along(owned.where(own).select("conv_id", "depth", "length", ((F.col("n_convs") - 1) * F.col("words")).alias("saved")),
                  ["saved"], F.sum, Column.__add__, down=True).select("conv_id", "depth", F.col("saved").alias("saved_below"))
    rows = owned.join(chain.drop("length"), "conv_id").join(below, ["conv_id", "depth"], "left")
    hangs = ~own & (F.col("up") == F.col("depth")) & (F.col("up") < F.col("length"))
    goes_on = own & (F.col("length") > F.col("depth"))
    nodes = rows.groupBy(F.col("owner").alias("conv_id"), "depth").agg(
        F.max(F.when(own & (F.col("depth") > 0), F.when(F.col("up") + 1 == F.col("depth"), F.col("host")).otherwise(F.col("conv_id")))).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.sum((hangs | goes_on).cast("long")).alias("n_children"), F.sum(F.col("leaf").cast("long")).alias("n_leaves"),
        F.sum(F.when(own, F.col("saved_below")).otherwise(F.col("chain_saved"))).alias("saved_tokens"))
    ends = owned.where("depth = length").select("owner", "depth", "conv_id").orderBy("owner", "depth", "conv_id")
    ends = ends.mapInArrow(_lists, "owner long, depth long, first long, ids string").repartition("owner", "depth")
    ends = ends.sortWithinPartitions("owner", "depth", "first").mapInArrow(_digests, "owner long, depth long, ends_sha256 string").withColumnRenamed("owner", "conv_id")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    nodes = nodes.join(ends, ["conv_id", "depth"], "left").withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
    # singletons, written where they are read; only the first of each chain looks up its host
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    hosts = chain.where("up is not null").select("conv_id", (F.col("up") + 1).alias("depth"), "host")
    singles = p.where("not shared").join(hosts, ["conv_id", "depth"], "left").select(
        "conv_id", "depth", F.coalesce("host", "conv_id").alias("parent_conv_id"), one.alias("n_convs"),
        F.when(F.col("depth") < F.col("length"), one).otherwise(zero).alias("n_children"), one.alias("n_leaves"), zero.alias("saved_tokens"),
        F.when(F.col("depth") < F.col("length"), nothing).otherwise(F.sha2(F.col("conv_id").cast("string"), 256)).alias("ends_sha256"))
    return nodes.unionByName(singles)


def prefix_trie(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """The trie of the rebuilt conversations of ``conversations`` (conv_id, turn, role, text)."""
    return trie(*shared_heads(turns_of(conversations), family, heads))
