"""Line deduplication with levelled sorted runs of line hashes (DataFrame functions only).

A text is cut at ``\\n``; a line's key is the line without ``[\\x20\\x09-\\x0D]`` at
both ends and with A-Z lowered. A key of at least MIN_CHARS code points that
occurs in two or more documents keeps its lines only in the smallest doc_id
that holds it; all other lines stay.

Documents arrive in batches of ascending doc_id. A run is a table of
(key hash, owner doc_id) sorted by hash. A batch reduces its lines to one row
per key (its smallest doc_id), drops by a merge anti-join every key that a run
already holds, and writes the rest as a run of level 0. Whenever FANOUT runs
share a level they are merged into one sorted run of the next, so a batch
meets O(log batches) runs. Runs never overlap: their union is the owner of
every key, whatever the number of batches.

What a text loses is a set of line numbers, so the work on a document grows
with its lines, however many it has or loses.

Key hashes are two independent 64-bit hashes. Repeated doc_ids are one
document. Rows without doc_id count together as one document after all
others; their lines are still gathered text by text. A null or empty text is
one empty line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import stage

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
_LAST = 2**63 - 1
_SPACES = " \t\n\v\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(_SPACES)), _UPPER, _LOWER)


def key_hash(key: Column) -> Column:
    """Two 64-bit hashes of a key."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def _doc_order() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(_LAST)).alias("doc")


def _text_id(text: Column) -> list[Column]:
    """Two 64-bit hashes of a text; with the document they tell the rows of a repeated or missing doc_id apart."""
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def held_lines(docs: DataFrame) -> DataFrame:
    """(doc, t1, t2, place, h1, h2) of the lines whose key counts; ``place`` is the line's number in its text, from 0."""
    cut = docs.select(_doc_order(), *_text_id(F.col("text")), lines(F.col("text")).alias("all"))   # hashed once a text, not once a line
    line = cut.select("doc", "t1", "t2", F.posexplode("all").alias("place", "line"))
    key = line.select("doc", "t1", "t2", "place", line_key(F.col("line")).alias("key")).where(F.length("key") >= MIN_CHARS)
    return key.select("doc", "t1", "t2", "place", key_hash(F.col("key")).alias("h")).select("doc", "t1", "t2", "place", "h.h1", "h.h2")


def add_batch(levels: dict[int, list[DataFrame]], batch: DataFrame) -> None:
    """Anti-join a batch of held lines with all runs and add the new keys as a run; compact full levels."""
    new = batch.groupBy("h1", "h2").agg(F.min("doc").alias("owner"))
    for run in (r for level in sorted(levels, reverse=True) for r in levels[level]):
        new = new.join(run, ["h1", "h2"], "left_anti")
    levels.setdefault(0, []).append(stage(new.sortWithinPartitions("h1", "h2"), "line_run_0"))
    level = 0
    while len(levels.get(level, ())) >= FANOUT:
        merged = levels[level][0]
        for run in levels[level][1:]:
            merged = merged.union(run)
        merged = merged.repartition(F.col("h1"), F.col("h2")).sortWithinPartitions("h1", "h2")
        levels.setdefault(level + 1, []).append(stage(merged, f"line_run_{level + 1}"))
        levels[level] = []
        level += 1


def owners(held: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(h1, h2, owner) of every key, built batch by batch in ascending document order."""
    cuts = held.select(F.percentile_approx("doc", [i / batches for i in range(1, batches)], 1000).alias("p")).first()["p"] or []
    edges = [None, *sorted(set(cuts)), None]
    levels: dict[int, list[DataFrame]] = {}
    for lo, hi in zip(edges[:-1], edges[1:]):
        part = held
        if lo is not None:
            part = part.where(F.col("doc") > lo)
        if hi is not None:
            part = part.where(F.col("doc") <= hi)
        add_batch(levels, part)
    runs = [r for level in sorted(levels) for r in levels[level]]
    out = runs[0]
    for r in runs[1:]:
        out = out.union(r)
    return out


def _lost(docs: DataFrame, batches: int) -> DataFrame:
    """Per text the places of the lines it loses."""
    held = stage(held_lines(docs), "line_held")
    shared = held.join(owners(held, batches), ["h1", "h2"]).where("doc <> owner")
    return shared.groupBy("doc", "t1", "t2").agg(F.collect_set("place").alias("lost"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(row, kept_text, n_lines, n_dropped): each row of ``docs`` as a struct, with what is left of its text.

    The rows stay in a struct, so no column name of ``docs`` can clash.
    """
    lost = stage(_lost(docs, batches), "line_lost")
    rows = docs.select(F.struct(*docs.columns).alias("row"), _doc_order(), *_text_id(F.col("text")))
    rows = rows.join(lost, ["doc", "t1", "t2"], "left").select("row", "lost", lines(F.col("row.text")).alias("all"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("lost"))
    kept = F.when(F.col("lost").isNull(), F.col("all")).otherwise(F.transform(stay, lambda i: F.get("all", i)))
    out = rows.select("row", "all", kept.alias("kept"))
    return out.select("row", F.array_join("kept", "\n").alias("kept_text"), F.size("all").cast("long").alias("n_lines"),
                      (F.size("all") - F.size("kept")).cast("long").alias("n_dropped"))
