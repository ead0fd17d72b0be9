"""Quality rules and a hashed n-gram log-likelihood ratio.

Unigrams and bigrams (exact case) of every text are hashed into BUCKETS
counts: once for the raw corpus (all documents) and once for a trusted target
(documents labelled good). A document's score is the mean over its n-grams of
``log p_target(bucket) - log p_raw(bucket)``; the target is smoothed towards
the raw distribution with SMOOTHING n-grams per bucket. The ratios are whole
micro-units, so sums and verdicts do not depend on the order of addition.

Documents fall into two halves by a hash of their id, each with its own target
counts, and a document is always scored by the other half's, so that labelled
and unlabelled documents are judged alike.

The threshold is fixed from the labels: of all cut-offs on a grid of
0.01, the one with the least ``REJECT_COST * good rejected + bad kept`` over
the labelled documents that pass the base rules; among equals the lowest.
Every document is then judged against it. Without trusted documents there is
no verdict beyond the base rules; without bad ones nothing is rejected by score.

Counts and scores cover all documents. Only the trusted target is bounded: the
TRUSTED_ROWS labelled documents first in hash order (their ids are broadcast).

Base rules: fewer than MIN_WORDS words, or more than 30 % of the words inside
8-word windows that occur twice or more. Null text has no words. Rows without
doc_id or with a repeated one are judged one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import blocks_of, merged_blocks, stage, whole
from casebook.llm.words import _SPACE, mix, powers, prefix_hash, run_hashes, slices, word_spans

BUCKETS = 1 << 16
SMOOTHING = 4
TRUSTED_ROWS = 50_000
REJECT_COST = 20
MIN_WORDS = 20
WINDOW = 8
MICRO = 1_000_000
COUNT_BLOCK = 4096

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _tokens(data, offsets):
    """Prefix hashes, word starts and ends, word hashes, first word of each row."""
    starts, ends, rows = word_spans(data, offsets)
    p = prefix_hash(data, fold=False)
    _, down = powers(len(data) + 1)
    return p, starts, ends, mix((p[ends] - p[starts]) * down[starts]), rows


def _seen_before(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every value: does it occur twice or more; does it occur earlier."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = np.zeros(len(k) + 1, bool)
    same[1:-1] = k[1:] == k[:-1]
    often, later = np.zeros(len(k), bool), np.zeros(len(k), bool)
    often[order] = same[:-1] | same[1:]
    later[order] = same[:-1]
    return often, later


def text_stats(data, offsets, tokens=None) -> dict[str, np.ndarray]:
    p, starts, ends, h, rows = tokens or _tokens(data, offsets)
    n = len(offsets) - 1
    out = {"n_words": rows[1:] - rows[:-1]}
    out["word_chars"] = _per_row(~_SPACE[data] & ((data & 0xC0) != 0x80), offsets)
    out["n_symbols"] = _per_row(_SYMBOL[data], offsets)

    # lines: cut at \n and at row ends
    _, down = powers(len(data) + 1)
    cut = np.flatnonzero(data == 10)
    first = np.unique(np.concatenate([offsets[:-1], cut + 1]))
    first = first[first < len(data)]
    row = np.searchsorted(offsets, first, "right") - 1
    last = np.minimum(np.append(cut, len(data))[np.searchsorted(cut, first)], offsets[row + 1])
    word = np.searchsorted(starts, last) > np.searchsorted(starts, first)
    first, last, row = first[word], last[word], row[word]
    line = mix(mix((p[last] - p[first]) * down[first]) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, later = _seen_before(line)
    out["n_dup_lines"] = np.bincount(row[later], minlength=n).astype(np.int64)

    repeat = np.zeros(len(h) + 1, np.int64)
    runs = run_hashes(h, WINDOW)
    if len(runs):
        owner = np.repeat(np.arange(n), rows[1:] - rows[:-1])
        inside = owner[:len(runs)] == owner[WINDOW - 1:]
        at = np.flatnonzero(inside)
        often, _ = _seen_before(mix(runs[at] + owner[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        at = at[often]
        repeat += np.bincount(at, minlength=len(repeat)) - np.bincount(at + WINDOW, minlength=len(repeat))
    out["n_repeat_words"] = _per_row(np.cumsum(repeat)[:-1] > 0, rows)
    return out


def _grams(h: np.ndarray, rows: np.ndarray):
    """Buckets of all unigrams and of the bigrams that stay inside a row, with the owner rows of the latter."""
    one = (h >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    two = (run_hashes(h, 2) >> np.uint64(48)).astype(np.int64) & (BUCKETS - 1)
    inside = np.ones(len(two), bool)
    ends = rows[1:-1]
    ends = ends[(ends > 0) & (ends <= len(two))]
    inside[ends - 1] = False
    return one, two, inside


def _half(ids: pa.Array) -> np.ndarray:
    """0 or 1 by a hash of the id (null: as id 0)."""
    return (mix(ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)) >> np.uint64(63)).astype(np.int64)


def _count_grams(batches):
    """A task's n-gram counts: raw, trusted of half 0, trusted of half 1, one after the other."""
    raw, good = np.zeros(BUCKETS, np.int64), np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        trusted = b.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        side = np.where(trusted, _half(b.column("doc_id")), -1)
        for lo, data, off in slices(b.column("text")):
            _, _, _, h, rows = _tokens(data, off)
            one, two, inside = _grams(h, rows)
            mine = np.repeat(side[lo:lo + len(off) - 1], rows[1:] - rows[:-1])
            raw += np.bincount(one, minlength=BUCKETS) + np.bincount(two[inside], minlength=BUCKETS)
            for f in (0, 1):
                good[f] += np.bincount(one[mine == f], minlength=BUCKETS)
                good[f] += np.bincount(two[inside & (mine[:len(two)] == f)], minlength=BUCKETS)
    yield blocks_of(np.concatenate([raw, good[0], good[1]]), COUNT_BLOCK)


def _score(ratio: np.ndarray):
    def run(batches):
        for b in batches:
            side = 1 - _half(b.column("doc_id"))
            for lo, data, off in slices(b.column("text")):
                tokens = _tokens(data, off)
                out = text_stats(data, off, tokens)
                _, _, _, h, rows = tokens
                one, two, inside = _grams(h, rows)
                total = np.zeros(len(h) + 1, np.int64)
                n = out["n_words"]
                model = np.repeat(side[lo:lo + len(n)], n)
                gain = ratio[model, one]
                gain[:len(two)] += np.where(inside, ratio[model[:len(two)], two], 0)
                np.cumsum(gain, out=total[1:])
                cols = [b.column("doc_id").slice(lo, len(n)), *(pa.array(out[k], pa.int64()) for k in STATS),
                        pa.array(total[rows[1:]] - total[rows[:-1]]), pa.array(np.where(n > 0, 2 * n - 1, 0))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", *STATS, "gain", "grams"])
    return run


def ngram_ratios(docs: DataFrame, trusted: DataFrame) -> np.ndarray | None:
    """Log ratio per half and bucket in micro-units; None unless both halves have trusted documents.

    ``trusted`` (doc_id) is bounded by the caller and broadcast.
    """
    marked = docs.select("doc_id", "text").join(F.broadcast(trusted.select("doc_id", F.lit(True).alias("trusted"))), "doc_id", "left")
    marked = marked.select("doc_id", F.coalesce("trusted", F.lit(False)).alias("trusted"), "text")
    got = merged_blocks(marked.mapInArrow(_count_grams, "block long, data binary"), np.int64, np.add)
    raw, *good = whole(got, 3 * BUCKETS, COUNT_BLOCK, np.int64).reshape(3, BUCKETS).astype(float)
    good = np.array(good)
    if not good.sum(axis=1).all():
        return None
    p = (raw + 1) / (raw.sum() + BUCKETS)
    q = (good + SMOOTHING * BUCKETS * p) / (good.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS)
    return np.rint(np.log(q / p) * MICRO).astype(np.int64)


def _threshold(scored: DataFrame, labels: DataFrame) -> int | None:
    """Cut-off in micro-units, from counts per grid cell (their number is bounded by the ratios' range)."""
    cell = F.floor(F.col("gain") / F.col("grams") / (MICRO // 100))
    judged = scored.where("not base_failed").select("doc_id", cell.alias("cell")).join(labels.select("doc_id", "quality"), "doc_id")
    rows = judged.groupBy("cell").agg(F.sum(F.expr("cast(quality = 1 as long)")).alias("good"),
                                      F.sum(F.expr("cast(quality = 0 as long)")).alias("bad")).orderBy("cell").collect()
    bad_kept = sum(r["bad"] or 0 for r in rows)
    if not bad_kept:
        return None
    best, cut, good_lost = bad_kept, None, 0
    for r in rows:                       # cutting above this cell
        good_lost += r["good"] or 0
        bad_kept -= r["bad"] or 0
        if REJECT_COST * good_lost + bad_kept < best:
            best, cut = REJECT_COST * good_lost + bad_kept, (r["cell"] + 1) * (MICRO // 100)
    return cut


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the base statistics, score, base_failed, kept.

    ``labels`` has doc_id and quality (1 good, 0 bad); repeated or
    contradicting labels count as often as they are given, null ones never.
    """
    trusted = (labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()
                     .orderBy(F.xxhash64("doc_id"), "doc_id").limit(TRUSTED_ROWS))
    trusted = stage(trusted, "quality_trusted")
    ratio = ngram_ratios(docs, trusted)
    scored = docs.select("doc_id", "text").mapInArrow(
        _score(np.zeros((2, BUCKETS), np.int64) if ratio is None else ratio),
        "doc_id long, " + ", ".join(f"{k} long" for k in STATS) + ", gain long, grams long")
    scored = stage(scored.withColumn("base_failed", F.expr(
        f"n_words < {MIN_WORDS} or 100 * n_repeat_words > 30 * n_words")), "quality_scored")
    cut = None if ratio is None else _threshold(scored, labels)
    passed = F.lit(True) if cut is None else F.col("gain") >= F.lit(cut) * F.col("grams")
    return scored.select("doc_id", *STATS, "base_failed", (~F.col("base_failed") & passed).alias("kept"),
                         (F.col("gain") / F.greatest(F.col("grams"), F.lit(1)) / MICRO).alias("score"))
