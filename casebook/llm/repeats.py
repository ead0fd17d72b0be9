"""Removal of long repeated byte strings with longest-previous-factor arrays.

A text is its UTF-8 bytes; a window is LENGTH consecutive bytes of one
document. A byte goes if a window that covers it also starts anywhere else, the
same document included (``keep_first``: if it also starts earlier, in the order
of doc_id and position).

A suffix array of a whole corpus cannot be cut into tasks, but only the suffix
order to depth LENGTH matters, and only among windows that can be equal:

1. Anchors. Every window names the KGRAM inside it with the least hash (the
   leftmost of equals); equal windows name equal k-grams at equal places.
   Neighbouring windows share their anchor, so a document falls into stretches
   of about KGRAM / 2 windows, known by (k-gram hash, hash of all the bytes of
   the stretch). These rows, distinct per document, are all that is shuffled.
2. A stretch that occurs twice repeats as a whole. Only k-grams with several
   different stretches need a look inside; one copy of each such stretch is
   fetched.
3. Per k-gram the different stretches are joined into one text, their suffixes
   sorted by prefix doubling to depth LENGTH, and the longest-previous-factor
   array, capped at LENGTH, is read off: in suffix order, with equal prefixes
   in text order, the neighbour before is the previous smaller position and the
   neighbour behind the next occurrence. K-grams with more than GROUP_KINDS
   stretches, which could outgrow a task, take an exact way of their own: their
   windows are sorted by hash across all tasks and compared with their
   neighbours there.
4. Documents with findings cut their own anchors again and remove the bytes.

Null texts are empty. Rows that share a doc_id, or have none, count as
separate places; rows without doc_id come before all others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import BIT_INDEX, bit_set, bits_by, hashed_bit, in_bits, stage
from casebook.llm.words import SLICE_BYTES, mix, powers, prefix_hash, slices

LENGTH = 400
KGRAM = 200
GROUP_KINDS = 2000
SORT_BYTES = 1 << 19
SEGMENT = 4 << 20
_PLACE = np.uint64((1 << 24) - 1)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values."""
    n = len(x)
    pad = -n % w
    full = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    left = np.minimum.accumulate(full, axis=1).ravel()
    right = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n - w + 1], left[w - 1:n])


def stretches(data: np.ndarray, offsets: np.ndarray, length: int, k: int):
    """Stretches of windows with one anchor: row, first window, last window, anchor hash, stretch hash."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    _, down = powers(n + 1)
    p = prefix_hash(data, fold=False)
    gram = mix((p[k:] - p[:-k]) * down[:n - k + 1])
    low = sliding_min((gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64), length - k + 1)
    anchor = (low & _PLACE).astype(np.int64)                 # one per window start
    valid = np.zeros(n + 1, np.int64)                        # windows that stay inside a row
    whole = offsets[1:] - offsets[:-1] >= length
    np.add.at(valid, offsets[:-1][whole], 1)
    np.add.at(valid, offsets[1:][whole] - length + 1, -1)
    valid = np.cumsum(valid)[:len(anchor)] > 0
    change = np.ones(len(anchor), bool)
    change[1:] = (anchor[1:] != anchor[:-1]) | ~valid[:-1]
    first = np.flatnonzero(valid & change)
    stop = np.ones(len(anchor), bool)
    stop[:-1] = change[1:] | ~valid[1:]
    last = np.flatnonzero(valid & stop)
    row = np.searchsorted(offsets, first, "right") - 1
    kind = mix((p[last + length] - p[first]) * down[first])
    place = ((anchor[first] - first) << 32 | (last - first)).astype(np.uint64)
    return row, first, last, gram[anchor[first]], mix(kind + mix(place))


def _pieces(column, length: int):
    """Slices of whole rows; a row beyond SEGMENT bytes in segments that overlap by a window less a byte.

    Yields (first row, data, offsets, position of the first byte in its row).
    """
    for lo, data, off in slices(column, min(SLICE_BYTES, SEGMENT)):
        if len(data) <= SEGMENT:
            yield lo, data, off, 0
            continue
        for s in range(0, len(data), SEGMENT):
            part = data[s:s + SEGMENT + length - 1]
            yield lo, part, np.array([0, len(part)]), s


def _cut(length: int, k: int):
    """Distinct stretches per document, with the number of places (2: two or more) and the first place."""
    def run(batches):
        for b in batches:
            for lo, data, off, base in _pieces(b.column("text"), length):
                row, first, _, f, g = stretches(data, off, length, k)
                if not len(row):
                    continue
                o = np.lexsort((first, g, f, row))
                row, first, f, g = row[o], first[o], f[o], g[o]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (f[1:] != f[:-1]) | (g[1:] != g[:-1])
                at = np.flatnonzero(new)
                count = np.minimum(np.diff(np.append(at, len(row))), 2)
                ids = b.column("doc_id").take(pa.array(lo + row[at]))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(f[at].view(np.int64)), pa.array(g[at].view(np.int64)), pa.array(count, pa.int32()),
                     pa.array(first[at] - off[row[at]] + base)], ["doc_id", "f", "g", "c", "pos"])
    return run


def _fetch(length: int, k: int, docs_bits: np.ndarray, gram_bits: np.ndarray):
    """Bytes of the stretches whose document and k-gram may be wanted."""
    def run(batches):
        for b in batches:
            b = b.filter(pa.array(in_bits(docs_bits, b.column("bit").to_numpy().astype(np.int64))))
            for _, data, off, _ in _pieces(b.column("text"), length) if b.num_rows else ():
                _, first, last, f, g = stretches(data, off, length, k)
                take = in_bits(gram_bits, _gram_number(f))
                if not take.any():
                    continue
                first, last, f, g = first[take], last[take], f[take], g[take]
                key = np.unique(np.stack([f, g]), axis=1, return_index=True)[1]
                first, last, f, g = first[key], last[key], f[key], g[key]
                body = [data[x:y + length].tobytes() for x, y in zip(first.tolist(), last.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.view(np.int64)), pa.array(g.view(np.int64)), pa.array(body, pa.binary())], ["f", "g", "body"])
    return run


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """Rank of every suffix by its first ``depth`` values (prefix doubling); equal prefixes share a rank."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    have = 1
    while have < depth:
        step = min(have, depth - have)                       # overlapping halves end exactly at depth
        ahead = np.zeros(len(rank), np.int64)
        ahead[:-step] = rank[step:] + 1
        key = rank * (len(rank) + 1) + ahead
        rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
        have += step
        if rank.max() == len(rank) - 1:
            break
    return rank


def capped_factors(strings: list[np.ndarray], length: int):
    """Which windows of the strings have an earlier and which a later equal window.

    The strings are joined with separators of their own, suffixes ordered to
    depth ``length``, equal prefixes in text order: a neighbour of equal rank is
    the previous (next) smaller position with a common prefix of ``length``.
    Also gives the index of the first string that holds the window.
    """
    text = np.concatenate([np.append(s.astype(np.int64), 256 + i) for i, s in enumerate(strings)])
    owner = np.repeat(np.arange(len(strings)), [len(s) + 1 for s in strings])
    rank = suffix_ranks(text, length)
    order = np.argsort(rank, kind="stable")
    r = rank[order]
    same = np.zeros(len(r) + 1, bool)
    same[1:-1] = r[1:] == r[:-1]
    earlier, later = np.zeros(len(r), bool), np.zeros(len(r), bool)
    earlier[order], later[order] = same[:-1], same[1:]
    head = np.maximum.accumulate(np.where(~same[:-1], np.arange(len(r)), 0))
    first = np.empty(len(r), np.int64)
    first[order] = owner[order[head]]
    return earlier, later, first


def _intervals(flags: np.ndarray) -> tuple[list, list]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()


def _minus(runs, less) -> tuple[list, list]:
    """The places in ``runs`` that are not in ``less`` (lists of first and last places)."""
    flags = np.zeros(max([*runs[1], *less[1]]) + 1, bool)
    for value, (starts, ends) in ((True, runs), (False, less)):
        for s, e in zip(starts, ends):
            flags[s:e + 1] = value
    return _intervals(flags)


def _found(rows):
    cols = list(zip(*rows)) if rows else [[]] * 6
    kinds = [pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * 4
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, kinds)], ["f", "g", "starts", "ends", "own_starts", "own_ends"])


def _sort_groups(length: int):
    """Repeated windows of the stretches, for rows that come k-gram by k-gram, copies in order of their first place."""
    def solve(rows):
        rows.sort(key=lambda x: (x[0], x[3]))
        strings = [np.frombuffer(x[4], np.uint8) for x in rows]
        earlier, later, first = capped_factors(strings, length)
        out, at = [], 0
        for i, (s, x) in enumerate(zip(strings, rows)):
            many = slice(at, at + len(s) - length + 1)
            dup = earlier[many] | later[many] | (x[2] > 1)
            out.append((x[0], x[1], *_intervals(dup), *_intervals(first[many] == i)))
            at += len(s) + 1
        return _found(out)

    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            for f, g, n, place, body in zip(*(b.column(c).to_pylist() for c in ("f", "g", "n", "first", "body"))):
                if size >= SORT_BYTES and f != last:
                    yield solve(held)
                    held, size = [], 0
                held.append((f, g, n, (place["doc_id"] is not None, place["doc_id"] or 0, place["pos"]), body))
                size, last = size + len(body), f
        if held:
            yield solve(held)
    return run


def _windows(length: int):
    """One row per window of the stretches of very frequent k-grams: two hashes and where it belongs."""
    def run(batches):
        for b in batches:
            for f, g, n, place, body in zip(*(b.column(c).to_pylist() for c in ("f", "g", "n", "first", "body"))):
                data = np.frombuffer(body, np.uint8)
                p, q = prefix_hash(data, False), prefix_hash(255 - data, False)
                _, down = powers(len(data) + 1)
                m = len(data) - length + 1
                w1, w2 = mix((p[length:] - p[:m]) * down[:m]), mix(mix((q[length:] - q[:m]) * down[:m]) + np.uint64(7))
                full = lambda v, t: pa.array(np.full(m, v), t)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), full(f, pa.int64()), full(g, pa.int64()), full(n, pa.int64()),
                     pa.array([place["doc_id"]] * m, pa.int64()), full(place["pos"], pa.int64()), pa.array(np.arange(m), pa.int32())],
                    ["w1", "w2", "f", "g", "n", "doc_id", "pos", "at"])
    return run


def _equal_neighbours(batches):
    """Rows sorted by window hash and first place: (f, g, at, repeated, first of its kind)."""
    held = None                                       # the last row, until its successor is known

    def batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["f", "g", "at", "dup", "own"])
    for b in batches:
        out = []
        for w1, w2, f, g, n, at in zip(*(b.column(c).to_pylist() for c in ("w1", "w2", "f", "g", "n", "at"))):
            same = held is not None and held[0] == (w1, w2)
            if held is not None:
                out.append((*held[1], held[2] or same, held[3]))
            held = ((w1, w2), (f, g, at), n > 1 or same, not same)
        yield batch(out)
    if held is not None:
        yield batch([(*held[1], held[2], held[3])])


def _remove(length: int, k: int, keep_first: bool):
    """Cuts the anchors again, marks the bytes of repeated windows and drops them."""
    def run(batches):
        for b in batches:
            marks = b.column("marks")
            removed = [np.zeros(0, bool)] * b.num_rows
            for lo, data, off, base in _pieces(b.column("text"), length):
                row, first, last, f, g = stretches(data, off, length, k)
                edge = np.zeros(len(data) + 1, np.int64)
                bounds = np.searchsorted(row, np.arange(len(off)))
                for r in range(len(off) - 1):
                    found = marks[lo + r].as_py()
                    if not found:
                        continue
                    table = {(x["f"], x["g"]): x for x in found}
                    me = b.column("doc_id")[lo + r].as_py()
                    for i in range(bounds[r], bounds[r + 1]):
                        x = table.get((int(f[i].view(np.int64)), int(g[i].view(np.int64))))
                        if x is None:
                            continue
                        whole = [0], [int(last[i] - first[i])]
                        runs = (x["starts"], x["ends"]) if x["starts"] is not None else whole
                        if keep_first and x["doc_id"] == me and x["pos"] == int(first[i] - off[r]) + base:
                            runs = _minus(runs, (x["own_starts"], x["own_ends"]) if x["starts"] is not None else whole)
                        for s, e in zip(*runs):
                            edge[first[i] + s] += 1
                            edge[first[i] + e + length] -= 1
                gone = np.cumsum(edge)[:-1] > 0
                for r in range(len(off) - 1):
                    mine = gone[off[r]:off[r + 1]]
                    old = removed[lo + r]
                    if base:                          # segments overlap
                        both = old[base:].copy()
                        mine = mine.copy()
                        mine[:len(both)] |= both
                        mine = np.concatenate([old[:base], mine])
                    removed[lo + r] = mine
            starts, ends, kept = [], [], []
            for i, text in enumerate(b.column("text")):
                s, e = _intervals(removed[i])
                starts.append(s)
                ends.append([x + 1 for x in e])
                raw = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                kept.append(raw[~removed[i]].tobytes() if len(s) else raw.tobytes())
            spans = pa.array([[{"start": x, "end": y} for x, y in zip(s, e)] for s, e in zip(starts, ends)],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), spans, pa.array(kept, pa.binary())], ["doc_id", "spans", "kept"])
    return run


def _only(bits: np.ndarray, inside: bool):
    def run(batches):
        for b in batches:
            here = in_bits(bits, b.column("bit").to_numpy().astype(np.int64))
            yield b.filter(pa.array(here if inside else ~here)).select(["doc_id", "text"])
    return run


def _gram_bits(grams: DataFrame) -> np.ndarray:
    """Bit set of k-gram hashes, numbered as in ``_fetch``."""
    return bits_by(grams.select("f"), lambda b: _gram_number(b.column("f").to_numpy().view(np.uint64)))


def _gram_number(f: np.ndarray) -> np.ndarray:
    return (mix(f) >> np.uint64(64 - BIT_INDEX)).astype(np.int64)


def _findings(docs: DataFrame, length: int, k: int, keep_first: bool):
    """(rows, status): the documents' stretches, and what is repeated in each kind of stretch."""
    rows = stage(docs.mapInArrow(_cut(length, k), "doc_id long, f long, g long, c int, pos long"), "repeat_stretches")
    kinds = (rows.groupBy("f", "g").agg(F.sum("c").alias("n"), F.min(F.struct("doc_id", "pos")).alias("first")))
    grams = rows.groupBy("f").agg(F.sum("c").alias("n"), F.min("g").alias("g1"), F.max("g").alias("g2")).where("n > 1")
    kinds = stage(kinds.join(grams.select("f", F.expr("g1 <> g2").alias("mixed")), "f"), "repeat_kinds")

    per_gram = kinds.where("mixed").groupBy("f").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
    wanted = per_gram if keep_first else per_gram.where("least = 1")
    wanted = stage(kinds.join(wanted, "f").select("f", "g", "n", "first", "kinds"), "repeat_mixed")
    plain = kinds.where("n > 1").join(wanted.select("f", "g"), ["f", "g"], "left_anti").select(
        "f", "g", "first", *(F.lit(None).cast("array<int>").alias(c) for c in ("starts", "ends", "own_starts", "own_ends")))
    if wanted.isEmpty():
        return rows, stage(plain, "repeat_status")
    bits = bit_set(wanted.select(F.col("first.doc_id").alias("doc_id")), "doc_id")
    bodies = (docs.withColumn("bit", hashed_bit("doc_id")).mapInArrow(
        _fetch(length, k, bits, _gram_bits(wanted)), "f long, g long, body binary"))
    got = stage(wanted.join(bodies, ["f", "g"]).dropDuplicates(["f", "g"]), "repeat_bodies")
    out = "f long, g long, starts array<int>, ends array<int>, own_starts array<int>, own_ends array<int>"
    found = (got.where(F.col("kinds") <= GROUP_KINDS).drop("kinds").repartition("f").sortWithinPartitions("f")
                .mapInArrow(_sort_groups(length), out))
    many = got.where(F.col("kinds") > GROUP_KINDS)
    if not many.isEmpty():
        each = many.drop("kinds").mapInArrow(_windows(length), "w1 long, w2 long, f long, g long, n long, doc_id long, pos long, at int")
        each = each.repartition("w1", "w2").sortWithinPartitions("w1", "w2", F.col("doc_id").asc_nulls_first(), "pos")
        marks = each.mapInArrow(_equal_neighbours, "f long, g long, at int, dup boolean, own boolean")
        marks = marks.where("dup").groupBy("f", "g").agg(
            F.sort_array(F.collect_list("at")).alias("starts"), F.sort_array(F.collect_list(F.when(F.col("own"), F.col("at")))).alias("own_starts"))
        found = found.union(marks.select("f", "g", "starts", F.col("starts").alias("ends"), "own_starts", F.col("own_starts").alias("ends2")))
    found = found.where(F.size("starts") > 0).join(wanted.select("f", "g", "first"), ["f", "g"])
    return rows, stage(plain.union(found.select("f", "g", "first", "starts", "ends", "own_starts", "own_ends")), "repeat_status")


def remove_repeats(docs: DataFrame, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, spans (maximal removed byte runs), kept (remaining bytes)."""
    docs = docs.select("doc_id", "text")
    k = length // 2
    rows, status = _findings(docs, length, k, keep_first)
    hits = rows.select("doc_id", "f", "g").join(status, ["f", "g"])
    mark = F.struct("f", "g", F.col("first.doc_id").alias("doc_id"), F.col("first.pos").alias("pos"), "starts", "ends", "own_starts", "own_ends")
    marks = stage(hits.groupBy("doc_id").agg(F.collect_list(mark).alias("marks")), "repeat_marks")
    bits = bit_set(marks, "doc_id")
    seen = docs.withColumn("bit", hashed_bit("doc_id"))
    touched = seen.mapInArrow(_only(bits, True), "doc_id long, text string")
    marks = marks.withColumnRenamed("doc_id", "marked")
    touched = touched.join(marks, F.col("doc_id").eqNullSafe(F.col("marked")), "left").select("doc_id", "text", "marks")
    schema = "doc_id long, spans array<struct<start: long, end: long>>, kept binary"
    touched = touched.mapInArrow(_remove(length, k, keep_first), schema)
    others = seen.mapInArrow(_only(bits, False), "doc_id long, text string")
    others = others.select("doc_id", F.array().cast("array<struct<start: long, end: long>>").alias("spans"),
                           F.coalesce("text", F.lit("")).cast("binary").alias("kept"))
    return touched.union(others)
