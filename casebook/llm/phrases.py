"""Phrase collocations by language, counted over a prefix-free parse of the corpus.

Texts are cut into pieces (at ``.,;:!?`` and line ends) and words. A word whose
hash is divisible by PERIOD starts a new chunk wherever it stands, so equal
stretches of text are cut alike. A chunk runs on for LONGEST - 1 words into the
next one; what starts there belongs to the next chunk, so every occurrence of a
phrase lies in exactly one chunk's own part. That part can be told from the
chunk alone (it ends before the next trigger word). Equal chunks become one
dictionary row with a frequency, and phrases are counted once per distinct
chunk, times its frequency: repeated text costs nothing more.

Phrases are counted by length. A phrase can only be frequent if its first and
its last n - 1 words are, so each pass asks a bit set of the frequent shorter
phrases first (bounded in size; it may let a few more through, never fewer) and
the counts after the shuffle are exact. Phrases are lists of 64-bit word
numbers; two frequent words with one number would show in the dictionary of
words, and the numbering is then changed, so counts are those of the words.

Results for odd input: null text is empty, null lang is ``und``; repeated rows
count each time; doc_id and other columns are not read; a piece without words
gives nothing; an empty table gives an empty result. Long texts are cut into
chunks like any other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from casebook.llm.common import stage
from casebook.llm.sketch import Bits, cells_for
from casebook.llm.words import mix, powers, prefix_hash, slices, spans
from casebook.operators.broadcast import broadcast_if_small
from casebook.operators.rowid import row_number_by

PERIOD = 16                          # a new chunk every so many words, on average
LONGEST = 4
LEAST = 30
NESTED_PCT = 80
TOP = 2000
SET_BITS = (16, 27)                  # bits of a set of frequent phrases: at most 2**27, 16 MB
SLICE = 4 << 20
CHECK_SALT = 1 << 40                 # a second hash that tells words of one number apart


def _bytes(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


BLANK = _bytes(b" \t")
BORDER = _bytes(b".,;:!?\n\x0b\x0c\r")
SPACE = _bytes(b" ")


def _words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray):
    """Start, end, first word of each row and hash of the words; A-Z count as a-z."""
    starts, ends, rows = spans(data, offsets, breaks)
    _, down = powers(len(data) + 1)
    p = prefix_hash(data, True)
    return starts, ends, rows, mix((p[ends] - p[starts]) * down[starts])


def _triggers(h: np.ndarray, period: int) -> np.ndarray:
    return h % np.uint64(period) == 0


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """lo[0], lo[0]+1, ... (n[0] of them), lo[1], ..."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) + np.repeat(lo - (ends - n), n)


def chunk_strings(data: np.ndarray, offsets: np.ndarray, period: int) -> pa.Array:
    """The chunks of some texts: words in lower case, one blank between them."""
    starts, ends, rows, h = _words(data, offsets, BLANK | BORDER)
    if not len(starts):
        return pa.array([], pa.large_string())
    borders = np.concatenate([[0], np.cumsum(BORDER[data])])
    new_piece = np.ones(len(starts), bool)
    new_piece[1:] = borders[starts[1:]] > borders[ends[:-1]]
    new_piece[rows[:-1][rows[:-1] < len(starts)]] = True
    first = np.flatnonzero(new_piece | _triggers(h, period))
    piece_ends = np.append(np.flatnonzero(new_piece)[1:], len(starts))
    piece_end = piece_ends[np.cumsum(new_piece)[first] - 1]
    n = np.minimum(np.append(first[1:], len(starts)) + LONGEST - 1, piece_end) - first
    word = _ranges(first, n)
    size = ends[word] - starts[word] + 1
    size[np.cumsum(n) - 1] -= 1                          # no blank after the last word
    at = np.cumsum(size)
    source = _ranges(starts[word], size)
    text = data[np.minimum(source, len(data) - 1)]
    text = np.where((text >= 0x41) & (text <= 0x5A), text + 32, text).astype(np.uint8)
    blank = np.ones(len(word), bool)
    blank[np.cumsum(n) - 1] = False
    text[at[blank] - 1] = 0x20
    bounds = np.concatenate([[0], at[np.cumsum(n) - 1]]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(bounds.tobytes()), pa.py_buffer(text.tobytes()))


def _by_lang(table, column: str):
    langs = table.column("lang")
    for lang in pc.unique(langs).to_pylist():
        yield lang, table.filter(pc.equal(langs, lang))


def _parse(period: int):
    def run(batches):
        for b in batches:
            for lang, rows in _by_lang(b, "text"):
                for _, data, offsets in slices(rows.column("text")):
                    found = chunk_strings(data, offsets, period).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), found], ["lang", "chunk"])
    return run


def parse(docs: DataFrame, period: int = PERIOD) -> DataFrame:
    """The dictionary: ``(lang, chunk, n)``, n the number of times the chunk occurs."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.mapInArrow(_parse(period), "lang string, chunk string").groupBy("lang", "chunk").agg(F.count(F.lit(1)).alias("n"))


# ---- counting ------------------------------------------------------------------
def _lang_seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


def _gram(words: list[np.ndarray], seed) -> np.ndarray:
    """Hash of phrases given word by word."""
    h = np.full(len(words[0]), seed, np.uint64) if np.ndim(seed) == 0 else seed
    for w in words:
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + w)
    return h


def _batches(batches, size: int):
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.nbytes
        if n >= size:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray, salt: int) -> np.ndarray:
    """Word numbers: the hashes, or with a salt hashes from other values for the bytes."""
    if not salt:
        return h
    up, down = powers(len(data) + 1)
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(mix(data.astype(np.uint64) + np.uint64(salt << 8)) * up[:len(data)], out=p[1:])
    return mix((p[ends] - p[starts]) * down[starts])


def _pieces(batches, period: int, salt: int):
    """Of each lang and slice of the dictionary: bytes, word spans, numbers, end of each word's chunk, own part, frequency."""
    for t in _batches(batches, SLICE):
        for lang, rows in _by_lang(t, "chunk"):
            freq = rows.column("n").to_numpy()
            for lo, data, offsets in slices(rows.column("chunk"), SLICE):
                starts, ends, first, h = _words(data, offsets, SPACE)
                n = np.diff(first)
                trig = _triggers(h, period)
                trig[first[:-1]] = False
                hits = np.append(np.flatnonzero(trig), len(h))
                own_end = np.minimum(hits[np.searchsorted(hits, first[:-1])], first[1:])
                at = np.arange(len(h))
                yield (lang, data, starts, ends, _numbers(data, starts, ends, h, salt), np.repeat(first[1:], n),
                       at < np.repeat(own_end, n), np.repeat(freq[lo:lo + len(n)], n))


def _vocabulary(period: int, salt: int):
    def run(batches):
        for lang, data, starts, ends, w, _, own, n in _pieces(batches, period, salt):
            at = np.flatnonzero(own)
            u, first, inv = np.unique(w[at], return_index=True, return_inverse=True)
            total = np.bincount(inv, n[at], len(u)).astype(np.int64)
            check = _numbers(data, starts[at], ends[at], None, CHECK_SALT)
            clash = np.flatnonzero(check != check[first][inv])       # another word with this number: shown, not counted twice
            first = at[np.append(first, clash)]
            u, total = w[first], np.append(total, np.zeros(len(clash), np.int64))
            text = [bytes(data[s:e]) for s, e in zip(starts[first].tolist(), ends[first].tolist())]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), pa.array(u.view(np.int64)),
                                              pa.array(text, pa.binary()).cast(pa.string()), pa.array(total)], ["lang", "w1", "word", "n"])
    return run


def _phrases(size: int, shorter: Bits, period: int, salt: int):
    def run(batches):
        for lang, _, _, _, w, end, own, n in _pieces(batches, period, salt):
            if len(w) < size:
                continue
            last = len(w) - size + 1
            known = shorter.holds(_gram([w[k:len(w) - size + 2 + k] for k in range(size - 1)], _lang_seed(lang)))
            at = np.flatnonzero(own[:last] & (np.arange(size, len(w) + 1) <= end[:last]) & known[:last] & known[1:last + 1])
            numbers = np.unique(w, return_inverse=True)[1]
            many = int(numbers.max()) + 1
            code = numbers[at]
            for k in range(1, size):                     # exact codes: renumbered before they outgrow 62 bits
                if len(code) and (int(code.max()) + 1) * many >= 1 << 62:
                    code = np.unique(code, return_inverse=True)[1]
                code = code * many + numbers[at + k]
            u, first, inv = np.unique(code, return_index=True, return_inverse=True)
            total = np.bincount(inv, n[at], len(u)).astype(np.int64)
            words = [pa.array(w[at[first] + k].view(np.int64)) for k in range(size)]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(u), pa.string()), *words, pa.array(total)],
                                             ["lang", *(f"w{k + 1}" for k in range(size)), "n"])
    return run


def _bits(frequent: DataFrame, size: int) -> Bits:
    def hash_of(b):
        langs = b.column("lang").to_pylist()
        seeds = {x: _lang_seed(x) for x in set(langs)}
        words = [b.column(f"w{k + 1}").to_numpy(zero_copy_only=False).view(np.uint64) for k in range(size)]
        return _gram(words, np.array([seeds[x] for x in langs], np.uint64))
    return Bits(frequent, hash_of, cells_for(frequent.count(), 16, *SET_BITS))


def frequent_phrases(dictionary: DataFrame, least: int = LEAST, period: int = PERIOD):
    """``(lang, g, f)`` for every phrase of 1 to LONGEST words with f >= least (g: its word numbers),
    ``(lang, w1, word)`` of the frequent words, and ``(lang, n)``, all word occurrences."""
    salt = 0
    while True:
        words = stage(dictionary.mapInArrow(_vocabulary(period, salt), "lang string, w1 long, word string, n long")
                      .groupBy("lang", "w1").agg(F.sum("n").alias("f"), F.min("word").alias("word"), F.max("word").alias("other")), "phrase_words")
        if words.where(f"f >= {least} and word <> other").isEmpty():
            break
        salt += 1                                        # two words share a number: number them anew
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = words.where(F.col("f") >= least)
    levels = [found.select("lang", F.array("w1").alias("g"), "f")]
    for size in range(2, LONGEST + 1):
        cols = [f"w{k + 1}" for k in range(size)]
        schema = ", ".join(["lang string", *(f"{c} long" for c in cols), "n long"])
        shorter = _bits(found.select("lang", *cols[:-1]), size - 1)
        found = stage(dictionary.mapInArrow(_phrases(size, shorter, period, salt), schema)
                      .groupBy("lang", *cols).agg(F.sum("n").alias("f")).where(F.col("f") >= least), f"phrase_counts_{size}")
        levels.append(found.select("lang", F.array(*cols).alias("g"), "f"))
    grams = levels[0]
    for x in levels[1:]:
        grams = grams.unionAll(x)
    return grams, words.where(F.col("f") >= least).select("lang", "w1", "word"), totals


# ---- scores --------------------------------------------------------------------
def _inner(g: Column) -> Column:
    """The contiguous parts of 2 words or more of a phrase, itself left out."""
    starts = F.sequence(F.lit(1), F.size(g) - 1)
    return F.flatten(F.transform(starts, lambda s: F.transform(
        F.filter(F.sequence(F.lit(2), F.size(g) - 1), lambda n: (s + n - 1 <= F.size(g))), lambda n: F.slice(g, s, n))))


def score(grams: DataFrame) -> DataFrame:
    """Candidates that no longer phrase explains: ``(lang, g, a, l, r, score)`` at their weakest cut."""
    cand = grams.where(F.size("g") > 1).withColumnRenamed("f", "a")
    cuts = cand.select("lang", "g", "a", F.explode(F.sequence(F.lit(1), F.size("g") - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("g", F.lit(1), F.col("k")).alias("left"), F.slice("g", F.col("k") + 1, F.size("g") - F.col("k")).alias("right"))
    part = {s: grams.select("lang", F.col("g").alias(s), F.col("f").alias(s[0])) for s in ("left", "right")}
    cuts = cuts.join(part["left"], ["lang", "left"]).join(part["right"], ["lang", "right"])
    value = F.expr("(cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0))) div (cast(l as decimal(18,0)) + cast(r as decimal(18,0)))")
    best = cuts.groupBy("lang", "g").agg(F.min(F.struct(value.alias("score"), "k", "l", "r", "a")).alias("x"))
    longer = grams.where(F.size("g") > 2).select("lang", F.explode(_inner(F.col("g"))).alias("g"), "f")
    longer = longer.groupBy("lang", "g").agg(F.max("f").alias("longer"))
    kept = best.join(longer, ["lang", "g"], "left").where(F.coalesce(100 * F.col("longer") < NESTED_PCT * F.col("x.a"), F.lit(True)))
    return kept.select("lang", "g", "x.a", "x.l", "x.r", "x.score")


def spelled(phrases: DataFrame, words: DataFrame) -> DataFrame:
    """Word numbers of ``g`` as text, in ``phrase``."""
    each = phrases.select("lang", "g", F.posexplode("g").alias("at", "w1")).join(words, ["lang", "w1"])
    text = each.groupBy("lang", "g").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    return phrases.join(text, ["lang", "g"])


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, period: int = PERIOD) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of each lang.

    ``score`` is a's share of its parts' occurrences at the weakest cut, in
    half-millionths; ranked by score, occurrences and phrase. The ranking is a range
    sort over the cluster, so a large language is not sorted in one task.
    """
    dictionary = stage(parse(docs, period), "phrase_dictionary")
    grams, words, totals = frequent_phrases(dictionary, least, period)
    named = spelled(stage(score(grams), "phrase_scores"), words).select("lang", "phrase", "a", "l", "r", "score")
    ranked = row_number_by(named, "lang", [F.desc("score"), F.desc("a"), F.asc("phrase")], "rank", "llm/phrase_ranks")
    out = ranked.where(F.col("rank") <= top).join(broadcast_if_small(totals), "lang")
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
