"""Benchmark decontamination by latent semantic retrieval.

1. Words are runs of letters and digits, lower case. A passage is WINDOW
   consecutive words, every HALF words, over whole texts; for items of few
   words there are shorter passages besides (SHORT), lest the words around
   a short item outweigh it. Words are hashed
   into FEATURES columns; passage frequencies are counted over all documents.
2. A randomised SVD of the TF-IDF matrix A of half passages (HALF words each, side by
   side), computed by Spark in one pass over all documents: every task multiplies its rows
   (A.T @ A @ test, with a sparse test matrix of SKETCH columns), the
   products are added up, and Nystrom's formula gives the factors. They only
   form the index; every passage of every document is searched.
3. Passages and benchmark items are mapped to the latent space, scaled by the
   inverse singular values (so that common words do not dominate), and every
   passage is compared with every item window of its size by cosine, in
   blocks of items. The sums of a few words are made once for all passage
   sizes and blocks.
4. Candidates whose words, weighted by inverse frequency, cover less than
   OVERLAP of the item window are dropped; the others are checked in full: the longest common subsequence of the
   item and the text around the passage must hold LCS_PCT of the item's words,
   and the answer must occur there: ANSWER_PCT of the distinct words of the
   item's ``answer`` column, if there is one and it has words; else ENDING_PCT
   of the item's last ENDING_WORDS words, for a leak that stops before the
   answer gives nothing away.

Null or wordless texts and items match nothing. Rows without doc_id or with
a repeated one are searched one by one; equal findings appear once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import blocks_of, merged_blocks, whole
from casebook.llm.words import mix, powers, prefix_hash, slices, spans, texts

FEATURES = 1 << 13
WINDOW, HALF = 32, 16
SHORT = ((10, 8), (23, 16))         # items of at most so many words: passages of so many words
RANK = 128
SKETCH = 256
PART_PASSAGES = 100_000
COSINE = 0.35
OVERLAP = 0.35
LCS_PCT = 70
ANSWER_PCT = 50
ENDING_WORDS = 8
ENDING_PCT = 25
ITEM_BLOCK = 500                    # items compared at once
PASS_ITEMS = 10_000                 # items that go to the tasks together: one pass over the documents each
SUM_BLOCK = 8192

_BREAK = np.zeros(256, dtype=bool)          # all ASCII but letters and digits
_BREAK[:128] = True
_BREAK[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def word_ids(column, max_bytes: int = 1 << 18):
    """``(first row, word hashes, first word of each row)`` of lower-cased texts, slice by slice."""
    for lo, data, off in slices(pc.utf8_lower(texts(column)), max_bytes):
        starts, ends, rows = spans(data, off, _BREAK)
        p = prefix_hash(data, fold=False)
        _, down = powers(len(data) + 1)
        yield lo, mix((p[ends] - p[starts]) * down[starts]), rows


def feature(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - 13)).astype(np.int64) & (FEATURES - 1)


def _halves(rows: np.ndarray, half: int = HALF):
    """First word and row of every half passage; whether the next one belongs to the same row."""
    n = rows[1:] - rows[:-1]
    count = -(-n // half)
    row = np.repeat(np.arange(len(n)), count)
    place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = rows[row] + place * half
    more = np.zeros(len(row), bool)
    more[:-1] = row[1:] == row[:-1]
    return start, row, place, more


def _passages(rows: np.ndarray, half: int = HALF):
    """First half, row and first word of every passage (a text of one half has one passage)."""
    start, row, place, more = _halves(rows, half)
    return start, row, np.flatnonzero(more | (place == 0)), more


def _frequencies(batches):
    """A task's passage frequency of every feature, and at FEATURES its number of passages."""
    out = np.zeros(FEATURES + 1, np.int64)
    for b in batches:
        for _, h, rows in word_ids(b.column("text")):
            start, row, at, _ = _passages(rows)
            if not len(at):
                continue
            grid = start[at][:, None] + np.arange(WINDOW)
            inside = grid < rows[row[at] + 1][:, None]
            f = np.where(inside, feature(h)[np.minimum(grid, len(h) - 1)], FEATURES).astype(np.int16)
            f.sort(axis=1)
            fresh = np.ones(f.shape, bool)
            fresh[:, 1:] = f[:, 1:] != f[:, :-1]
            out += np.bincount(f[fresh].astype(np.int64), minlength=FEATURES + 1)
            out[FEATURES] += len(at) - int((fresh & (f == FEATURES)).sum())
    yield blocks_of(out, SUM_BLOCK)


def inverse_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    got = merged_blocks(docs.select("text").mapInArrow(_frequencies, "block long, data binary"), np.int64, np.add)
    n = whole(got, FEATURES + 1, SUM_BLOCK, np.int64)
    return np.log((n[FEATURES] + 1) / (n[:FEATURES] + 1)), int(n[FEATURES])


def _sketch():
    """The test matrix: the column and the sign of every feature's only entry (none for FEATURES)."""
    rng = np.random.default_rng(42)
    return rng.permutation(FEATURES) % SKETCH, rng.choice([-1.0, 1.0], FEATURES)


def _gram_times(weight: np.ndarray):
    """A task's share of ``A.T @ (A @ test)`` over the half passages of its documents, rows of A of unit length."""
    def run(batches):
        column, sign = (np.append(x, 0) for x in _sketch())
        weights = np.append(weight, 0.0)
        signed, square = weights * sign, weights ** 2
        total = np.zeros((FEATURES + 1) * SKETCH)
        for b in batches:
            for _, h, rows in word_ids(b.column("text")):
                f = np.append(feature(h), FEATURES)
                start, row, _, _ = _halves(rows)
                grid = start[:, None] + np.arange(HALF)
                every = f[np.where(grid < rows[row + 1][:, None], grid, len(h))]
                for k in range(0, len(every), 512):
                    f = every[k:k + 512]
                    size = np.maximum(square[f].sum(axis=1), 1e-12)[:, None]
                    cell = (f * SKETCH)[:, :, None] + column[f][:, None, :]
                    np.add.at(total, cell.ravel(), ((weights[f] / size)[:, :, None] * signed[f][:, None, :]).ravel())
        yield blocks_of(total[:FEATURES * SKETCH].astype(np.float32), SUM_BLOCK)
    return run


def latent_basis(docs: DataFrame, weight: np.ndarray, passages: int) -> np.ndarray:
    """FEATURES x RANK map from raw counts to the scaled latent space."""
    parts = max(-(-passages // PART_PASSAGES), docs.sparkSession.sparkContext.defaultParallelism)   # every part costs a copy of the product
    shares = docs.select("text").coalesce(parts).mapInArrow(_gram_times(weight), "block long, data binary")
    product = whole(merged_blocks(shares, np.float32, np.add), FEATURES * SKETCH, SUM_BLOCK, np.float64).reshape(FEATURES, SKETCH)
    column, sign = _sketch()
    core = np.zeros((SKETCH, SKETCH))               # test.T @ product
    np.add.at(core, column, sign[:, None] * product)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    some = values > max(values.max(), 0) * 1e-9
    left, sizes, _ = np.linalg.svd(product @ (vectors[:, some] / np.sqrt(values[some])), full_matrices=False)
    some = np.flatnonzero(sizes ** 2 > sizes.max(initial=0) ** 2 * 1e-9)[:RANK]
    return (left[:, some] / sizes[some] * weight[:, None]).astype(np.float32, order="C")


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence, one machine-word-parallel step per element of ``b``."""
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & where.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - bin(row).count("1")


def item_windows(n: int) -> list[tuple[int, int]]:
    """Windows of an item of n words; the last one is shifted back to be full."""
    if n <= WINDOW + HALF // 2:
        return [(0, n)]
    return [(min(i, n - WINDOW), min(i, n - WINDOW) + WINDOW) for i in range(0, n - HALF, HALF)]


def passage_size(n: int) -> int:
    """Words of the passages that an item of n words is compared with."""
    return next((size for most, size in SHORT if n <= most), WINDOW)


def unit_sums(f: np.ndarray, rows: np.ndarray, table: np.ndarray, unit: int):
    """Vectors of every ``unit`` words, from the start of each row, with a row of zeros at the end; the first unit of each row."""
    start, row, _, _ = _halves(rows, unit)
    grid = start[:, None] + np.arange(unit)
    f = np.where(grid < rows[row + 1][:, None], f[np.minimum(grid, len(f) - 1)], FEATURES)
    out = np.zeros((len(start) + 1, table.shape[1]), np.float32)
    for k in range(unit):
        out[:-1] += table.take(f[:, k], axis=0)
    return out, np.searchsorted(row, np.arange(len(rows)))


def passage_vectors(units: np.ndarray, first: np.ndarray, rows: np.ndarray, unit: int, size: int):
    """Unit-length vector, row and first word of every passage of ``size`` words, every half of it."""
    start, row, at, _ = _passages(rows, size // 2)
    start, row = start[at], row[at]
    u = first[row] + (start - rows[row]) // unit
    total = units[u]
    for k in range(1, size // unit):
        total += units[np.where(u + k < first[row + 1], u + k, len(units) - 1)]
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    return total, row, start


def passages_by_size(h: np.ndarray, rows: np.ndarray, table: np.ndarray, sizes: list[int]) -> dict:
    """``passage_vectors`` of every size, from word sums that are made once."""
    unit = sizes[0] // 2
    units, first = unit_sums(feature(h), rows, table, unit)
    return {size: passage_vectors(units, first, rows, unit, size) for size in sizes}


def _table(basis: np.ndarray) -> np.ndarray:
    """The basis with a row of zeros for no word."""
    return np.vstack([basis, np.zeros((1, basis.shape[1]), np.float32)])


class _Block:
    """A block of items, ready to be searched: item id, its word hashes, its answer (word hashes and how many must occur)."""

    def __init__(self, basis: np.ndarray, weight: np.ndarray, items: list[tuple]):
        self.basis, self.weight, self.items = basis, weight.astype(np.float32), items
        at = [(k, a, z) for k, (_, h, _) in enumerate(items) for a, z in item_windows(len(h))]
        f = [feature(np.array(h, np.uint64)) for _, h, _ in items]
        self.owner, self.place = np.array([x[0] for x in at]), np.array([x[1] for x in at])
        query = np.array([basis[f[k][a:z]].sum(axis=0) for k, a, z in at], np.float32)
        self.query = query / np.maximum(np.linalg.norm(query, axis=1, keepdims=True), 1e-9)
        self.size = np.array([passage_size(len(items[k][1])) for k in self.owner])
        self.need = OVERLAP * np.array([self.weight[f[k][a:z]].sum() for k, a, z in at])
        words = np.concatenate([np.array(h, np.uint64) for _, h, _ in items])
        self.words, number = np.unique(words, return_inverse=True)
        self.held = np.unique(number * len(items) + np.repeat(np.arange(len(items)), [len(x[1]) for x in items]))   # (word, item) pairs
        size = max(16 * len(self.held), 2).bit_length()             # the same pairs in a table where few others fall on them
        self.salt, self.shift = mix(np.arange(len(items), dtype=np.uint64)), np.uint64(64 - size)
        self.table = np.zeros(1 << size, bool)
        self.table[(self.words[self.held // len(items)] ^ self.salt[self.held % len(items)]) >> self.shift] = True

    def maybe_covered(self, h: np.ndarray, item: np.ndarray) -> np.ndarray:
        """All that ``covered`` finds, and a few words more."""
        return self.table[(h ^ self.salt[item][:, None]) >> self.shift]

    def covered(self, h: np.ndarray, item: np.ndarray) -> np.ndarray:
        """Which of the words (a row for each candidate) the candidate's item holds."""
        place = np.searchsorted(self.words, h)
        known = place < len(self.words)
        place[~known] = 0
        known &= self.words[place] == h
        code = place * len(self.items) + item[:, None]
        at = np.minimum(np.searchsorted(self.held, code), len(self.held) - 1)
        return known & (self.held[at] == code)

    def candidates(self, h: np.ndarray, rows: np.ndarray, passages: dict | None = None):
        """(row, item, word where the item would begin) of the passages that pass cosine and overlap."""
        sizes = np.unique(self.size).tolist()
        value = self.weight[feature(h)]
        passages = passages or passages_by_size(h, rows, _table(self.basis), sizes)
        for size in sizes:
            mine = np.flatnonzero(self.size == size)          # the item windows for passages of this size
            vectors, row, start = passages[size]
            p, q = np.divmod(np.flatnonzero(vectors @ self.query[mine].T >= COSINE), len(mine))
            for k in range(0, len(p), 2_000):
                pk, qk = p[k:k + 2_000], mine[q[k:k + 2_000]]
                grid = start[pk][:, None] + np.arange(size)
                worth = np.where(grid < rows[row[pk] + 1][:, None], value[np.minimum(grid, len(h) - 1)], 0)
                words = h[np.minimum(grid, len(h) - 1)]
                ok = (worth * self.maybe_covered(words, self.owner[qk])).sum(axis=1) >= self.need[qk]
                pk, qk, worth, words = pk[ok], qk[ok], worth[ok], words[ok]
                ok = (worth * self.covered(words, self.owner[qk])).sum(axis=1) >= self.need[qk]
                yield row[pk[ok]], self.owner[qk[ok]], start[pk[ok]] - self.place[qk[ok]]

    def matches(self, item: list, answer: tuple[set, int], near: list) -> int | None:
        """Words of the item in common with a stretch of text, None if too few."""
        n, here = len(item), set(near)
        if 100 * sum(x in here for x in item) < LCS_PCT * n or len(answer[0] & here) < answer[1]:
            return None                                 # a common subsequence holds no other words
        common = lcs_length(item, near)
        return common if 100 * common >= LCS_PCT * n else None


def _search(basis: np.ndarray, weight: np.ndarray, items: list[tuple]):
    def run(batches):
        blocks = [_Block(basis, weight, items[k:k + ITEM_BLOCK]) for k in range(0, len(items), ITEM_BLOCK)]
        sizes = sorted({x for b in blocks for x in b.size.tolist()})
        table = _table(basis)
        for b in batches:
            found = []
            for lo, h, rows in word_ids(b.column("text")):
                if not len(h):
                    continue
                passages = passages_by_size(h, rows, table, sizes)
                for block in blocks:
                    got = list(block.candidates(h, rows, passages))
                    if not got:
                        continue
                    row, item, guess = (np.concatenate(x) for x in zip(*got))
                    last = (-1, -1, 0, False)           # row, item, end of the stretch read, found
                    for i in np.lexsort((guess, item, row)).tolist():
                        r, k, g = int(row[i]), int(item[i]), int(guess[i])
                        if last[:2] == (r, k) and (last[3] or g < last[2]):
                            continue
                        words = block.items[k][1]
                        a, z = max(rows[r], g - WINDOW), min(rows[r + 1], g + len(words) + 2 * WINDOW)
                        common = block.matches(words, block.items[k][2], h[a:z].tolist())
                        last = (r, k, g + HALF, common is not None)
                        if common is not None:
                            found.append((lo + r, block.items[k][0], common, len(words)))
            if found:
                ids = b.column("doc_id").take(pa.array([x[0] for x in found]))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array([x[j] for x in found], pa.int64()) for j in (1, 2, 3))],
                    ["doc_id", "item_id", "common_words", "item_words"])
    return run


def _items(rows, has_answer: bool) -> list[tuple]:
    """Hashes of a block of benchmark rows; items without words are left out."""
    def hashes(values):
        out = []
        for _, h, bounds in word_ids(pa.array(values, pa.string()), 1 << 24):
            out += [h[a:z].tolist() for a, z in zip(bounds[:-1], bounds[1:])]
        return out
    text = hashes([r["text"] for r in rows])
    answer = hashes([r["answer"] if has_answer else None for r in rows])
    def check(text, answer):
        words, pct = (set(answer), ANSWER_PCT) if answer else (set(text[-ENDING_WORDS:]), ENDING_PCT)
        return words, -(-len(words) * pct // 100)
    return [(r["item_id"], t, check(t, a)) for r, t, a in zip(rows, text, answer) if t and r["item_id"] is not None]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, common_words, item_words) of every benchmark item found in a document."""
    weight, passages = inverse_frequency(docs)
    basis = latent_basis(docs, weight, passages)
    has_answer = "answer" in benchmark.columns
    wanted = benchmark.select("item_id", "text", *(["answer"] if has_answer else [])).where("text is not null")
    schema = "doc_id long, item_id long, common_words long, item_words long"
    out, block = None, []

    def search(block):
        items = _items(block, has_answer)
        if not items:
            return out
        part = docs.select("doc_id", "text").mapInArrow(_search(basis, weight, items), schema)
        return part if out is None else out.union(part)
    for r in wanted.toLocalIterator():              # the stated query set, pass by pass
        block.append(r)
        if len(block) == PASS_ITEMS:
            out, block = search(block), []
    if block:
        out = search(block)
    if out is None:
        return docs.sparkSession.createDataFrame([], schema)
    return (out.groupBy("doc_id", "item_id").agg(F.max("common_words").alias("common_words"), F.max("item_words").alias("item_words")))
