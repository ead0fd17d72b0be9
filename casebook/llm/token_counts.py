"""Token counts of a public tokenizer's model without building tokens.

The model file says which rules hold. Its pieces are sent to the executors
once (their size is that of the file); an Aho-Corasick automaton enumerates
those that end at each character, and dynamic programming carries the count.

A BPE model (``MODEL`` is one) is counted by its merges: the best-scored pair
first, the leftmost of equals. A row of pieces is what the merges give if and
only if that holds for each two neighbours, so a prefix has one possible last
piece: the one that stays next to the last piece of the prefix before it.
Spaces are marks, a mark goes before a text, line ends and other characters
outside the vocabulary count as their UTF-8 bytes. Texts are cut where no
merge can cross: before runs of spaces and around white space without piece.

A unigram vocabulary is counted by the best path. Words are cut at Unicode
white space and get the word-start mark in front, as a white-space split
followed by a metaspace step does. Rules of the exact tokenizer: a path is
replaced only by a strictly better score, paths to one character are tried
from the longest piece to the shortest; a character that is no piece costs the
least score minus 10; adjoining unknown characters are one piece; scores are
added as 64-bit floats from the start of the word.

A task finds its distinct words by hash and evaluates each once; counts are
remembered per worker, up to CACHE_WORDS words (the rest are worked out again).
Null or empty texts have no tokens; rows that repeat a doc_id are counted one
by one.
"""

from __future__ import annotations

import re
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from casebook.llm.words import mix, powers, prefix_hash, slices, word_hashes, word_spans

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_COST = 10.0
CACHE_WORDS = 400_000
CACHE_PAIRS = 400_000
_UNIGRAM, _BPE = 1, 2                               # trainer_spec.model_type
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6     # types of pieces
#: Unicode white space beyond the ASCII characters at which words are cut already.
_WIDE_SPACE = re.compile("[\\u0085\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")


def read_model(path: str = MODEL):
    """The parsed model file."""
    from sentencepiece import sentencepiece_model_pb2
    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    return model


def load_vocabulary(path: str = MODEL) -> list[tuple[str, float]]:
    """(piece, score) of the unknown piece, first, and of all ordinary pieces of a unigram model."""
    model = read_model(path)
    if model.trainer_spec.model_type != _UNIGRAM or model.trainer_spec.byte_fallback:
        raise ValueError(f"{path} is no unigram model without byte fallback")
    return ([(p.piece, 0.0) for p in model.pieces if p.type == _UNKNOWN]
            + [(p.piece, p.score) for p in model.pieces if p.type not in (_UNKNOWN, _CONTROL, 5)])


def load_merges(path: str = MODEL) -> dict[str, float]:
    """Score of every piece of a BPE model."""
    model = read_model(path)
    norm = model.normalizer_spec
    if (model.trainer_spec.model_type != _BPE or not model.trainer_spec.byte_fallback or norm.name != "identity"
            or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces
            or model.trainer_spec.treat_whitespace_as_suffix
            or any(p.type not in (_NORMAL, _UNKNOWN, _CONTROL, _BYTE) for p in model.pieces)):
        raise ValueError(f"{path} is no plain BPE model with byte fallback")
    return {p.piece: p.score for p in model.pieces if p.type == _NORMAL}


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """The pieces that merging pair by pair leaves."""
    parts = list(text)
    while len(parts) > 1:
        pairs = [scores.get(x + y) for x, y in zip(parts, parts[1:])]
        best = max((s for s in pairs if s is not None), default=None)
        if best is None:
            break
        i = pairs.index(best)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Merges:
    """Counts of a BPE vocabulary."""

    def __init__(self, scores: dict[str, float]):
        import ahocorasick
        self.scores, self.pairs = scores, {}
        self.auto = ahocorasick.Automaton()
        for piece in scores:
            if merged(piece, scores) == [piece]:      # others never come out of the merges
                self.auto.add_word(piece, piece)
        self.auto.make_automaton()
        used = set("".join(scores))
        #: ASCII white space in no piece; is a mark never behind another character in a piece?
        self.apart = np.zeros(256, bool)
        self.apart[[ord(c) for c in "\t\n\v\f\r" if c not in used]] = True
        self.cut_at_space = not any(MARK in p.lstrip(MARK) for p in scores)

    def stay(self, left: str, right: str) -> bool:
        """Do the merges of the joined text leave these two pieces?"""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        got = self.pairs[left, right] = merged(left + right, self.scores) == [left, right]
        return got

    def count(self, word: str) -> int:
        """Tokens of a word, its spaces being marks."""
        n, pairs = len(word), self.pairs
        count, last = [0] * (n + 1), [None] * (n + 1)
        hits = self.auto.iter(word)
        end, piece = next(hits, (n, None))
        for e in range(n):
            while end == e:                           # the longest first; only one stays
                if last[e + 1] is None:
                    s = e + 1 - len(piece)
                    ok = s == 0 or pairs.get((last[s], piece))
                    if ok is None:
                        ok = self.stay(last[s], piece)
                    if ok:
                        count[e + 1], last[e + 1] = count[s] + 1, piece
                end, piece = next(hits, (n, None))
            if last[e + 1] is None:
                count[e + 1], last[e + 1] = count[e] + len(word[e].encode()), word[e]
        return count[n]

    def pieces_of(self, data: np.ndarray, off: np.ndarray):
        """Starts and ends of the stretches no merge crosses, their hashes, the first of each row (one more at the end), which begin a row."""
        n = len(data)
        first = np.zeros(n + 1, bool)
        first[off] = True
        start = first[:n].copy()
        if n:
            space, apart = data == 0x20, self.apart[data]
            start[1:] |= apart[1:] != apart[:-1]
            if self.cut_at_space:
                begin = space.copy()
                begin[1:] &= ~space[:-1]
                mark = (data[:-3] == 0xE2) & (data[1:-2] == 0x96) & (data[2:-1] == 0x81) if n > 3 else np.zeros(0, bool)
                begin[3:] &= ~mark                    # a written mark counts as a space
                start |= begin
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], n) if len(starts) else starts
        p = prefix_hash(data, fold=False)
        _, down = powers(n + 1)
        h = mix((p[ends] - p[starts]) * down[starts] ^ np.where(first[starts], np.uint64(0x5851F42D4C957F2D), np.uint64(0)))
        return starts, ends, h, np.searchsorted(starts, off), first[starts]


def build_automaton(vocabulary):
    """Automaton over the pieces, each with (length, score, is the unknown piece); cost of an unknown character."""
    import ahocorasick
    auto = ahocorasick.Automaton()
    for i, (piece, score) in enumerate(vocabulary):
        auto.add_word(piece, (len(piece), score, i == 0))
    auto.make_automaton()
    return auto, min(s for _, s in vocabulary) - UNKNOWN_COST


def count_pieces(word: str, auto, unknown: float) -> int:
    """Pieces on the best path through a word."""
    n = len(word)
    score, count, open_ = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
    hits = auto.iter(word)
    end, piece = next(hits, (n, None))
    for e in range(n):
        best, single = None, False
        while end == e:
            size, gain, unk = piece
            s = e + 1 - size
            single = single or size == 1
            total = gain + score[s]
            if best is None or total > best:
                best, c, o = total, count[s] + (not (unk and open_[s])), unk
            end, piece = next(hits, (n, None))
        if not single:
            total = unknown + score[e]
            if best is None or total > best:
                best, c, o = total, count[e] + (not open_[e]), True
        score[e + 1], count[e + 1], open_[e + 1] = best, c, o
    return count[n]


def marked(word: str) -> list[str]:
    """The word with the mark in front; marks inside it start words of their own."""
    word = word if word.startswith(MARK) else MARK + word
    return [MARK + x for x in word.split(MARK)[1:]]


def _worker_store(key):
    """What a Python worker keeps between tasks, by key."""
    store = sys.modules.setdefault("casebook_worker_store", types.ModuleType("casebook_worker_store")).__dict__
    return store.setdefault(key, {})


def _totals(store, batches, cut):
    """Counts per row. ``cut`` gives a slice's words: hashes, the first of each row, and the count of the i-th."""
    seen = store.setdefault("seen", {})
    for b in batches:
        for lo, data, off in slices(b.column("text")):
            h, rows, measure = cut(data, off)
            value, first, back = np.unique(h, return_index=True, return_inverse=True)
            counts = np.zeros(len(value), np.int64)
            for i, (v, f) in enumerate(zip(value.tolist(), first.tolist())):
                c = seen.get(v)
                if c is None:
                    c = measure(f)
                    if len(seen) >= CACHE_WORDS:
                        seen.clear()
                    seen[v] = c
                counts[i] = c
            total = np.zeros(len(h) + 1, np.int64)
            np.cumsum(counts[back], out=total[1:])
            words = word_spans(data, off)[2]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").slice(lo, len(off) - 1), pa.array(words[1:] - words[:-1], pa.int64()),
                 pa.array(total[rows[1:]] - total[rows[:-1]])], ["doc_id", "n_words", "n_tokens"])


def _count(vocabulary):
    def run(batches):
        store = _worker_store(("tokens", vocabulary.id if hasattr(vocabulary, "id") else id(vocabulary)))
        if "auto" not in store:
            store["auto"] = build_automaton(vocabulary.value)
        auto, unknown = store["auto"]

        def cut(data, off):
            starts, ends, _ = word_spans(data, off)

            def measure(i: int) -> int:
                word = data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace")
                parts = [word] if word.isascii() else _WIDE_SPACE.split(word)
                return sum(count_pieces(w, auto, unknown) for p in parts if p for w in marked(p))
            return *word_hashes(data, off, fold=False), measure
        yield from _totals(store, batches, cut)
    return run


def _count_merges(scores):
    def run(batches):
        store = _worker_store(("merges", scores.id if hasattr(scores, "id") else id(scores)))
        if "merges" not in store:
            store["merges"] = Merges(scores.value)
        merges = store["merges"]

        def cut(data, off):
            starts, ends, h, rows, first = merges.pieces_of(data, off)

            def measure(i: int) -> int:
                word = data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace").replace(" ", MARK)
                return merges.count(MARK + word if first[i] else word)
            return h, rows, measure
        yield from _totals(store, batches, cut)
    return run


def token_counts(docs: DataFrame, model: str = MODEL, vocabulary=None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words (cut at ASCII white space), n_tokens."""
    share = docs.sparkSession.sparkContext.broadcast
    if vocabulary is None and read_model(model).trainer_spec.model_type == _BPE:
        run = _count_merges(share(load_merges(model)))
    else:
        run = _count(share(vocabulary or load_vocabulary(model)))
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_tokens long")
