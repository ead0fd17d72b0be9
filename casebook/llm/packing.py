"""Packing documents into token sequences of one length: minimum bin slack.

A document is its token ids and one end id. Every full window of it is a
sequence of its own, so only remainders (1 to capacity - 1 ids) have to be
packed. How many remainders there are of each length is a table of fewer than
``capacity`` rows, whatever the input, and the plan is made from it alone:

1. The longest length left opens a window; a bitset subset-sum over the
   multiset of lengths left (a Python integer with one bit a sum) finds a
   multiset that fills the rest of the window, and the counts are backtracked.
   The pattern is applied as often as the counts allow, so every step uses up
   a length but for less than one window's share.
2. A length that no multiset completes can never be completed by later, shorter
   ones; its remainders are laid end to end and cut at the window borders,
   which the task allows. The last, unfinished window is cut at the binary
   digits of its length: powers of two need no padding. Nothing is padded.

The plan is applied without gathering anything: tasks number their remainders
by length, per-task counts give each task its offset, and number and plan give
sequence and offset of every remainder in closed form.

Results for odd input: null text is the empty text (the end id alone); null
and repeated doc_ids and repeated rows are documents of their own (``row_id``
tells them apart); columns other than doc_id and text are not read; an empty
table gives an empty result. A very long text is encoded in one piece and
gives one row per window.
"""

from __future__ import annotations

import json
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from casebook.llm.common import stage
from casebook.operators.broadcast import broadcast_if_small

CAPACITY = 2048
END_ID = 1
# Fixed value: the words that byte-level BPE merges within.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

TOKENS = ("row_id long, doc_id long, doc_tokens long, part int, first_window long, window_crcs array<long>, "
          "rest long, rest_rank long, rest_crc long, rest_ids binary")
PIECES = ("row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, rest_start long")


# ---- ids -----------------------------------------------------------------------
def _byte_of() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable Latin-1 bytes stand for themselves, the rest follow from 256."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Encoder:
    """Ids of a byte-level BPE tokenizer file, as the tokenizers library gives them.

    The same merges run several times faster in tiktoken. It is used where the
    file's ids are its merge order and the text holds none of the added tokens;
    all else goes through the tokenizers library itself.
    """

    def __init__(self, model: bytes):
        import tiktoken
        from tokenizers import Tokenizer
        self.slow = Tokenizer.from_str(model.decode())
        spec = json.loads(model)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.added = [t["content"] for t in spec.get("added_tokens", [])]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in merges]
        pre = spec.get("pre_tokenizer") or {}
        plain = (spec["model"].get("type") == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                 and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec["model"].get("ignore_merges")
                 and all(vocab.get(a + b) == 256 + k for k, (a, b) in enumerate(pairs)))
        self.fast = None
        if plain:
            byte = _byte_of()
            ranks = {bytes(byte[c] for c in t): k for t, k in vocab.items() if t not in self.added}
            self.fast = tiktoken.Encoding("packing", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.width = "<u2" if self.slow.get_vocab_size() <= 1 << 16 else "<u4"

    def ids(self, text: str) -> list[int]:
        if self.fast is not None and not any(t in text for t in self.added):
            try:
                return self.fast.encode_ordinary(text)
            except BaseException as e:  # noqa: BLE001 - its regex gives up on some very long runs with an error of its own kind
                if isinstance(e, (KeyboardInterrupt, SystemExit)):
                    raise
        return self.slow.encode(text, add_special_tokens=False).ids


def _encoder(model: bytes) -> Encoder:
    """One encoder a worker process. Shipped functions get fresh globals for each task, so it is kept in a module of its own."""
    held = sys.modules.setdefault("_packing_encoders", types.ModuleType("_packing_encoders")).__dict__.setdefault("held", {})
    key = zlib.crc32(model), len(model)
    if key not in held:
        held[key] = Encoder(model)
    return held[key]


def _crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _tokenise(model, capacity: int, end_id: int):
    def run(batches):
        from pyspark import TaskContext
        enc, part = _encoder(model), TaskContext.get().partitionId()
        rank, windows, row = np.zeros(capacity, np.int64), 0, 0
        for b in batches:
            out = {k: [] for k in ("row_id", "doc_id", "doc_tokens", "part", "first_window", "window_crcs", "rest", "rest_rank", "rest_crc", "rest_ids")}
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.array([*enc.ids(text or ""), end_id], enc.width)
                full, rest = divmod(len(ids), capacity)
                tail = ids[full * capacity:]
                for k, v in zip(out, ((part << 33) + row, doc_id, len(ids), part, windows,
                                      [_crc(ids[k * capacity:(k + 1) * capacity]) for k in range(full)],
                                      rest, rank[rest], _crc(tail), tail.tobytes())):
                    out[k].append(v)
                rank[rest] += 1
                windows += full
                row += 1
            kinds = dict(part=pa.int32(), window_crcs=pa.list_(pa.int64()), rest_ids=pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.int64())) for k, v in out.items()], list(out))
    return run


# ---- plan ----------------------------------------------------------------------
def fill(left: np.ndarray, target: int) -> dict[int, int] | None:
    """A multiset of the lengths left (``left[n]`` of length n) that adds up to ``target``; None if there is none.

    Bounded subset sum: bit s of ``reach`` tells that sum s can be made. A length with
    count c enters as lots of 1, 2, 4, ... so that every number up to c can be taken.
    """
    if not target:
        return {}
    reach, mask, steps = 1, (1 << (target + 1)) - 1, []
    for n in np.flatnonzero(left[1:target + 1])[::-1].tolist():
        n += 1
        more, lot = min(int(left[n]), target // n), 1
        while more:
            lot = min(lot, more)
            steps.append((n, lot, reach))
            reach |= (reach << (n * lot)) & mask
            if reach >> target & 1:
                used: dict[int, int] = {}
                for m, k, before in reversed(steps):
                    if not before >> target & 1:
                        used[m] = used.get(m, 0) + k
                        target -= m * k
                return used
            more, lot = more - lot, lot * 2
    return None


class Plan:
    """Where the remainder number k of length n goes; arrays bounded by the number of lengths."""

    def __init__(self, counts: np.ndarray, capacity: int):
        left, self.capacity = counts.astype(np.int64).copy(), capacity
        runs: dict[int, list] = {}                       # length -> (first number, windows' first id, per window, first offset)
        at, taken = 0, np.zeros(capacity, np.int64)
        for n in range(capacity - 1, 0, -1):
            while left[n]:
                left[n] -= 1
                used = fill(left, capacity - n)
                left[n] += 1
                if used is None:
                    break
                used[n] = used.get(n, 0) + 1
                times = min(int(left[m]) // k for m, k in used.items())
                offset = 0
                for m, k in used.items():
                    runs.setdefault(m, []).append((int(taken[m]), at, k, offset))
                    offset += m * k
                    left[m] -= k * times
                    taken[m] += k * times
                at += times
        self.windows = at                                # windows filled by patterns
        self.runs = {m: np.array(r, np.int64).T for m, r in runs.items()}
        self.taken = taken                               # numbers from here on are laid end to end
        sizes = left * np.arange(capacity)
        self.base = np.cumsum(sizes) - sizes             # where those of each length begin
        total, last = int(sizes.sum()), int(sizes.sum()) // capacity * capacity
        digits = [1 << k for k in range(capacity.bit_length(), -1, -1) if (total - last) >> k & 1]
        self.cuts = np.array([*range(0, last + 1, capacity), *(last + np.cumsum(digits)).tolist()], np.int64)

    def place(self, n: int, number: np.ndarray):
        """Sequence and offset of remainders of length n that lie in patterns."""
        first, base, per, offset = self.runs[n]
        k = np.searchsorted(first, number, "right") - 1
        window, slot = np.divmod(number - first[k], per[k])
        return base[k] + window, offset[k] + slot * n

    def cut(self, n: int, number: int):
        """Pieces (start, length, sequence, offset) of a remainder that is laid end to end."""
        lo = int(self.base[n]) + (number - int(self.taken[n])) * n
        k = int(np.searchsorted(self.cuts, lo, "right")) - 1
        start = lo
        while start < lo + n:
            end = min(lo + n, int(self.cuts[k + 1]))
            yield start - lo, end - start, self.windows + k, start - int(self.cuts[k])
            start, k = end, k + 1


def _placed(plan: Plan):
    def run(batches):
        p, cap = plan, plan.capacity
        for b in batches:
            c = {k: b.column(k).to_numpy(zero_copy_only=False) for k in ("row_id", "doc_tokens", "cls", "number")}
            doc_ids, crcs = b.column("doc_id").to_pylist(), b.column("crcs").to_pylist()
            out = []
            inside = (c["cls"] < cap) & (c["number"] < p.taken[np.minimum(c["cls"], cap - 1)])
            seq, off = np.zeros(len(inside), np.int64), np.zeros(len(inside), np.int64)
            for n in np.unique(c["cls"][inside]).tolist():
                at = np.flatnonzero(inside & (c["cls"] == n))
                seq[at], off[at] = p.place(n, c["number"][at])
            for i, (row, tokens, n, number) in enumerate(zip(*(c[k].tolist() for k in ("row_id", "doc_tokens", "cls", "number")))):
                if n == cap:                             # full windows, numbered after all others
                    out += [(row, doc_ids[i], k * cap, cap, x, tokens, p.windows + len(p.cuts) + number + k, 0, 0) for k, x in enumerate(crcs[i])]
                elif inside[i]:
                    out.append((row, doc_ids[i], tokens - n, n, crcs[i][0], tokens, int(seq[i]), int(off[i]), 0))
                else:
                    for start, length, s, o in p.cut(n, number):
                        out.append((row, doc_ids[i], tokens - n + start, length, crcs[i][0] if length == n else None, tokens, s, o, start))
            names = [x.split()[0] for x in PIECES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out) if out else [()] * len(names))], names)
    return run


def _cut_crc(width: str):
    def run(batches):
        for b in batches:
            crc = [_crc(np.frombuffer(x, width)[s:s + n]) for x, s, n in
                   zip(b.column("rest_ids").to_pylist(), b.column("rest_start").to_pylist(), b.column("length").to_pylist())]
            keep = [k for k in b.schema.names if k != "rest_ids"]
            yield pa.RecordBatch.from_arrays([pa.array(crc, pa.int64()) if k == "ids_crc32" else b.column(k) for k in keep], keep)
    return run


def pack(docs: DataFrame, model_path: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, row_id)``, one row per piece.

    The tokenizer file is read by the driver and goes to the tasks with the function (a vocabulary, not data).
    """
    with open(model_path, "rb") as f:
        model = f.read()
    width = Encoder(model).width
    tokens = stage(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
                   .mapInArrow(_tokenise(model, capacity, end_id), TOKENS), "packing_tokens")
    unit = ("row_id", "doc_id", "doc_tokens", "part")
    units = tokens.where(F.size("window_crcs") > 0).select(
        *unit, F.lit(capacity).cast("long").alias("cls"), F.col("first_window").alias("at"), F.size("window_crcs").cast("long").alias("n"),
        F.col("window_crcs").alias("crcs")).unionAll(tokens.where("rest > 0").select(
            *unit, F.col("rest").alias("cls"), F.col("rest_rank").alias("at"), F.lit(1).cast("long").alias("n"), F.array("rest_crc").alias("crcs")))
    counts = units.groupBy("part", "cls").agg(F.sum("n").alias("n"))
    before = W.partitionBy("cls").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("part", "cls", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    by_length = np.zeros(capacity, np.int64)
    for r in counts.where(F.col("cls") < capacity).groupBy("cls").agg(F.sum("n").alias("n")).collect():   # fewer than capacity rows
        by_length[r["cls"]] = r["n"]
    plan = Plan(by_length, capacity)
    numbered = units.join(starts, ["part", "cls"]).select(
        "row_id", "doc_id", "doc_tokens", "cls", (F.col("first") + F.col("at")).alias("number"), "crcs")
    pieces = stage(numbered.mapInArrow(_placed(plan), PIECES), "packing_pieces")
    cut = pieces.where("ids_crc32 is null")
    if not cut.isEmpty():
        cut = stage(cut, "packing_cut")                  # on its own, so that its size is known
        ids = tokens.select(F.col("row_id"), "rest_ids")
        cut = ids.join(broadcast_if_small(cut), "row_id").select(*pieces.columns, "rest_ids").mapInArrow(_cut_crc(width), PIECES)
        pieces = pieces.where("ids_crc32 is not null").unionAll(cut)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "row_id")
