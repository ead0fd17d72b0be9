import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from casebook.llm import packing as P

public_tokenizers = pytest.importorskip("public_tokenizers")
MODEL = public_tokenizers.path("byte_bpe_50k.json")


def reachable(lengths, target):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= target}
    return target in sums


def test_fill_finds_a_multiset_whenever_there_is_one():
    rnd = random.Random(2)
    for _ in range(300):
        lengths = [rnd.randint(1, 30) for _ in range(rnd.randint(0, 9))]
        left, target = np.bincount(lengths, minlength=64), rnd.randint(0, 63)
        used = P.fill(left, target)
        assert (used is not None) == reachable(lengths, target)
        if used:
            assert sum(n * k for n, k in used.items()) == target and all(k <= left[n] for n, k in used.items())


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_remainder_once_without_gaps(seed):
    rnd = random.Random(seed)
    counts = np.zeros(64, np.int64)
    for _ in range(rnd.randint(0, 12)):
        counts[rnd.randint(1, 63)] += rnd.choice((1, 2, 50, 1000))
    plan, got = P.Plan(counts, 64), defaultdict(list)
    for n in range(1, 64):
        inside = np.arange(plan.taken[n])
        if len(inside):
            for s, o in zip(*(x.tolist() for x in plan.place(n, inside))):
                got[s].append((o, n))
        for number in range(int(plan.taken[n]), int(counts[n])):
            pieces = list(plan.cut(n, number))
            assert sum(p[1] for p in pieces) == n and pieces[0][0] == 0
            for _, length, s, o in pieces:
                got[s].append((o, length))
    total = 0
    for pieces in got.values():
        end = 0
        for o, n in sorted(pieces):
            assert o == end
            end += n
        assert end == 64 or end & (end - 1) == 0
        total += end
    assert total == int((counts * np.arange(64)).sum())
    assert all(sum(n for _, n in got[s]) == 64 for s in range(plan.windows))


def plain_ids(text):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(MODEL).encode(text or "", add_special_tokens=False).ids + [1]


def check(rows, out, capacity):
    by_row, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        by_row[r["row_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    want = sorted((str(d), tuple(plain_ids(t))) for d, t in rows)
    got = []
    for pieces in by_row.values():
        pieces.sort(key=lambda r: r["start"])
        d = pieces[0]["doc_id"]
        ids = next(i for x, i in want if x == str(d) and len(i) == pieces[0]["doc_tokens"] and all(
            zlib.crc32(np.array(i[p["start"]:p["start"] + p["length"]], "<u4").tobytes()) == p["ids_crc32"] for p in pieces))
        assert [p["start"] for p in pieces] == [sum(q["length"] for q in pieces[:k]) for k in range(len(pieces))]
        assert sum(p["length"] for p in pieces) == len(ids) and all(p["length"] > 0 for p in pieces)
        got.append((str(d), ids))
    assert sorted(got) == want
    padding = 0
    for s in sequences.values():
        end = 0
        for o, n in sorted(s):
            assert o == end
            end += n
        assert end <= capacity
        padding += 0 if end & (end - 1) == 0 else capacity - end
    assert padding == 0


def run(spark, rows, capacity):
    df = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, part int, cls string").repartition(3)
    return P.pack(df, MODEL, capacity).collect()


def test_pieces_hold_every_id_once(spark):
    rnd = random.Random(9)
    rows = [(k, " ".join(rnd.choices(["alpha", "été", "mixed-Case", "7", "\n", "日本"], k=rnd.choice((0, 1, 5, 40, 200))))) for k in range(120)]
    rows += [(500 + k, "the same copy of eleven words that holds a third of all") for k in range(90)]
    for capacity in (64, 16):
        check(rows, run(spark, rows, capacity), capacity)


def test_odd_rows(spark):
    rows = [(1, None), (1, ""), (None, "no id"), (None, "no id"), (2, "a <|endoftext|> b"), (3, "x" * 5000 + " " * 5000), (4, "\x00\t\n"), (5, "word " * 4000)]
    check(rows, run(spark, rows, 2048), 2048)
    assert run(spark, [], 2048) == []
