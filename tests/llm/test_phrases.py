import random
import re
from collections import Counter

import numpy as np
import pytest

from casebook.llm import phrases as P


def brute(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    f = {g: c for g, c in f.items() if c >= least}
    out = []
    for g, a in f.items():
        lang, w = g[0], g[1:]
        if len(w) < 2:
            continue
        if any(h[0] == lang and len(h) > len(g) and 100 * c >= 80 * a and any(h[i:i + len(w)] == w for i in range(1, len(h) - len(w) + 1)) for h, c in f.items() if len(h) > len(g)):
            continue
        s, _, l, r = min((2000000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])]) for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, l, r, n[lang], s))
    out.sort(key=lambda x: (x[0].encode(), -x[6], -x[2], x[1].encode()))
    rank, kept = Counter(), []
    for x in out:
        rank[x[0]] += 1
        if rank[x[0]] <= top:
            kept.append((x[0], rank[x[0]], *x[1:]))
    return kept


def texts(seed, n, variety, length):
    rnd = random.Random(seed)
    words = [f"{rnd.choice('abcdefgh')}{i}" for i in range(variety)]
    sep = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "; ", "!", "\r\n", "\x0b"]
    fixed = "New York City Hall stands here, as ever"
    return [(rnd.choice(("en", "en", "de", None)), (fixed + "? " if rnd.random() < .3 else "") + "".join(
        w + rnd.choice(sep) for w in rnd.choices(words, k=rnd.randint(0, length)))) for _ in range(n)]


def result(spark, rows, **k):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "lang string, text string, n long, g string, score long")
    return sorted((tuple(r) for r in P.collocations(df, **k).collect()), key=lambda x: (x[0].encode(), x[1]))


@pytest.mark.parametrize("period", [1, 3, 16, 10**9])
def test_equals_brute_force(spark, period):
    rows = texts(1, 150, 12, 60) + [("en", "same words every time here " * 40)] * 3
    assert result(spark, rows, least=5, top=25, period=period) == brute(rows, 5, 25)


def test_odd_rows(spark):
    rows = [(None, None), ("en", ""), ("en", " \t . , "), ("", "a b a b a b"), ("und", "É é É é"), (None, "É é É é"), ("en", "x" * 100_000 + " y " + "z " * 3000), ("en", "a b")]
    assert result(spark, rows, least=2, top=9) == brute(rows, 2, 9)
    assert result(spark, [], least=2) == []


def test_full_sets_change_no_count(spark, monkeypatch):
    rows = texts(4, 80, 8, 50)
    monkeypatch.setattr(P, "SET_BITS", (2, 2))
    assert result(spark, rows, least=4, top=50) == brute(rows, 4, 50)


def test_words_that_share_a_number_are_renumbered(spark, monkeypatch):
    rows, true, seen = texts(5, 60, 8, 40), P._numbers, []
    monkeypatch.setattr(P, "_numbers", lambda data, s, e, h, salt: true(data, s, e, h, salt) if salt > 1 else true(data, s, e, h, salt) & np.uint64(3))
    monkeypatch.setattr(P, "CHECK_SALT", 77)
    counted = P._vocabulary
    monkeypatch.setattr(P, "_vocabulary", lambda period, salt: seen.append(salt) or counted(period, salt))
    assert result(spark, rows, least=4, top=50) == brute(rows, 4, 50)
    assert seen == [0, 1, 2]


def test_every_occurrence_has_one_chunk():
    text = " ".join(random.Random(3).choices(["a", "b", "c", "d", "e"], k=500)).encode()
    data = np.frombuffer(text, np.uint8)
    for period in (1, 2, 5, 10**9):
        chunks = P.chunk_strings(data, np.array([0, len(data)]), period).to_pylist()
        got = Counter()
        for c in chunks:
            raw = np.frombuffer(c.encode(), np.uint8)
            *_, h = P._words(raw, np.array([0, len(raw)]), P.SPACE)
            w, trig = c.split(), P._triggers(h, period)
            own = next((k for k in range(1, len(w)) if trig[k]), len(w))
            got.update(tuple(w[i:i + 4]) for i in range(own) if i + 4 <= len(w))
        words = text.decode().split()
        assert got == Counter(tuple(words[i:i + 4]) for i in range(len(words) - 3))
