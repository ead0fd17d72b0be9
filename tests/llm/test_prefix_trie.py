import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from casebook.llm import prefix_trie as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KEYS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def rebuilt(rows):
    """Plain rebuild: conversations as lists of (role, text)."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest(), text or ""))
    own = {c: [(r, x) for *_, r, _, x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, t in convs.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(WORD.findall(node[-1][1])) if node else 0
        leaves = sum(total[k][0] for k in kids[node]) or 1
        total[node] = (leaves, (len(members[node]) - 1) * words + sum(total[k][1] for k in kids[node]))
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else None, len(m), len(kids[n]), *total[n],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(n)))).encode()).hexdigest())
                  for n, m in members.items())


def result(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as depth", "'x' as owner", "2 as k")
    return sorted((tuple(r[k] for k in KEYS) for r in T.prefix_trie(df).collect()), key=lambda r: r[:2])


def tree_rows(seed, n, turns, variety):
    rnd = random.Random(seed)
    out = []
    for c in range(n):
        for k in range(rnd.randint(1, turns)):
            out.append((c * rnd.choice((1, 1, 1, 7)), k, rnd.choice(("user", "assistant", None)), rnd.choice((None, "", *(f"say {i} now" for i in range(variety))))))
    return out


@pytest.mark.parametrize("seed,n,turns,variety", [(1, 60, 6, 1), (2, 300, 5, 3), (3, 40, 30, 2)])
def test_equals_brute_force(spark, seed, n, turns, variety):
    rows = tree_rows(seed, n, turns, variety)
    assert result(spark, rows) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (20, None, "user", "first"), (20, 1, None, None), (20, 2, "user", "b c"), (21, 0, "user", "only"), (-5, 0, "user", "below zero"),
            (-5, 0, "user", "below zero"), (22, 3, "user", "x " * 5000), (22, 3, "user", "x " * 5000), (41, 0, "user", "no base"), (2**62, 0, "user", "far")]
    assert result(spark, rows) == brute(rows)
    assert result(spark, []) == []


def test_stretches_large_nodes_and_full_sketch(spark, monkeypatch):
    """Long conversations in several stretches, owners of large nodes by broadcast, and a sketch that proves next to nothing."""
    rows = tree_rows(5, 200, 40, 1)
    want = brute(rows)
    monkeypatch.setattr(T, "STRETCH", 4)
    monkeypatch.setattr(T, "SKETCH_BITS", (4, 4))
    monkeypatch.setattr(T, "LARGE_NODES", 8)
    monkeypatch.setattr(T, "PIECE", 3)
    assert result(spark, rows) == want


def test_screen_is_never_too_low(spark):
    p = T.stage(T.prefixes(*T.shared_heads(T.turns_of(spark.createDataFrame(tree_rows(7, 300, 6, 2), "conv_id long, turn long, role string, text string")))), "test_prefixes")
    sketch = T.CountMin(p.select("depth", "a", "b"), T._hash, 8)
    found = p.mapInArrow(T._screen(sketch), "conv_id long, depth long, length long, words long, a long, b long, shared boolean")
    alone = found.groupBy("depth", "a", "b").count().where("count > 1").join(found.where("not shared"), ["depth", "a", "b"])
    assert alone.count() == 0
