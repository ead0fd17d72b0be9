import collections
import hashlib
import io
import random
import zipfile

import numpy as np
import pyarrow as pa
import pytest

from casebook.llm import decontaminate as D, repeats as R, warc
from casebook.session import checkpoint_dir


# ---------------------------------------------------------------- WARC packages

def reader(data):
    return lambda offset, n: data[offset:offset + n]


def test_central_directory_and_zip64():
    for big in (False, True):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            with z.open("a/é.txt", "w", force_zip64=big) as f:
                f.write(b"hello")
            z.writestr("b", b"x" * 70_000)
            z.comment = b"PK\x05\x06"[:2] + b"note"
        data = out.getvalue()
        got = warc.central_directory(reader(data), len(data))
        assert [(n, m, s) for n, m, s, _ in got] == [("a/é.txt", 0, 5), ("b", 0, 70_000)]
        assert data[(at := warc.member_start(reader(data), got[0][3])):at + 5] == b"hello"


def test_zip64_end_record():
    """A directory with 64-bit places: the same archive, its end record moved to the ZIP64 form."""
    import struct
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("one", b"1")
    data = out.getvalue()
    k = data.rfind(b"PK\x05\x06")
    n, size, start = struct.unpack("<HII", data[k + 10:k + 20])
    end64 = struct.pack("<4sQHHIIQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, n, n, size, start)
    locator = struct.pack("<4sIQI", b"PK\x06\x07", 0, k, 1)
    end = struct.pack("<4sHHHHIIH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    data = data[:k] + end64 + locator + end
    assert [x[0] for x in warc.central_directory(reader(data), len(data))] == ["one"]


def expected(rows):
    largest = collections.defaultdict(lambda: None)
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 1000 and page is not None:
            largest[body] = page if largest[body] is None else max(page, largest[body])
    out = []
    for page, url, html in rows:
        body = (html or "").encode()
        to = largest[body] if page is not None and len(body) >= 1000 and page < largest[body] else None
        out.append((page, len(body), hashlib.sha1(body).hexdigest(), "response" if to is None else "revisit", to))
    return sorted(out, key=repr)


@pytest.mark.parametrize("records,stretch", [(100_000, 8 << 20), (3, 500)])
def test_round_trip(spark, monkeypatch, records, stretch):
    monkeypatch.setattr(warc, "ARCHIVE_RECORDS", records)
    monkeypatch.setattr(warc, "READ_BYTES", stretch)
    long = "é<p>" * 400
    rows = [(i, f"http://h{i % 3}.example/ü?q={i}\n", f"{long}{i % 4}" if i % 2 else f"short {i % 2}") for i in range(40)]
    rows += [(100, None, None), (101, "", ""), (None, "http://x", long + "1"), (39, "http://again", long + "3"), (102, "not a url [", "\r\n\r\n" + "z" * 2000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(df, f"{checkpoint_dir(spark)}/warc-test-{records}")
    assert sum(r.n_records for r in manifest.collect()) == len(rows)
    got = warc.read_archives(manifest)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == expected(rows)
    bodies = {r.page_id: bytes(r.payload) for r in got.where("record_type = 'response' and page_id >= 100").collect()}
    assert bodies == {100: b"", 101: b"", 102: b"\r\n\r\n" + b"z" * 2000}


def test_package_is_a_plain_zip_and_can_be_read_without_index(spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", "x" * (10 * i)) for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = warc.write_archives(df, f"{tmp_path}/packages").first().path
    with zipfile.ZipFile(path) as z:
        assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
        member = z.read("archive/data.warc.gz")
    bare = tmp_path / "bare.wacz"
    with zipfile.ZipFile(bare, "w") as z:
        z.writestr("archive/other.warc.gz", member)
    got = warc.read_archives(spark.createDataFrame([(str(bare), None)], "path string, bytes long"))
    assert sorted(r.page_id for r in got.collect()) == list(range(20))


def test_empty_pages(spark):
    manifest = warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), f"{checkpoint_dir(spark)}/warc-none")
    assert warc.read_archives(manifest).collect() == []


# ---------------------------------------------------------------- repeated byte strings

def brute(rows, length, keep_first):
    texts = [(d, (t or "").encode()) for d, t in rows]
    count, first = collections.Counter(), {}
    for d, x in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0)):
        for p in range(len(x) - length + 1):
            count[x[p:p + length]] += 1
            first.setdefault(x[p:p + length], (d, p))
    out = []
    for d, x in texts:
        gone = bytearray(len(x))
        for p in range(len(x) - length + 1):
            w = x[p:p + length]
            if count[w] > 1 and not (keep_first and first[w] == (d, p)):
                gone[p:p + length] = b"\1" * length
        runs = sum(1 for i in range(len(x)) if gone[i] and not (i and gone[i - 1]))
        out.append((d, bytes(b for b, g in zip(x, gone) if not g), runs))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("kinds,segment", [(2000, 4 << 20), (2, 700)])
def test_repeats_against_brute_force(spark, monkeypatch, keep_first, kinds, segment):
    """The small limits force the sorted-window path and texts cut into segments."""
    monkeypatch.setattr(R, "GROUP_KINDS", kinds)
    monkeypatch.setattr(R, "SEGMENT", segment)
    rnd = random.Random(5)
    base = ["".join(rnd.choice("abcd \n") for _ in range(300)) for _ in range(6)]

    def part():
        r = rnd.random()
        if r < 0.4:
            b, a = rnd.choice(base), rnd.randint(0, 200)
            return b[a:a + rnd.randint(20, 300)]
        if r < 0.6:
            return rnd.choice(["x", "ab", "abc "]) * rnd.randint(1, 90)
        return "".join(rnd.choice("abcdé") for _ in range(rnd.randint(0, 60)))
    rows = [(i, "".join(part() for _ in range(rnd.randint(0, 5)))) for i in range(90)]
    rows += [(200, rows[3][1]), (201, rows[5][1]), (202, rows[5][1]), (203, None), (None, base[0] + "q" + base[1]), (204, "tail" + base[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = R.remove_repeats(df, 40, keep_first).collect()
    assert sorted(((r.doc_id, bytes(r.kept), len(r.spans)) for r in got), key=repr) == brute(rows, 40, keep_first)


def test_repeats_edge_cases(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = R.remove_repeats(docs).collect()
    assert sorted(((r.doc_id, bytes(r.kept), len(r.spans)) for r in got), key=repr) == brute(rows, 400, False)
    assert R.remove_repeats(empty).collect() == []


def test_suffix_ranks_and_factors():
    rnd = np.random.default_rng(1)
    strings = [rnd.integers(97, 99, rnd.integers(1, 40)).astype(np.uint8) for _ in range(8)]
    earlier, later, _ = R.capped_factors(strings, 5)
    places = [(i, p) for i, s in enumerate(strings) for p in range(len(s) - 4)]
    at = np.cumsum([0] + [len(s) + 1 for s in strings])
    for n, (i, p) in enumerate(places):
        w = strings[i][p:p + 5].tobytes()
        same = [m for m, (j, q) in enumerate(places) if strings[j][q:q + 5].tobytes() == w]
        assert earlier[at[i] + p] == (same[0] < n) and later[at[i] + p] == (same[-1] > n)
    text = np.frombuffer(b"banana", np.uint8)
    assert np.argsort(R.suffix_ranks(text, 6)).tolist() == [5, 3, 1, 0, 4, 2]


# ---------------------------------------------------------------- benchmark decontamination

def test_lcs_length():
    rnd = random.Random(3)
    for _ in range(200):
        a, b = [rnd.randrange(5) for _ in range(rnd.randint(0, 70))], [rnd.randrange(5) for _ in range(rnd.randint(0, 70))]
        row = [0] * (len(b) + 1)
        for x in a:
            row, old = [0], row
            for j, y in enumerate(b):
                row.append(old[j] + 1 if x == y else max(old[j + 1], row[j]))
        assert D.lcs_length(a, b) == row[-1]


def corpus(rnd, n=120):
    vocabulary = [f"term{i}" for i in range(900)]
    text = lambda k: [rnd.choice(vocabulary) if rnd.random() < 0.7 else f"common{rnd.randrange(12)}" for _ in range(k)]
    items = [text(rnd.randint(14, 70)) for _ in range(25)]
    docs = [text(rnd.randint(5, 400)) for _ in range(n)]
    planted = set()
    for d in range(0, 60):
        i = rnd.randrange(len(items))
        body = list(items[i])
        if d % 3 == 1:                                # paraphrase: a sixth of the words differ
            for k in range(0, len(body) - 5, 6):
                body[k] = f"other{rnd.randrange(99)}"
        if d % 3 == 2:                                # a short quote only: no leak
            body = body[:len(body) // 3]
        else:
            planted.add((d, i))
        at = rnd.randrange(len(docs[d]) + 1)
        docs[d][at:at] = body
    return [(i, " ".join(x)) for i, x in enumerate(docs)], [(i, " ".join(x)) for i, x in enumerate(items)], planted


def test_planted_items_are_found_and_quotes_are_not(spark):
    docs, items, planted = corpus(random.Random(8))
    found = D.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted


def test_candidate_recall_against_all_windows(spark, monkeypatch):
    """The latent index against checking every stretch of every document: at least 0.9 (all of them here)."""
    docs, items, _ = corpus(random.Random(18))
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in D.leaks(df, it).collect()}
    monkeypatch.setattr(D, "COSINE", -2.0)
    monkeypatch.setattr(D, "OVERLAP", 0.0)
    every = {(r.doc_id, r.item_id) for r in D.leaks(df, it).collect()}
    assert found <= every and len(found) >= 0.9 * len(every) and every


def test_the_index_is_fitted_on_every_document(spark, monkeypatch):
    """No share of the documents is left out, however many passages there are: the sums are those of all half passages."""
    docs, _, _ = corpus(random.Random(28), 60)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    weight, _ = D.inverse_frequency(df)
    seen, whole = [], D.whole
    monkeypatch.setattr(D, "whole", lambda *args: seen.append(whole(*args)) or seen[-1])
    basis = D.latent_basis(df, weight, 10**9)
    column, sign = D._sketch()
    want = D.np.zeros((D.FEATURES, D.SKETCH))
    for _, h, rows in D.word_ids(pa.array([t for _, t in docs])):
        for a, z in zip(rows[:-1], rows[1:]):
            for k in range(a, z, D.HALF):
                words = D.feature(h[k:min(k + D.HALF, z)])
                image = D.np.bincount(column[words], weight[words] * sign[words], D.SKETCH) / max((weight[words] ** 2).sum(), 1e-12)
                D.np.add.at(want, words, weight[words][:, None] * image)
    assert D.np.allclose(seen[0].reshape(want.shape), want, rtol=1e-4, atol=1e-4) and want.any()
    assert basis.shape == (D.FEATURES, D.RANK) and D.np.isfinite(basis).all() and basis.flags.c_contiguous


def test_overlap_bound_keeps_all_that_the_overlap_keeps():
    rng = D.np.random.default_rng(9)
    words = rng.integers(0, 2**63, 300).astype(D.np.uint64)
    items = [(k, rng.choice(words, 30).tolist(), (set(), 0)) for k in range(50)]
    block = D._Block(rng.standard_normal((D.FEATURES, D.RANK)).astype(D.np.float32), D.np.ones(D.FEATURES), items)
    text, item = rng.choice(D.np.append(words, words + D.np.uint64(1)), (500, 32)), rng.integers(0, 50, 500)
    exact, bound = block.covered(text, item), block.maybe_covered(text, item)
    assert (bound | ~exact).all() and exact.any() and bound.mean() < exact.mean() + 0.15


def test_short_items_inside_running_text():
    """Exact copies of short items among other words: at least 0.9 are candidates, for every length."""
    rng = D.np.random.default_rng(4)
    basis = rng.standard_normal((D.FEATURES, D.RANK)).astype(D.np.float32)
    for n in (5, 6, 8, 10, 12, 15, 20):
        items = [(k, rng.integers(0, 2**63, n).astype(D.np.uint64).tolist(), (set(), 0)) for k in range(40)]
        block, found = D._Block(basis, D.np.ones(D.FEATURES), items), 0
        for k, words, _ in items:
            text = rng.integers(0, 2**63, 300).astype(D.np.uint64)
            at = int(rng.integers(0, 280))
            text[at:at + n] = words[:300 - at]
            found += any(k in item.tolist() for _, item, _ in block.candidates(text, D.np.array([0, 300])))
        assert found >= 36, n


def test_answers_and_edge_cases(spark, docs, empty):
    question = " ".join(f"ask{i}" for i in range(30))
    items = spark.createDataFrame([(1, question, "blue whale"), (2, None, "x"), (3, "", "y"), (4, "...", None), (None, question, None)], "item_id long, text string, answer string")
    rows = [(1, question + " it is the Blue Whale!"), (2, question + " nobody knows"), (3, None), (4, ""), (None, question.upper() + " blue whale")]
    got = {(r.doc_id, r.item_id) for r in D.leaks(spark.createDataFrame(rows, "doc_id long, text string"), items).collect()}
    assert got == {(1, 1), (None, 1)}
    assert D.leaks(empty, items).collect() == []
    assert D.leaks(docs, items.limit(0)).collect() == []
    one = docs.where("doc_id = 1").select("text").first().text
    assert {(r.doc_id) for r in D.leaks(docs, spark.createDataFrame([(7, one)], "item_id long, text string")).collect()} == {1, 2, 3, None}


def test_word_ids_ignore_case_and_punctuation():
    (_, h, rows), = D.word_ids(pa.array(["Éa, b!!", "éa B", None]))
    assert h[:2].tolist() == h[2:].tolist() and rows.tolist() == [0, 2, 4, 4]
