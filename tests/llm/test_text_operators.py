import collections
import hashlib
import html
import random
import re

import pyarrow as pa
import pytest

from casebook.llm import licences, mixing, quality, token_counts as T
from casebook.llm.html_text import Page, main_text
from casebook.llm.line_dedup import dedup_lines
from casebook.llm.words import slices
from tests.llm.conftest import WORD, ascii_lower


# ---------------------------------------------------------------- quality rules

def stats(text):
    w = WORD.findall(text or "")
    count = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    repeat = {i + k for i in range(len(w) - 7) if count[tuple(w[i:i + 8])] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat)


def test_text_stats_against_plain_python():
    rnd = random.Random(2)
    texts = ["", "\n", "a\na\n", "é é x\r\nx\r\n", "a " * 30] + ["".join(rnd.choice("ab \n#é\t") for _ in range(rnd.randint(0, 90))) for _ in range(1500)]
    got = []
    for _, data, off in slices(pa.array(texts), 3000):
        out = quality.text_stats(data, off)
        got += list(zip(*(out[k].tolist() for k in quality.STATS)))
    assert got == [stats(t) for t in texts]


def labelled(spark, n=160):
    rnd = random.Random(7)
    words, junk = [f"good{i}" for i in range(50)], [f"junk{i}%" for i in range(50)]
    docs = [(i, " ".join(rnd.choice(junk if i % 4 == 0 else words) for _ in range(60))) for i in range(n)]
    labels = [(i, 0 if i % 4 == 0 else 1) for i in range(0, n, 2)]
    return docs, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int")


def test_verdict_of_unlabelled_documents(spark):
    docs, df, labels = labelled(spark)
    got = {r.doc_id: r for r in quality.judged(df, labels).collect()}
    held_out = [i for i, _ in docs if i % 2]
    assert all(got[i].kept for i in held_out)                      # none of these is junk
    assert not any(got[i].kept for i, _ in docs if i % 4 == 0)
    again = {r.doc_id: r for r in quality.judged(df.repartition(7), labels).collect()}
    assert again == got


def test_quality_edge_cases(docs, empty, spark):
    labels = spark.createDataFrame([(1, 1), (None, 1), (9, None)], "doc_id long, quality int")
    got = quality.judged(docs, labels)
    for r in got.collect():
        assert not (r.base_failed and r.kept)
    want = sorted((stats(r.text) for r in docs.collect()))
    assert sorted(tuple(r) for r in got.select(*quality.STATS).collect()) == want
    assert quality.judged(docs, labels.limit(0)).where("kept = base_failed").count() == 0
    assert quality.judged(empty, labels).collect() == []


# ---------------------------------------------------------------- line dedup

def lines_brute(rows):
    order = lambda d: 2**63 if d is None else d
    key = lambda line: ascii_lower(line.strip(" \t\n\v\f\r"))
    holders = collections.defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(order(d))
    out = []
    for d, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if len(holders[key(x)]) < 2 or min(holders[key(x)]) == order(d)]
        out.append((d, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_dedup_does_not_depend_on_batches(spark, batches):
    rnd = random.Random(5)
    pool = ["  Shared line %d \t" % i for i in range(8)] + ["shared LINE 3", "short", "", " shared line 3"]
    rows = [(i, "\n".join(rnd.choice(pool) if rnd.random() < 0.7 else f"own line {i} {k}" for k in range(rnd.randint(0, 9)))) for i in range(80)]
    rows += [(None, "shared line 1\nshared line 77"), (200, None), (201, "shared line 77")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = dedup_lines(df, batches).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == lines_brute(rows)


def test_line_dedup_edge_cases(docs, empty):
    got = dedup_lines(docs).select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == lines_brute([(r.doc_id, r.text) for r in docs.collect()])
    assert dedup_lines(empty).collect() == []
    assert dedup_lines(docs).select("row.*").columns == docs.columns


def test_line_dedup_of_very_long_texts_and_many_rows_without_id(spark):
    def text(d, n):
        return "\n".join(f"shared line number {i}" if i % 3 else f"line {i} of its own in {d}" for i in range(n))
    rows = [(1, text(1, 60_000)), (2, text(2, 60_000)), (3, text(3, 60_000) + "\nshort")]
    rows += [(None, f"shared line number {i}\nshared line number {i + 1}\nno id has line {i % 50}") for i in range(1, 2_000)]
    rows += [(None, "shared line number 1\nshared line number 2")] * 500 + [(2, "second row of two\nshared line number 4")]
    got = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    got = got.select("row.doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert sorted(map(tuple, got), key=repr) == lines_brute(rows)


# ---------------------------------------------------------------- licences

def test_licence_spellings(spark, empty):
    rows = [(1, "Intro\nLICENSED under the   Apache Licence, version 2!\nmore"), (2, "Released under the MIT License"), (3, "released under the mit licence."),
            (4, "Copyright (c) 2020 Someone\nSPDX-License-Identifier: GPL-3.0"), (5, "This is not released under the MIT License at all"), (6, None),
            (2, "Released under the MIT License"), (None, "Licensed under CC BY-NC 4.0.")]
    got = {tuple(r) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, "Apache-2.0", "line", 1), (2, "MIT", "line", 2), (2, "MIT", "text", 2), (3, "MIT", "line", 1), (3, "MIT", "text", 1),
                   (4, "GPL-3.0", "line", 1), (4, "GPL-3.0", "text", 1), (None, "CC-BY-NC-4.0", "line", 1), (None, "CC-BY-NC-4.0", "text", 1)}
    assert licences.scan(empty).collect() == []


def test_whole_licence_text(spark):
    known = spark.createDataFrame([("Own", "Permission is granted.\n\nNo warranty, whatsoever."), ("Nothing", " \n")], "license_id string, text string")
    docs = spark.createDataFrame([(1, "Copyright 2024 A\npermission is granted\nNO WARRANTY whatsoever"), (2, "Permission is granted."), (3, "")], "doc_id long, text string")
    assert [tuple(r) for r in licences.scan(docs, known).collect()] == [(1, "Own", "text", 1)]


def test_default_table_knows_whole_licences_however_wrapped(spark):
    import textwrap
    rows, want = [], set()
    for key, text in licences.TEXTS.items():
        paragraphs = [x if re.search("(?im)^ *copyright [(\\[]", x) else " ".join(x.split()) for x in text.replace("License", "Licence").replace("http://", "https://").split("\n\n")]
        for width in (40, 61, 72, 100, 10_000):
            flowed = "\n\n".join(x if re.search("(?im)^ *copyright [(\\[]", x) else textwrap.fill(x, width, break_on_hyphens=False, break_long_words=False) for x in paragraphs)
            notice = "" if key in ("Apache-2.0", "CC0-1.0", "MPL-2.0") or "GPL" in key else "Copyright (c) 2021-2024 Some One <a@b.c>\nAll rights reserved.\n\n"
            for body in (notice + flowed, "\n".join(f" * {x}" for x in (notice + flowed.upper()).split("\n"))):
                rows.append((len(rows), body))
                want.add((len(rows) - 1, key, "text", 1))
    rows += [(len(rows), "The MIT License (MIT)\n\nCopyright 2020 A\n\n" + licences.TEXTS["MIT"]),
             (len(rows) + 1, licences.TEXTS["MIT"].replace("free of charge", "for a fee"))]
    want.add((len(rows) - 2, "MIT", "text", 1))
    got = {tuple(r) for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).where("scope = 'text'").collect()}
    assert got == want


# ---------------------------------------------------------------- token counts

def test_counts_equal_the_exact_tokenizer(spark, docs, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers
    vocabulary = [("<unk>", 0.0), ("▁", -3.0), ("▁a", -2.0), ("a", -2.5), ("b", -2.0), ("ab", -4.0), ("▁ab", -4.5), ("ba", -4.5), ("c", -1.0), ("bc", -3.0), ("é", -2.0)]
    exact = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=False))
    exact.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(replacement=T.MARK, prepend_scheme="always")])
    rnd = random.Random(9)
    texts = [None, "", "▁a▁", "<unk>a<unk>", "a　b c", "\x1cab"] + ["".join(rnd.choice("abcéz▁ \n日") for _ in range(rnd.randint(0, 40))) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in T.token_counts(df, vocabulary=vocabulary).collect()}
    assert got == {i: len(exact.encode(t or "").ids) for i, t in enumerate(texts)}
    assert T.token_counts(docs, vocabulary=vocabulary).count() == docs.count()
    assert T.token_counts(empty, vocabulary=vocabulary).collect() == []


def test_counts_equal_the_encoder_of_the_production_file(spark):
    import sentencepiece
    exact = sentencepiece.SentencePieceProcessor(model_file=T.MODEL)
    rnd = random.Random(10)
    pieces = [exact.id_to_piece(i).replace(T.MARK, " ") for i in range(259, exact.get_piece_size())]
    texts = [None, "", " ", "The quick brown fox", "  two\n\n  lines\t", "▁a▁ b", "a▁", "日本語 😀\x00", "\r\n;\r\n", "<s>a</s><0x0A>", " " * 50 + "x"]
    texts += ["".join(rnd.choice("abcéz▁ \n日\r\t;)}😀th ing") for _ in range(rnd.randint(0, 60))) for _ in range(1000)]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 8))) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in T.token_counts(df).collect()}
    assert got == {i: len(exact.encode(t or "")) for i, t in enumerate(texts)}
    with pytest.raises(ValueError):
        T.load_vocabulary()


def test_op3_equals_the_encoder(spark):
    import sentencepiece
    from casebook.llm.queries import op3_token_counts
    exact = sentencepiece.SentencePieceProcessor(model_file=T.MODEL)
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert {r.doc_id: r.n_tokens for r in op3_token_counts(spark, "/root/testdata/sf0.001").collect()} == {
        i: len(exact.encode(t or "")) for i, t in texts.items()}


# ---------------------------------------------------------------- mixing

def test_exponent_and_quotas(spark):
    rows = [(i, "big", "w " * 10) for i in range(900)] + [(1000 + i, "mid", "w " * 10) for i in range(90)] + [(2000 + i, None, "w " * 10) for i in range(10)]
    rows += [(3000, "empty", ""), (3001, "empty", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    sources = mixing.source_tokens(df.select("source", mixing.token_count(df["text"]).alias("n_tokens")).where("n_tokens > 0"))
    free = mixing.find_exponent(sources, 10_000, 10_000, 0.8, 1e9)
    z = [x ** free for x in (0.9, 0.09, 0.01)]
    import math
    h = -sum(x / sum(z) * math.log(x / sum(z)) for x in z) / math.log(3)
    assert 0.8 <= h < 0.801
    limited = mixing.find_exponent(sources, 10_000, 10_000, 0.8, 3.0)
    z = [x ** limited for x in (0.9, 0.09, 0.01)]
    assert 2.99 < z[2] / sum(z) * 100 <= 3.0
    out = mixing.mix_sources(df, entropy=0.8, max_repeats=3.0, block_tokens=1000).collect()
    by = collections.Counter(r.source for r in out)
    assert abs(by["big"] * 10 - z[0] / sum(z) * 10_000) <= 10 and 29 <= by[None] <= 30
    assert {r.source for r in out} == {"big", "mid", None}
    draws = collections.Counter((r.doc_id, r.epoch) for r in out)
    assert max(draws.values()) == 1 and max(r.epoch for r in out) == 2
    blocks = collections.defaultdict(list)
    for r in out:
        blocks[r.block].append(r)
    assert len(blocks) == 10
    for rs in blocks.values():
        assert sorted(r.position for r in rs) == list(range(1, len(rs) + 1))
        assert abs(sum(r.n_tokens for r in rs) - 1000) <= 30
    again = mixing.mix_sources(df.repartition(5), entropy=0.8, max_repeats=3.0, block_tokens=1000).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_mixing_edge_cases(docs, empty):
    assert mixing.mix_sources(empty).collect() == []
    assert mixing.mix_sources(docs.where("text is null")).collect() == []
    assert {r.doc_id for r in mixing.mix_sources(docs, max_repeats=1e9).collect()} <= {r.doc_id for r in docs.collect()}


# ---------------------------------------------------------------- main text of pages

HEAD = '<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>'


def test_blocks_and_references():
    page = Page(HEAD + '<nav><a href=x>Menu</a></nav><div class="ad">Buy</div><article><h1>Head &amp; more</h1><p><b>One\n two.<br><p>Caf&eacute; <a href="y">link</a>'
                '<ul><li>first<li>second</ul><form>f</form><div class="comments"><p>no</p></div><!-- x --></article><footer>&copy;</footer>')
    assert page.text(">html>body>article") == "Head & more\nOne two.\nCafé link\nfirst\nsecond"
    assert page.paths[page.best()[0]] == ">html>body>article"
    assert Page("").text(None) == "" and Page("<p").text(None) == "<p" and Page("a < b & c").text(None) == "a < b & c"


def test_host_vote_overrides_a_page(spark):
    body = "".join(f"<p>Long paragraph number {i} of the article text.</p>" for i in range(6))
    usual = HEAD + '<div class="side-12"><p>short</p></div><div class="main-3">' + body + "</div>"
    odd = HEAD + '<div class="side-7">' + body * 3 + '</div><div class="main-9"><p>The real article.</p></div>'
    rows = [(i, f"http://Host.example/{i}", usual) for i in range(3)] + [(3, "https://host.example/odd", odd), (4, None, odd), (5, "http://host.example/n", None),
                                                                      (6, "http://other.example", "no tags"), (6, "http://other.example", "no tags")]
    got = collections.defaultdict(list)
    for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect():
        got[r.page_id].append(r)
    assert got[3][0].text == "The real article." and got[4][0].text.startswith("Long paragraph")
    assert got[0][0].text.count("\n") == 5 and got[5][0].text == "" and got[5][0].n_chars == 0
    assert [r.text for r in got[6]] == ["no tags"] * 2
    assert main_text(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_article_over_unlike_containers(spark):
    lead = HEAD + "<article><h1>Title</h1><div class=lead>" + "a" * 100 + "</div><div class=body>" + "b" * 1000 + "</div></article></body>"
    sections = HEAD + "<div class=wrap><section class=one>" + "c" * 1000 + "</section><section class=two>" + "d" * 500 + "</section></div></body>"
    short = HEAD + "<main><h1>Title</h1><div class=body>" + "e" * 5000 + "</div></main></body>"
    rows = [(i * 10 + k, f"http://h{i}.example/{k}", x) for i, x in enumerate((lead, sections, short)) for k in range(3)]
    # Two templates on a host; the second also holds the first one's path, with a few words.
    first, second = HEAD + "<div>" + "f" * 800 + "</div>", HEAD + "<div>Nine words</div><section class=story>" + "g" * 900 + "</section>"
    rows += [(100 + k, f"http://two.example/{k}", first if k < 5 else second) for k in range(7)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for k in range(3):
        assert got[k] == "Title\n" + "a" * 100 + "\n" + "b" * 1000
        assert got[10 + k] == "c" * 1000 + "\n" + "d" * 500
        assert got[20 + k] == "Title\n" + "e" * 5000
    assert [got[100 + k] for k in range(7)] == ["f" * 800] * 5 + ["g" * 900] * 2


def test_page_table_against_plain_rules(spark):
    """The article of the test pages by simple cutting."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in main_text(pages).collect():
        inner = re.search(r"<article>(.*?)</article>", source[r.page_id], re.S)[1]
        cut = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner))
        assert r.text == "\n".join(x for x in cut if x) and r.n_chars == len(r.text)


def test_digest_is_of_the_utf8_text(spark):
    from casebook.llm.queries import op8_line_dedup
    got = {r.doc_id: r.kept_sha256 for r in op8_line_dedup(spark, "/root/testdata/sf0.001").collect()}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert got == {d: hashlib.sha256(t.encode()).hexdigest() for d, _, _, t in lines_brute(rows)}
