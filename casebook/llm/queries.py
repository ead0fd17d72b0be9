"""Queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casebook.llm.common import read_table
from casebook.llm.decontaminate import leaks
from casebook.llm.html_text import main_text
from casebook.llm.licences import canonical_sql, notices, scan
from casebook.llm.line_dedup import dedup_lines
from casebook.llm.mixing import mix_sources
from casebook.llm.near_dedup import near_duplicates
from casebook.llm.packing import pack
from casebook.llm.phrases import collocations
from casebook.llm.prefix_trie import prefix_trie
from casebook.llm.quality import judged
from casebook.llm.repeats import remove_repeats
from casebook.llm.token_counts import token_counts
from casebook.llm.warc import read_archives, write_archives
from casebook.session import checkpoint_dir


def op1_warc(spark, sf_dir):
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm/warc/{uuid.uuid4().hex}"
    manifest = write_archives(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), folder)
    return read_archives(manifest).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_decontaminate(spark, sf_dir):
    return leaks(read_table(spark, sf_dir, "documents", "doc_id", "text"), read_table(spark, sf_dir, "benchmark"))


def op3_token_counts(spark, sf_dir):
    return token_counts(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_near_dedup(spark, sf_dir):
    return near_duplicates(read_table(spark, sf_dir, "documents", "doc_id", "text"), width=3, pct=85)


def op5_quality_rules(spark, sf_dir):
    return judged(read_table(spark, sf_dir, "documents", "doc_id", "text"),
                  read_table(spark, sf_dir, "labels", "doc_id", "quality"))


def op6_mix_sources(spark, sf_dir):
    return mix_sources(read_table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op7_html_text(spark, sf_dir):
    return main_text(read_table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op8_line_dedup(spark, sf_dir):
    out = dedup_lines(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_repeated_bytes(spark, sf_dir):
    out = remove_repeats(read_table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
    return out.select("doc_id", (F.octet_length("kept") + removed).cast("long").alias("n_bytes"), removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
                      F.expr("make_valid_utf8(cast(kept as string))").alias("kept_text"))     # cut characters show as U+FFFD


def op10_licences(spark, sf_dir):
    return scan(read_table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_packing(spark, sf_dir):
    import public_tokenizers
    return pack(read_table(spark, sf_dir, "documents", "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op12_prefix_trie(spark, sf_dir):
    return prefix_trie(read_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_collocations(spark, sf_dir):
    return collocations(read_table(spark, sf_dir, "documents", "lang", "text"))


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_decontaminate, op3_token_counts, op4_near_dedup, op5_quality_rules, op6_mix_sources,
    op7_html_text, op8_line_dedup, op9_repeated_bytes, op10_licences,
    op11_packing, op12_prefix_trie, op13_collocations)}

ORACLE: dict[str, str] = {}

ORACLE["op1_warc"] = """
WITH p AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest AS d, max(page_id) AS target FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN p.page_id < g.target THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id < g.target THEN g.target END AS refers_to
FROM p LEFT JOIN g ON p.payload_bytes >= 1000 AND p.payload_digest = g.d
"""

ORACLE["op8_line_dedup"] = r"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (
  SELECT doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM cut),
keyed AS (
  SELECT doc_id, i, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
shared AS (
  SELECT key, min(doc_id) AS owner FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
  SELECT k.doc_id, k.i, k.line, (s.key IS NULL OR s.owner = k.doc_id) AS stays
  FROM keyed k LEFT JOIN shared s ON k.key = s.key),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS body FROM judged WHERE stays GROUP BY doc_id),
counts AS (
  SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN stays THEN 0 ELSE 1 END) AS BIGINT) AS n_dropped
  FROM judged GROUP BY doc_id)
SELECT c.doc_id, c.n_lines, c.n_dropped, sha256(coalesce(k.body, '')) AS kept_sha256
FROM counts c LEFT JOIN kept k ON c.doc_id = k.doc_id
"""

ORACLE["op4_near_dedup"] = r"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingled AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM doc),
keyed AS (SELECT r, doc_id, len(s) AS n, sha256(array_to_string(list_sort(s), chr(10))) AS cls, s FROM shingled),
class AS (SELECT cls, min(doc_id) AS id, any_value(n) AS n, any_value(s) AS s FROM keyed WHERE n > 0 AND doc_id IS NOT NULL GROUP BY cls),
item AS (SELECT id, n, unnest(s) AS x FROM class),
held AS (SELECT id, n, md5_number(x) AS x FROM item),
link AS (
  SELECT a.id AS a, b.id AS b FROM held a JOIN held b ON a.x = b.x AND a.id < b.id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT id AS a, id AS b FROM class UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b),
low AS (SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a)
SELECT k.doc_id, CAST(k.n AS BIGINT) AS n_shingles, coalesce(low.component_id, k.doc_id) AS component_id,
       k.doc_id IS NOT DISTINCT FROM coalesce(low.component_id, k.doc_id) AS kept
FROM keyed k LEFT JOIN class ON class.cls = k.cls AND k.doc_id IS NOT NULL LEFT JOIN low ON low.id = class.id
"""

# A run of whole UTF-8 characters in hex, then what is left of a cut one (shown as one U+FFFD).
_RUN = "(?:[0-7].|(?:C[2-9A-F]|D.)T|E0[AB].T|E[1-9A-CEF]TT|ED[89].T|F0[9AB].TT|F[1-3]TTT|F48.TT)+".replace("T", "[89AB].")
_CUT = "E0[AB].|E[1-9A-CEF]T|ED[89].|F0[9AB].T?|F[1-3]TT?|F48.T?".replace("T?", "(?:[89AB].)?").replace("T", "[89AB].")
ORACLE["op9_repeated_bytes"] = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
place AS (SELECT r, b, unnest(range(1, octet_length(b) - 398)) AS i FROM doc WHERE octet_length(b) >= 400),
win AS (SELECT r, i, md5_number(b[i:i + 399]) AS h FROM place),
hit AS (SELECT r, i FROM win SEMI JOIN (SELECT h FROM win GROUP BY h HAVING count(*) > 1) twice USING (h)),
first AS (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 400, true) AS opens FROM hit),
run AS (SELECT r, i, sum(CAST(opens AS INT)) OVER (PARTITION BY r ORDER BY i) AS k FROM first),
span AS (SELECT r, k, min(i) AS s, max(i) + 399 AS e FROM run GROUP BY r, k),
after AS (SELECT r, s, e, lead(s) OVER (PARTITION BY r ORDER BY s) AS next FROM span),
total AS (SELECT r, min(s) AS s, count(*) AS n_spans, sum(e - s + 1) AS n_removed FROM span GROUP BY r),
tail AS (
  SELECT a.r, string_agg(hex(b[e + 1:coalesce(next - 1, octet_length(b))]), '' ORDER BY a.s) AS h
  FROM after a JOIN doc ON doc.r = a.r GROUP BY a.r),
kept AS (
  SELECT doc_id, octet_length(b) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
         CASE WHEN n_spans IS NULL THEN hex(b) ELSE hex(b[1:s - 1]) || h END AS h
  FROM doc LEFT JOIN total ON total.r = doc.r LEFT JOIN tail ON tail.r = doc.r)
SELECT doc_id, n_bytes, CAST(n_removed AS BIGINT) AS n_removed, n_spans, sha256(unhex(h)) AS kept_sha256,
       decode(unhex(array_to_string(list_transform(regexp_extract_all(h, '{_RUN}|{_CUT}|..'),
              lambda x: CASE WHEN regexp_full_match(x, '{_RUN}') THEN x ELSE 'EFBFBD' END), ''))) AS kept_text
FROM kept
"""

_KNOWN = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in notices())
ORACLE["op10_licences"] = f"""
WITH known AS (
  SELECT license_id, {canonical_sql('t')} AS c FROM (VALUES {_KNOWN}) v(license_id, t)),
digests AS (SELECT DISTINCT license_id, sha256(c) AS digest FROM known WHERE c <> ''),
cut AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_split_to_array(coalesce(text, ''), '\\r\\n|\\n|\\r') AS parts FROM documents),
lines AS (SELECT r, doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS i FROM cut),
canon AS (SELECT r, doc_id, i, {canonical_sql('line')} AS c FROM lines),
units AS (
  SELECT doc_id, 'line' AS scope, c FROM canon WHERE c <> ''
  UNION ALL
  SELECT doc_id, 'text', string_agg(c, ' ' ORDER BY i) FROM canon WHERE c <> '' GROUP BY r, doc_id)
SELECT doc_id, license_id, scope, count(*) AS n_hits
FROM units JOIN digests ON sha256(c) = digest GROUP BY doc_id, license_id, scope
"""

# CRC-32 of a decimal number, byte by byte and bit by bit; only its two lowest bits are used.
_CRC = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(CAST(conv_id AS VARCHAR), '.'), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
ORACLE["op12_prefix_trie"] = rf"""
WITH own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT conv_id, conv_id - conv_id % 20 AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM own)),
joined AS (
  SELECT i.conv_id, 0 AS part, o.k, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.base AND o.k <= i.h
  UNION ALL
  SELECT i.conv_id, 1, o.k, o.role, o.text FROM ids i JOIN own o ON o.conv_id = i.conv_id AND o.k > i.h),
turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, k) AS depth, role, text FROM joined),
prefix AS (
  SELECT conv_id, depth, len(regexp_extract_all(text, '[^ 	-
]+')) AS words,
         list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY depth) AS path,
         list(struct_pack(r := role, t := text)) OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS above,
         count(*) OVER (PARTITION BY conv_id) AS length FROM turns
  UNION ALL
  SELECT i.conv_id, 0, 0, NULL, NULL, (SELECT count(*) FROM turns t WHERE t.conv_id = i.conv_id) FROM ids i),
node AS (
  SELECT depth, path, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words, max(length) AS longest,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE length = depth), '') AS ends
  FROM prefix GROUP BY depth, path),
linked AS (
  SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.words, n.longest, n.ends
  FROM node n LEFT JOIN node u ON u.depth = n.depth - 1 AND u.path IS NOT DISTINCT FROM n.above),
member AS (SELECT DISTINCT p.conv_id, p.depth, n.conv_id AS node FROM prefix p JOIN node n ON n.depth = p.depth AND n.path IS NOT DISTINCT FROM p.path),
below AS (
  SELECT m.node AS conv_id, m.depth, count(*) FILTER (WHERE l.longest = l.depth) AS n_leaves, sum((l.n_convs - 1) * l.words) AS saved_tokens
  FROM member m JOIN linked l ON l.conv_id = m.conv_id AND l.depth >= m.depth GROUP BY m.node, m.depth),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL)
SELECT l.conv_id, CAST(l.depth AS BIGINT) AS depth, l.parent_conv_id, l.n_convs, coalesce(k.n_children, 0) AS n_children,
       b.n_leaves, CAST(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(l.ends) AS ends_sha256
FROM linked l JOIN below b ON b.conv_id = l.conv_id AND b.depth = l.depth
LEFT JOIN kids k ON k.conv_id = l.conv_id AND k.depth = l.depth
"""

ORACLE["op13_collocations"] = r"""
WITH low AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?
-
]')), '[^ 	]+') AS w FROM low),
gram AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM piece, (VALUES (1), (2), (3), (4)) s(k))),
f AS (SELECT lang, k, g, string_split(g, ' ') AS w, count(*) AS f FROM gram GROUP BY lang, k, g HAVING count(*) >= 30),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
cut AS (
  SELECT lang, k, g, f AS a, c, array_to_string(w[1:c], ' ') AS lg, array_to_string(w[c + 1:k], ' ') AS rg
  FROM (SELECT *, unnest(range(1, k)) AS c FROM f WHERE k > 1)),
scored AS (
  SELECT cut.lang, cut.k, cut.g, cut.a, lf.f AS l, rf.f AS r, cut.c, CAST(CAST(2000000 AS HUGEINT) * cut.a // (CAST(lf.f AS HUGEINT) + rf.f) AS BIGINT) AS score
  FROM cut JOIN f lf ON lf.lang = cut.lang AND lf.k = cut.c AND lf.g = cut.lg JOIN f rf ON rf.lang = cut.lang AND rf.k = cut.k - cut.c AND rf.g = cut.rg),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
part AS (
  SELECT lang, array_to_string(w[s:s + n - 1], ' ') AS g, f
  FROM (SELECT lang, w, k, f, n, unnest(range(1, k - n + 2)) AS s FROM (SELECT *, unnest(range(2, k)) AS n FROM f WHERE k > 2))),
longer AS (SELECT lang, g, max(f) AS f FROM part GROUP BY lang, g),
kept AS (
  SELECT b.lang, b.g, b.a, b.l, b.r, b.score FROM best b LEFT JOIN longer p ON p.lang = b.lang AND p.g = b.g
  WHERE p.f IS NULL OR 100 * p.f < 80 * b.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score
FROM kept JOIN total ON total.lang = kept.lang QUALIFY rank <= 2000
"""
