"""Licence scan by canonical digests (DataFrame functions only).

A line is made canonical: A-Z lowered; copyright lines (a line that begins with
"copyright", "(c)", the copyright sign or "all rights reserved") become empty;
equivalent spellings become one; every run of characters other than letters,
digits and non-ASCII becomes one space. A text's canonical form is its
non-empty canonical lines joined by spaces. The SHA-256 of the whole text and
of every line is joined to the digests of the known licence texts, which go
through the same steps; there is no partial match.

A whole text has a second form that does not depend on where its lines break:
only lines that are a copyright notice go (not those that begin with the
"copyright holders" of a licence), to the end of their line, and the rest is
made canonical in one piece.
A text is found by either form, once.

``default_known`` holds whole licence texts (``licence_texts``, with the titles
and list marks in use) and usual one-line notices, built from NAMES and
NOTICES; callers can pass any table (license_id, text). The size of that table
decides whether Spark broadcasts it.

Null or empty texts, and lines without letters or digits, match nothing.
Rows that repeat a doc_id add up; a null doc_id is an id of its own.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casebook.llm.licence_texts import TEXTS

# Licence ids and the names used for them in notices.
NAMES = {
    "MIT": ("MIT",),
    "ISC": ("ISC",),
    "Apache-2.0": ("Apache", "Apache 2.0", "Apache License, Version 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause", "Simplified BSD"),
    "BSD-3-Clause": ("BSD 3-Clause", "New BSD", "Modified BSD"),
    "MPL-2.0": ("MPL 2.0", "Mozilla Public License, version 2.0"),
    "GPL-2.0": ("GPL v2", "GNU GPL v2", "GNU General Public License, version 2"),
    "GPL-3.0": ("GPL v3", "GNU GPL v3", "GNU General Public License, version 3"),
    "LGPL-2.1": ("LGPL v2.1", "GNU Lesser General Public License, version 2.1"),
    "LGPL-3.0": ("LGPL v3", "GNU Lesser General Public License, version 3"),
    "AGPL-3.0": ("AGPL v3", "GNU Affero General Public License, version 3"),
    "CC0-1.0": ("CC0", "CC0 1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International"),
    "Unlicense": ("Unlicense",),
}
# Forms of a notice. {} stands for a name, with or without "License" after it.
NOTICES = ("Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
           "This work is licensed under {}", "This work is licensed under the {}",
           "This project is licensed under the {}", "Distributed under the {}", "License: {}",
           "Available under the {}", "This file is licensed under the {}")
# Spellings that count as equal (pattern, replacement), in this order.
SPELLINGS = (
    ("licence", "license"),
    ("https://", "http://"),
    ("&", " and "),
    ("copyright holder", "copyright owner"),
    ("organisation", "organization"),
    ("acknowledgement", "acknowledgment"),
    ("favour", "favor"),
    ("merchantible", "merchantable"),
    ("non-commercial", "noncommercial"),
    ("sub-license", "sublicense"),
    ("(^|[^a-z0-9])(?:version|ver|v) ?[.]? ?([0-9])", "$1 $2"),
    ("([0-9])[.]0([^0-9]|$)", "$1$2"),
)
_COPYRIGHT = "^[^a-z0-9©(]*(copyright([^a-z]|$)|[(]c[)]|©|all rights reserved)"
# Of the lines above, those that are notices: what licences say about copyright goes on with other words.
_NOTICE = ("^[^a-z0-9©(]*(copyright[^a-z](?![^a-z0-9©<\\[{]*(notice|holder|owner|licen[sc]e|statement|law|interest|permission|disclaimer"
           "|doctrine|treat|like|(and|or|are|if|on|also|line|patent|the (software|library|program|work))([^a-z]|$))).*[a-z0-9]"
           "|[(]c[)](?! *(you must|under patent))|©|all rights reserved)")
# Titles above the licence texts that have none of their own.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License", "The Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License", "Modified BSD License"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def notices() -> list[tuple[str, str]]:
    """Every known one-line notice: (license_id, text)."""
    out = []
    for key, names in NAMES.items():
        out.append((key, f"SPDX-License-Identifier: {key}"))
        for name in names:
            full = [name] if "licen" in name.lower() else [name, f"{name} License"]
            out += [(key, notice.format(x)) for notice in NOTICES for x in full]
    return out


def whole_texts() -> list[tuple[str, str]]:
    """Every known licence text: (license_id, text), in the forms in use."""
    out = []
    for key, text in TEXTS.items():
        forms = [text]
        if key == "Apache-2.0":                       # without its appendix, and the header of source files
            forms += [text[:text.index("   APPENDIX:")], text[text.index("   Licensed under the Apache License"):]]
            forms.append(forms[1].replace("END OF TERMS AND CONDITIONS", ""))
        elif key == "ISC":
            forms.append(text.replace("THE AUTHORS DISCLAIM ", "THE AUTHOR DISCLAIMS ").replace("THE AUTHORS BE", "THE AUTHOR BE"))
        elif key.startswith("BSD"):                   # numbers, or marks that are no letters
            forms.append(re.sub(r"(?m)^ *[0-9][.] ", "* ", text))
        forms += [f"{title}\n\n{x}" for title in TITLES.get(key, ()) for x in forms]
        out += [(key, x) for x in forms]
    return out


def _spelled(x: Column) -> Column:
    for pattern, new in SPELLINGS:
        x = F.regexp_replace(x, pattern, new) if set("([$^") & set(pattern) else F.replace(x, F.lit(pattern), F.lit(new))
    return F.btrim(F.regexp_replace(x, "[^a-z0-9\\x80-\\x{10ffff}]+", " "))


def canonical_line(line: Column) -> Column:
    x = F.translate(line, _UPPER, _LOWER)
    return _spelled(F.when(F.rlike(x, F.lit(_COPYRIGHT)), F.lit("")).otherwise(x))


def canonical_text(text: Column) -> Column:
    """The form of a whole text that does not depend on where its lines break."""
    lines = F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), "\r\n|\n|\r", -1)
    kept = F.transform(F.filter(lines, lambda x: ~F.rlike(x, F.lit(_NOTICE))), lambda x: F.btrim(x, F.lit(" \t*#/;")))
    return _spelled(F.regexp_replace(F.array_join(kept, " "), "[ \t\f]+", " "))


def canonical_sql(line: str) -> str:
    """``canonical_line`` as a DuckDB expression, for the oracle."""
    x = f"translate({line}, '{_UPPER}', '{_LOWER}')"
    x = f"CASE WHEN regexp_matches({x}, '{_COPYRIGHT}') THEN '' ELSE {x} END"
    for pattern, new in SPELLINGS:
        plain = not set("([$^") & set(pattern)
        x = f"replace({x}, '{pattern}', '{new}')" if plain else "regexp_replace({}, '{}', '{}', 'g')".format(
            x, pattern, new.replace("$", "\\"))
    return f"trim(regexp_replace({x}, '[^a-z0-9\\x80-\\x{{10ffff}}]+', ' ', 'g'))"


def canonical_lines(text: Column) -> Column:
    """The canonical non-empty lines of a text."""
    cut = F.split(F.coalesce(text, F.lit("")), "\r\n|\n|\r", -1)
    return F.filter(F.transform(cut, canonical_line), lambda x: x != "")


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def known_digests(known: DataFrame) -> DataFrame:
    forms = F.array(F.array_join(canonical_lines(F.col("text")), " "), canonical_text(F.col("text")))
    whole = known.select("license_id", F.explode(forms).alias("c")).where("c <> ''")
    return whole.select("license_id", digest(F.col("c")).alias("digest")).distinct()


def default_known(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(whole_texts() + notices(), "license_id string, text string")


def scan(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(doc_id, license_id, scope, n_hits): scope is ``text`` for a whole text, ``line`` for lines."""
    known = known_digests(default_known(docs.sparkSession) if known is None else known)
    cut = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), canonical_lines(F.col("text")).alias("part"),
                      canonical_text(F.col("text")).alias("whole"))
    texts = F.transform(F.array_distinct(F.array(F.array_join("part", " "), F.col("whole"))),
                        lambda x: F.struct(F.lit("text").alias("scope"), F.lit(-1).alias("place"), x.alias("c")))
    units = cut.select("doc_id", "row", F.explode(F.concat(
        F.transform("part", lambda x, i: F.struct(F.lit("line").alias("scope"), i.alias("place"), x.alias("c"))), texts)).alias("u"))
    units = units.select("doc_id", "row", "u.scope", "u.place", digest(F.col("u.c")).alias("digest"))
    return (units.join(known, "digest").groupBy("doc_id", "license_id", "scope")
                 .agg(F.count_distinct(F.struct("row", "place")).alias("n_hits")))
