import re

import pytest

from tests.conftest import spark  # noqa: F401  (one session for the whole run)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def docs(spark):  # noqa: F811
    """Documents with nulls, empties, repeated rows and columns whose names clash with the operators' own."""
    base = " ".join(f"word{i}" for i in range(60))
    near = base.replace("word59", "other")
    rows = [(1, base, "a"), (2, near, "a"), (3, base.upper(), None), (4, None, "b"), (5, "", "b"), (6, " \n\t", "b"), (7, "one two", "c"),
            (8, "one two", "c"), (9, " ".join(f"far{i}" for i in range(80)), "c"), (9, " ".join(f"far{i}" for i in range(80)), "c"),
            (None, base, "a"), (10, "x " * 3000, "d"), (11, "same\nsame\nanother line here\nsame", "d"),
            (12, "Another Line Here \nown line of text", None)]
    return spark.createDataFrame([(*r, "v1", "v2", "v3", 7) for r in rows],
                                 "doc_id long, text string, source string, cls string, line string, kept string, n long")


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)
