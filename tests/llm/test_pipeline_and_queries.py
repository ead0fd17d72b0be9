import collections

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from casebook.llm import queries as Q
from tests.llm.test_text_operators import lines_brute

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def test_one_query_per_operator():
    names = [n for n in E.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in E.queries()


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_sql_twins(spark, con, name):
    df = Q.QUERIES[name](spark, SMALL)
    res = con.execute(Q.ORACLE[name])
    cols = [d[0] for d in res.description]
    want = sorted((tuple(dict(zip(cols, r))[c] for c in df.columns) for r in res.fetchall()), key=repr)
    assert sorted((tuple(r) for r in df.collect()), key=repr) == want


def test_stages(spark, tmp_path):
    """Every stage on its own input: columns, what goes and what stays."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, step in P.STAGES:
        before = docs
        docs = P.stage(step(spark, before, SMALL), f"test_{name}")
        seen[name] = (before, docs)
        if name != "mix":
            assert docs.columns == columns
    before, after = seen["quality"]
    verdict = {r.doc_id: r.kept for r in Q.op5_quality_rules(spark, SMALL).collect()}
    assert {r.doc_id for r in after.collect()} == {d for d, kept in verdict.items() if kept}
    before, after = seen["lines"]
    assert {r.doc_id: r.text for r in after.collect()} == {d: t for d, _, _, t in lines_brute([(r.doc_id, r.text) for r in before.collect()])}
    assert all(r.n_chars == len(r.text) for r in after.collect())
    before, after = seen["near_duplicates"]
    from tests.llm.test_words_and_near import brute
    groups = brute([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, _, kept in groups if kept)
    before, after = seen["decontaminate"]
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    holds = {r.doc_id for r in before.collect() if any(i in " ".join(r.text.lower().split()) for i in items)}
    gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in after.collect()}
    assert holds <= gone
    before, after = seen["mix"]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}


def test_stages_on_odd_rows(spark, docs, empty, tmp_path):
    spark.createDataFrame([(1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, step in P.STAGES:
        out = step(spark, docs, str(tmp_path))
        assert {r.doc_id for r in out.collect()} <= {r.doc_id for r in docs.collect()}
        assert step(spark, empty, str(tmp_path)).collect() == []
        if name != "mix":
            assert out.columns == docs.columns
    kept = collections.Counter(r.doc_id for r in P.near_dedup(spark, docs, str(tmp_path)).collect())
    assert kept[9] == 1 and 2 not in kept and 3 not in kept and kept[4] == kept[5] == kept[6] == 1
