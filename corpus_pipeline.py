"""Training-data pipeline over ``documents``.

STAGES holds (name, function) in order; each function takes (spark, docs,
sf_dir) and returns the rows the next one works on. ``run`` writes every
stage to the shared checkpoint folder and reads it again, so a lost executor
costs tasks of one stage only.

1. quality: documents that the quality rules reject go.
2. lines: repeated lines go; ``n_chars`` follows the text.
3. near_duplicates: of each near-duplicate group (shingles of five words,
   similarity 0.8) the smallest doc_id stays, repeated rows once.
4. decontaminate: documents that hold a benchmark item go.
5. mix: the draws of the mixture, see ``mixing.mix_sources``; the training
   order is (block, position).

Rows that share a doc_id (or have none) share their fate in stages 1 and 4: they
go in stage 1 if all of them are rejected, in stage 4 if one holds an item.
Other columns than doc_id, text, source and n_chars pass through unread.
What a stage has staged on its way is deleted once the next one begins (its rows
have been written by then), and ``run`` deletes each stage's rows after the next
stage has written its own, so the disk holds one stage at a time.
Stages 1, 3 and 4 rest on hashes and floating point work that SQL does not
have, so there is no SQL for the result; tests compare with brute force.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, functions as F

from casebook.llm.common import read_table, stage
from casebook.llm.decontaminate import leaks
from casebook.llm.line_dedup import dedup_lines
from casebook.llm.mixing import mix_sources
from casebook.llm.near_dedup import near_duplicates
from casebook.llm.quality import judged
from casebook.sources.io import drop_stages, staged_paths

_inner: dict[str, list[str]] = {}                   # application id -> what its last stage has staged


def _one_at_a_time(step):
    """The stage, after deleting the folders of the stage before it; those that ``docs`` itself reads stay."""
    @functools.wraps(step)
    def run(spark, docs, sf_dir):
        app = spark.sparkContext.applicationId
        old = _inner.pop(app, [])
        if old:
            read = docs.inputFiles()
            drop_stages(spark, [p for p in old if not any(p.split(":", 1)[-1].lstrip("/") in f for f in read)])
        before = set(staged_paths(spark))
        out = step(spark, docs, sf_dir)
        _inner[app] = [p for p in staged_paths(spark) if p not in before]
        return out
    return run


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose doc_id is not in ``ids`` (one column, doc_id); null ids match null ids."""
    gone = ids.select(F.col("doc_id").alias("gone_id"))
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]), "left_anti")


def quality(spark, docs, sf_dir):
    verdicts = judged(docs, read_table(spark, sf_dir, "labels", "doc_id", "quality"))
    rejected = verdicts.groupBy("doc_id").agg(F.max("kept").alias("any_kept")).where("not any_kept")
    return _without(docs, rejected)


def line_dedup(spark, docs, sf_dir):
    changed = {"text": F.col("kept_text")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("kept_text").cast(docs.schema["n_chars"].dataType)
    return dedup_lines(docs).select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def near_dedup(spark, docs, sf_dir):
    groups = near_duplicates(docs, width=5, pct=80)
    copies = groups.groupBy("doc_id").agg(F.max("kept").alias("any_kept")).where("not any_kept")
    out = _without(docs, copies)
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        return out
    return out.dropDuplicates(["doc_id", "text"])


def decontaminate(spark, docs, sf_dir):
    found = leaks(docs, read_table(spark, sf_dir, "benchmark"))
    return _without(docs, stage(found.select("doc_id").distinct(), "pipeline_leaks"))


def mix(spark, docs, sf_dir):
    return mix_sources(docs)


STAGES = [(name, _one_at_a_time(step)) for name, step in (
    ("quality", quality), ("lines", line_dedup), ("near_duplicates", near_dedup), ("decontaminate", decontaminate), ("mix", mix))]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    done = None
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline_{name}")
        path = staged_paths(spark)[-1]
        if done:
            drop_stages(spark, [done])
        done = path
    drop_stages(spark, _inner.pop(spark.sparkContext.applicationId, []))
    return docs
