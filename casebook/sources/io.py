"""Materialised tables in the shared checkpoint folder.

``materialize`` is CREATE TABLE AS / CREATE TEMP TABLE in one step: the
DataFrame is written as parquet under the folder the cluster names in
``spark.checkpoint.dir`` and read back, which also cuts the lineage of long
plans and lets several branches read one computed result. Every call writes
its own folder (``<name>/<run id>``), so a DataFrame built earlier keeps
reading its own files even if the same stage is built again; a failed write
is simply retried into a new folder. ``materialize_once`` builds a stage that
several queries of a session share; ``drop_stages`` deletes what the session
has staged.

Stored tables with names are in ``catalog.py``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from casebook.session import checkpoint_dir

_staged: dict[str, list[str]] = {}                  # application id -> folders it has staged
_shared: dict[tuple, str] = {}                      # (application id, name, key) -> folder of the stage


def table_path(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for the stage ``name``, deleted by ``drop_stages``."""
    path = f"{table_path(spark, name)}/{uuid.uuid4().hex[:16]}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def staged_paths(spark: SparkSession) -> list[str]:
    """The folders this session has staged so far."""
    return list(_staged.get(spark.sparkContext.applicationId, []))


def materialize(df: DataFrame, name: str, partition_by=None) -> DataFrame:
    spark = df.sparkSession
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    path = stage_path(spark, name)
    w.parquet(path)
    return spark.read.parquet(path)


def materialize_once(spark: SparkSession, name: str, folder: str, build, partition_by=None) -> DataFrame:
    """The stage ``name`` for the tables in ``folder``, built by ``build()`` on first use in this session
    and again once the folder's files have changed."""
    at = (spark.sparkContext.applicationId, name, folder, _mark(spark, folder))
    if at in _shared:
        fs, done = _file(spark, f"{_shared[at]}/_SUCCESS")
        if fs.exists(done):
            return spark.read.parquet(_shared[at])
    out = materialize(build(), name, partition_by)
    _shared[at] = _staged[at[0]][-1]
    return out


def _mark(spark, folder: str):
    """Bytes, number and latest change of the tables in a folder."""
    fs, p = _file(spark, folder)
    if not fs.exists(p):
        return None
    size = fs.getContentSummary(p)
    return size.getLength(), size.getFileCount(), max((s.getModificationTime() for s in fs.listStatus(p)), default=0)


def _file(spark, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def drop_stages(spark: SparkSession, paths=None) -> int:
    """Delete the folders this session has staged (or those of them in ``paths``); returns their number.
    DataFrames that read them are void afterwards."""
    app = spark.sparkContext.applicationId
    held = _staged.get(app, [])
    gone = [p for p in held if paths is None or p in set(paths)]
    _staged[app] = [p for p in held if p not in set(gone)]
    for k in [k for k in _shared if k[0] == app and _shared[k] in set(gone)]:
        del _shared[k]
    for path in gone:
        fs, p = _file(spark, path)
        fs.delete(p, True)
    return len(gone)
