"""Stored tables in Spark's catalog: create, replace, append, update, delete.

Every application has a database of its own, kept in the shared folder that
``spark.checkpoint.dir`` names, so all executors see its files and two
applications never write to one table. Update and delete are copy-on-write by
partition: only partitions that hold a touched row are written again (Spark's
dynamic partition overwrite), the files of the others stay. The new rows are
staged first, so a failed write leaves the rows in the stage and the table can
be written again.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.session import checkpoint_dir
from casebook.sources.io import materialize, stage_path


def namespace(spark: SparkSession) -> str:
    """This application's database, created on first use."""
    name = "casebook_" + re.sub(r"\W", "_", spark.sparkContext.applicationId)
    if not spark.catalog.databaseExists(name):
        where = f"{checkpoint_dir(spark).rstrip('/')}/catalog/{name}".replace("'", "\\'")
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{where}'")
    return name


def full_name(spark: SparkSession, name: str) -> str:
    return f"{namespace(spark)}.{name}"


def _write(df: DataFrame, name: str, mode: str, partition_by) -> DataFrame:
    spark, w = df.sparkSession, df.write.format("parquet").mode(mode)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.saveAsTable(full_name(spark, name))
    return spark.table(full_name(spark, name))


def create_table(df: DataFrame, name: str, partition_by=None) -> DataFrame:
    """CREATE TABLE AS: an error if the table exists."""
    return _write(df, name, "errorifexists", partition_by)


def replace_table(df: DataFrame, name: str, partition_by=None) -> DataFrame:
    """DROP TABLE IF EXISTS and CREATE TABLE AS; can be repeated. ``df`` must not read the table itself."""
    return _write(df, name, "overwrite", partition_by)


def append(df: DataFrame, name: str) -> DataFrame:
    """INSERT INTO: rows are added by column name; returns the whole table."""
    spark = df.sparkSession
    table = full_name(spark, name)
    df.select(*spark.table(table).columns).write.insertInto(table)
    return spark.table(table)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {full_name(spark, name)}")


def replace_partitions(df: DataFrame, name: str) -> DataFrame:
    """INSERT OVERWRITE of the partitions that ``df`` has rows of; the others stay. Rows are written by column name."""
    spark = df.sparkSession
    table = spark.table(full_name(spark, name))
    path = stage_path(spark, f"partitions/{name}")
    df.select(*table.columns).write.parquet(path)
    writer = spark.newSession()                          # same catalog; the write mode holds for this write only
    writer.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    writer.read.schema(table.schema).parquet(path).write.insertInto(full_name(spark, name), overwrite=True)
    spark.catalog.refreshTable(full_name(spark, name))
    return spark.read.schema(table.schema).parquet(path)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(full_name(spark, name)) if c.isPartition]


def _rewrite(spark: SparkSession, name: str, touched: DataFrame, change) -> DataFrame:
    """Writes ``change(rows)`` in place of the rows of the partitions that ``touched`` (rows of the table) lies in."""
    table = spark.table(full_name(spark, name))
    by = partition_columns(spark, name)
    if not by:
        raise ValueError(f"{name} has no partition columns: replace it as a whole")
    parts = materialize(touched.select(*by).distinct(), f"touched/{name}")
    rows = _same(table, parts, by)
    new = replace_partitions(change(rows), name)
    for p in _without_rows(parts, new, by):              # an overwrite leaves partitions alone that have no new rows
        spec = ", ".join(f"{k} = {_literal(v)}" for k, v in p.asDict().items())
        spark.sql(f"ALTER TABLE {full_name(spark, name)} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(full_name(spark, name))
    return spark.table(full_name(spark, name))


def _same(rows: DataFrame, parts: DataFrame, by) -> DataFrame:
    """The rows of the listed partitions; null is a partition too."""
    p = broadcast_if_small(parts.select(*(F.col(c).alias(f"_p_{c}") for c in by)))
    on = [rows[c].eqNullSafe(p[f"_p_{c}"]) for c in by]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return rows.join(p, cond, "left_semi")


def _without_rows(parts: DataFrame, new: DataFrame, by):
    left = new.select(*(F.col(c).alias(f"_n_{c}") for c in by)).distinct()
    cond = None
    for c in by:
        one = parts[c].eqNullSafe(left[f"_n_{c}"])
        cond = one if cond is None else cond & one
    return parts.join(left, cond, "left_anti").toLocalIterator()      # partitions of the table


def _literal(v) -> str:
    return "null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def update_where(spark: SparkSession, name: str, values: dict[str, Column], where: Column) -> DataFrame:
    """UPDATE name SET ... WHERE ...: rows for which ``where`` is true get ``values``; returns the table."""
    table = spark.table(full_name(spark, name))
    hit = F.coalesce(where, F.lit(False))
    moved = set(values) & set(partition_columns(spark, name))
    if moved:
        raise ValueError(f"partition columns cannot be updated: {sorted(moved)}")
    return _rewrite(spark, name, table.where(hit), lambda rows: rows.select(
        *(F.when(hit, values[c].cast(rows.schema[c].dataType)).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in rows.columns)))


def delete_where(spark: SparkSession, name: str, where: Column) -> DataFrame:
    """DELETE FROM name WHERE ...: rows for which ``where`` is null stay, as in SQL."""
    hit = F.coalesce(where, F.lit(False))
    return _rewrite(spark, name, spark.table(full_name(spark, name)).where(hit), lambda rows: rows.where(~hit))


def delete_keys(spark: SparkSession, name: str, keys: DataFrame, on: str) -> DataFrame:
    """DELETE FROM name WHERE on IN (SELECT on FROM keys): null keys match nothing."""
    keys = materialize(keys.select(on).where(F.col(on).isNotNull()).distinct(), f"deleted/{name}")
    return _rewrite(spark, name, spark.table(full_name(spark, name)).join(keys, on, "left_semi"), lambda rows: rows.join(keys, on, "left_anti"))
