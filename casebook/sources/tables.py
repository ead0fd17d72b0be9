"""Readers for the stored parquet tables.

Every reader names the columns it needs, so the scan's ReadSchema holds
only those and filters written later are pushed into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Scan one stored table, projected to ``cols`` when given."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose stored tables to ``spark.sql`` under their own names."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)


def read_files(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """Read CSV / JSON / parquet files with a declared schema (S1 at scale).

    A declared schema skips the inference pass over the files and fixes the
    types the analyses expect; with CSV, pass e.g. ``header="true"``.
    """
    return spark.read.schema(schema).format(fmt).options(**options).load(path)
