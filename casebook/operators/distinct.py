"""Exact distinct counts that add up: bitmaps per period, merged for any longer period.

COUNT(DISTINCT) has to be worked out anew for every grouping. Here a period's ids
are kept as bitmaps of 32,768 ids each (Spark's bitmap functions), one row per
bucket that is in use. Bitmaps of months are or-ed into those of a quarter or a
year, so the detail rows are read once. Both steps combine before the shuffle.
Ids are integers, best dense (keys, row numbers): a bucket costs 4 KB however few
ids it holds; null ids do not count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def distinct_partials(df: DataFrame, by, ids: dict[str, str]) -> DataFrame:
    """``(by..., what, bucket, bitmap)``: the distinct values of several id columns (name -> column) per group."""
    by = [by] if isinstance(by, str) else list(by)
    each = F.explode(F.array(*(F.struct(F.lit(n).alias("what"), F.col(c).cast("long").alias("id")) for n, c in ids.items())))
    rows = df.select(*by, each.alias("_x")).select(*by, "_x.what", "_x.id").where("id is not null")
    return (rows.groupBy(*by, "what", F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap")))


def merge_partials(partials: DataFrame, by) -> DataFrame:
    """Partials of coarser groups: ``by`` names or expressions of the partials' group columns."""
    by = [by] if not isinstance(by, (list, tuple)) else list(by)
    return partials.groupBy(*by, "what", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(partials: DataFrame, by, names) -> DataFrame:
    """One row a group with a count for each of ``names`` (0 where there is no id)."""
    by = [by] if isinstance(by, str) else list(by)
    n = F.bitmap_count("bitmap")
    return partials.groupBy(*by).agg(*(F.coalesce(F.sum(F.when(F.col("what") == c, n)), F.lit(0)).cast("long").alias(c) for c in names))
