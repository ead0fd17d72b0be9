"""Row validation in place of enforced constraints: (valid, rejected + reasons)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def validate(df: DataFrame, checks: dict[str, Column], key=None, reference: DataFrame | None = None,
             ref_cols=None):
    """Split ``df`` into (valid, rejected).

    ``checks`` maps a reason to a predicate that valid rows satisfy (CHECK);
    ``reference`` with ``ref_cols`` is a foreign key (rows must match a
    reference row); ``key`` is a primary key among the rows that pass the
    other rules (every copy of a repeated key is rejected). Rejected rows carry
    ``reasons`` (sorted, comma separated); valid + rejected = input rows.
    """
    d = df
    reasons = []
    if reference is not None:
        ref_cols = list(ref_cols)
        ref = reference.select(*ref_cols).distinct().withColumn("_ref_ok", F.lit(True))
        d = d.join(ref, on=ref_cols, how="left")
        reasons.append(F.when(F.col("_ref_ok").isNull(), F.lit("unknown_reference")))
    for name, ok in checks.items():
        reasons.append(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)))
    d = d.withColumn("_r", F.filter(F.array(*reasons), lambda x: x.isNotNull()))
    if key is not None:
        key = [key] if isinstance(key, str) else list(key)
        dup = (d.filter(F.size("_r") == 0).groupBy(*key).count().filter(F.col("count") > 1)
                .select(*key, F.lit(True).alias("_dup")))
        d = d.join(dup, key, "left").withColumn(
            "_r", F.when(F.col("_dup"), F.array_append("_r", F.lit("duplicate_key"))).otherwise(F.col("_r")))
    cols = df.columns
    valid = d.filter(F.size("_r") == 0).select(*cols)
    rejected = d.filter(F.size("_r") > 0).select(*cols, F.array_join(F.array_sort("_r"), ", ").alias("reasons"))
    return valid, rejected
