"""Exact discrete percentiles without gathering or sorting all values.

``percentile_disc(p)`` (SQL standard) is the first value whose cumulative
share reaches p, i.e. the value at sorted position ceil(p * n). Equal values
collapse into (value, count) rows first, so a hot value is one row. A histogram
of ``BUCKETS`` equal steps between the least and the greatest value tells which
buckets hold a wanted position, one for each p; only their values are sorted
across the cluster (a range partitioning). One total per partition gives every
partition's starting position (a window over as many rows as there are
partitions); running counts are then needed only inside the partitions that hold
a wanted position. However unevenly the values lie, the histogram only saves
sorting; values that are no numbers make one bucket.
"""

from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import NumericType

from casebook.operators.broadcast import broadcast_if_small
from casebook.sources.io import materialize


BUCKETS = 4096              # rows of the histogram the driver reads, whatever the input


def _bucket(counted: DataFrame) -> Column:
    """Bucket of a value: never falls as the value grows, equal for equal values."""
    if not isinstance(counted.schema["v"].dataType, NumericType):
        return F.lit(0)
    ends = counted.agg(F.min("v").cast("double").alias("lo"), F.max("v").cast("double").alias("hi")).first()
    at = F.width_bucket(F.col("v").cast("double"), F.lit(ends.lo), F.lit(ends.hi), F.lit(BUCKETS))
    return F.coalesce(at, F.lit(0).cast("long"))          # null for all values alike: one value, NaN or infinite ends


def percentile_disc(df: DataFrame, col: str, ps: Sequence[float], names: Sequence[str]) -> DataFrame:
    """One row with a column per wanted percentile; NULLs do not count, all are NULL without values."""
    values = df.select(F.col(col).alias("v")).filter(F.col("v").isNotNull())
    counted = materialize(values.groupBy("v").agg(F.count(F.lit(1)).alias("c")), "percentile_values")
    bucket = _bucket(counted)
    histogram = sorted(counted.groupBy(bucket.alias("b")).agg(F.sum("c").alias("t")).collect())
    n = sum(t for _, t in histogram)
    position = {name: max(math.ceil(p * n), 1) for p, name in zip(ps, names)}
    held, passed, left_out = [], 0, 0
    target = dict(position)                               # positions among the values of the held buckets
    for b, t in histogram:
        inside = [name for name, at in position.items() if passed < at <= passed + t]
        for name in inside:
            target[name] = position[name] - left_out
        if inside:
            held.append(b)
        else:
            left_out += t
        passed += t
    # the partition number is in the upper bits of the id
    placed = (counted.where(bucket.isin(held) if held else F.lit(False)).orderBy("v")
              .withColumn("part", F.shiftright(F.monotonically_increasing_id(), 33)))
    placed = materialize(placed, "percentile_places")
    totals = placed.groupBy("part").agg(F.sum("c").alias("t"))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("start", F.coalesce(F.sum("t").over(before), F.lit(0)))
    holds = F.lit(False)
    for t in target.values():
        holds = holds | ((F.col("start") < t) & (F.lit(t) <= F.col("start") + F.col("t")))
    wanted = placed.join(broadcast_if_small(totals.where(holds).select("part", "start")), "part")
    inside = W.partitionBy("part").orderBy("v").rowsBetween(W.unboundedPreceding, 0)
    wanted = wanted.withColumn("cum", F.col("start") + F.sum("c").over(inside))
    return wanted.agg(*[F.min(F.when(F.col("cum") >= t, F.col("v"))).alias(name) for name, t in target.items()])
