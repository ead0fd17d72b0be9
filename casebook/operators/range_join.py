"""Left join of events to the periods that contain them, by dyadic bins.

A range condition alone gives Spark no join key. A period of n days is covered
by at most 2 log2(n) bins whose lengths are powers of two (a century by some 30
rows, not 36,500), and a time lies in one bin of each length that is in use. So
distinct times are looked up by (length, bin), the exact condition is checked on
what meets, and events get their periods by their own time. Many events on one
day or at one time are many rows of one time only until the last join, which
Spark may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LEVELS = 23                          # bins of up to 2**22 days: longer than the calendar
_BASE = 1 << 22                      # days before 1970 count from here


def _day(c: str) -> Column:
    return (F.unix_date(F.to_date(c)) + _BASE).cast("long")


def dyadic_bins(first: Column, last: Column) -> Column:
    """The (level, bin) pairs that cover the numbers first to last: a bin is 2**level numbers from bin * 2**level on."""
    out = []
    for level in range(LEVELS):
        lo = F.shiftright(first + ((1 << level) - 1), level)
        hi = F.shiftright(last + 1, level)
        for number, odd in ((lo, lo), (hi - 1, hi)):
            out.append(F.when((lo < hi) & (odd % 2 == 1), F.struct(F.lit(level).alias("_level"), number.alias("_bin"))))
    return F.array_compact(F.array(*out))


def join_periods(events: DataFrame, time_col: str, periods: DataFrame, start: str, end: str) -> DataFrame:
    """Every event with each period that has ``start <= time <= end``; NULLs where there is none."""
    bins = (periods.where(F.col(start) <= F.col(end)).withColumn("_b", F.explode(dyadic_bins(_day(start), _day(end))))
            .select("*", "_b._level", "_b._bin").drop("_b"))
    used = bins.agg(F.collect_set("_level")).scalar()                       # LEVELS values at most
    times = events.select(F.col(time_col).alias("_time")).where("_time is not null").distinct()
    times = times.withColumn("_level", F.explode(used)).withColumn("_bin", F.expr(f"shiftright(unix_date(to_date(_time)) + {_BASE}L, _level)"))
    found = times.join(bins, ["_level", "_bin"]).where(F.col("_time").between(F.col(start), F.col(end))).drop("_level", "_bin")
    return events.join(found, events[time_col] == found["_time"], "left").drop("_time")
