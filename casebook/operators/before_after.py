"""Before/after comparison of a measure around a pivot date, in one scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casebook.functions.labels import change_label


def before_after(df: DataFrame, date_col: str, pivot, weeks: int, measure: str,
                 by=(), pivot_per_row: Column | None = None, inclusive_after: bool = False) -> DataFrame:
    """Sum ``measure`` over [pivot - weeks, pivot) and [pivot, pivot + weeks).

    Windows are half-open (the "after" window has ``weeks`` weekly points);
    ``inclusive_after`` closes the after window (BETWEEN pivot AND pivot +
    weeks: one more weekly point), the form some reports use.
    ``pivot`` is a date literal, or ``pivot_per_row`` gives each row its own
    pivot (e.g. June 15 of the row's year) so several years run in one pass.
    Output: before_sales, after_sales, difference, pct_change (vs before),
    symmetric_rate (vs before + after), change label.
    """
    by = [by] if isinstance(by, str) else list(by)
    d = F.col(date_col)
    p = pivot_per_row if pivot_per_row is not None else F.lit(pivot).cast("date")
    lo, hi = F.date_sub(p, 7 * weeks), F.date_add(p, 7 * weeks)
    upper = (d <= hi) if inclusive_after else (d < hi)
    window = df.filter((d >= lo) & upper)               # reaches the scan if p is a literal and date_col a stored date
    m = F.col(measure)
    agg = window.groupBy(*by).agg(
        F.sum(F.when(d < p, m)).cast("decimal(38,2)").alias("before_sales"),
        F.sum(F.when(d >= p, m)).cast("decimal(38,2)").alias("after_sales"))
    diff = F.col("after_sales") - F.col("before_sales")
    return agg.select(
        *by, "before_sales", "after_sales", diff.cast("decimal(38,2)").alias("difference"),
        F.round(F.try_divide(F.lit(100.0) * diff.cast("double"), F.col("before_sales").cast("double")), 2)
         .alias("pct_change"),
        F.round(F.try_divide(F.lit(100.0) * diff.cast("double"),
                             (F.col("after_sales") + F.col("before_sales")).cast("double")), 2)
         .alias("symmetric_rate"),
        change_label(diff).alias("change"))


def before_after_sql(table: str, date_col: str, pivot_sql: str, weeks: int, measure: str,
                     by=(), inclusive_after: bool = False) -> str:
    """SQL twin of ``before_after`` (pivot given as SQL expression)."""
    by = [by] if isinstance(by, str) else list(by)
    sel = "".join(f"{b}, " for b in by)
    grp = f"GROUP BY {', '.join(by)}" if by else ""
    p = pivot_sql
    from casebook.functions.labels import change_label_sql
    return f"""SELECT {sel}before_sales, after_sales,
       CAST(after_sales - before_sales AS DECIMAL(38,2)) AS difference,
       ROUND(100.0 * CAST(after_sales - before_sales AS DOUBLE) / CAST(before_sales AS DOUBLE), 2)
         AS pct_change,
       ROUND(100.0 * CAST(after_sales - before_sales AS DOUBLE)
             / CAST(after_sales + before_sales AS DOUBLE), 2) AS symmetric_rate,
       {change_label_sql('after_sales - before_sales')} AS change
FROM (SELECT {sel}
             CAST(SUM(CASE WHEN {date_col} < {p} THEN {measure} END) AS DECIMAL(38,2)) AS before_sales,
             CAST(SUM(CASE WHEN {date_col} >= {p} THEN {measure} END) AS DECIMAL(38,2)) AS after_sales
      FROM {table}
      WHERE {date_col} >= {p} - INTERVAL {7 * weeks} DAY
        AND {date_col} {'<=' if inclusive_after else '<'} {p} + INTERVAL {7 * weeks} DAY
      {grp}) t"""
