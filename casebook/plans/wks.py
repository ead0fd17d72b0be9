"""Weekly sales: cleaning, profiling, shares, before/after comparisons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.functions.labels import (UNKNOWN, age_band, age_band_sql, day_name, demographic,
                                       demographic_sql)
from casebook.functions.numeric import avg_expr, exact_avg, ratio_expr
from casebook.operators import with_total_share
from casebook.operators.before_after import before_after, before_after_sql
from casebook.sources import subjects as S
from casebook.sources.io import materialize_once
from casebook.sources.subjects_sql import VIEWS, with_views

PIVOT = "1998-06-15"             # baseline week of the change

QUERIES: dict = {}
ORACLE: dict = {}


def clean_weekly_sales(raw: DataFrame) -> DataFrame:
    wd = F.try_to_date(F.col("week_date"), "d/M/yyyy")          # malformed text -> NULL
    seg = F.when(F.col("segment") == "null", F.lit(UNKNOWN)).otherwise(F.col("segment"))
    return raw.select(
        wd.alias("week_date"),
        F.ceil(F.dayofyear(wd) / 7).cast("int").alias("week_number"),      # 7-day block from Jan 1
        F.weekofyear(wd).alias("iso_week_number"),                           # ISO week (T17)
        F.month(wd).alias("month_number"),
        F.year(wd).alias("calendar_year"),
        "region", "platform", seg.alias("segment"),
        age_band("segment").alias("age_band"), demographic("segment").alias("demographic"),
        "customer_type", "transactions", "sales",
        F.expr(ratio_expr("sales", "transactions")).alias("avg_transaction"))


def profile(ws: DataFrame) -> DataFrame:
    return ws.agg(*[F.count_distinct(c).alias(f"distinct_{c}") for c in
                    ("week_date", "region", "platform", "segment", "customer_type")],
                  F.min("transactions").alias("min_transactions"),
                  F.max("transactions").alias("max_transactions"),
                  F.min("sales").alias("min_sales"), F.max("sales").alias("max_sales"))


def week_days(cws: DataFrame) -> DataFrame:
    return cws.select("week_date", day_name("week_date").alias("day_of_week")).distinct()


def missing_weeks(cws: DataFrame) -> DataFrame:
    """Weeks without sales, by year (at most 53 rows a year)."""
    seen = cws.select("calendar_year", "week_number").distinct()
    weeks = F.explode(F.sequence(F.lit(1), F.lit(53))).alias("week_number")
    return seen.select("calendar_year").distinct().select("calendar_year", weeks).join(
        seen, ["calendar_year", "week_number"], "left_anti")


def per_year(cws: DataFrame) -> DataFrame:
    return cws.groupBy("calendar_year").agg(F.count(F.lit(1)).alias("rows"),
                                            F.sum("transactions").alias("total_transactions"))


def region_month_sales(cws: DataFrame) -> DataFrame:
    return cws.groupBy("region", "calendar_year", "month_number").agg(
        F.sum("sales").cast("decimal(38,2)").alias("total_sales"))


def platform_transactions(cws: DataFrame) -> DataFrame:
    return cws.groupBy("platform").agg(F.sum("transactions").alias("total_transactions"))


def _shares(cws, by, col, values, names):
    aggs = [F.sum(F.when(F.col(col) == v, F.col("sales"))).alias(n) for v, n in zip(values, names)]
    t = cws.groupBy(*by).agg(*aggs, F.sum("sales").alias("_total"))
    return t.select(*by, *[F.round(F.try_divide(F.lit(100.0) * F.col(n).cast("double"),
                                                F.col("_total").cast("double")), 2).alias(n) for n in names])


def platform_share(cws):
    return _shares(cws, ["calendar_year", "month_number"], "platform",
                   ["Retail", "Shopify"], ["retail_pct", "shopify_pct"])


def demographic_share(cws):
    return _shares(cws, ["calendar_year"], "demographic", ["Couples", "Families", UNKNOWN],
                   ["couples_pct", "families_pct", "unknown_pct"])


def retail_contribution(cws):
    t = (cws.filter(F.col("platform") == "Retail").groupBy("age_band", "demographic")
            .agg(F.sum("sales").alias("sales")))
    return with_total_share(t, "sales", "pct_of_retail").withColumn(
        "sales", F.col("sales").cast("decimal(38,2)"))


def transaction_size(cws):
    return cws.groupBy("calendar_year", "platform").agg(
        exact_avg("avg_transaction").alias("avg_of_avg_transaction"),
        F.expr(ratio_expr("SUM(sales)", "SUM(transactions)")).alias("ratio_of_sums"))


def _cws(sp: SparkSession, d: str) -> DataFrame:
    return clean_weekly_sales(S.wks_weekly_sales(sp, d))


# ---- registry -----------------------------------------------------------------
VIEWS["clean_weekly_sales"] = f"""
SELECT strptime(week_date, '%d/%m/%Y')::DATE AS week_date,
       CAST(ceil(dayofyear(strptime(week_date, '%d/%m/%Y')::DATE) / 7.0) AS INTEGER) AS week_number,
       CAST(weekofyear(strptime(week_date, '%d/%m/%Y')::DATE) AS INTEGER) AS iso_week_number,
       CAST(month(strptime(week_date, '%d/%m/%Y')::DATE) AS INTEGER) AS month_number,
       CAST(year(strptime(week_date, '%d/%m/%Y')::DATE) AS INTEGER) AS calendar_year,
       region, platform, CASE WHEN segment = 'null' THEN '{UNKNOWN}' ELSE segment END AS segment,
       {age_band_sql('segment')} AS age_band, {demographic_sql('segment')} AS demographic,
       customer_type, transactions, sales,
       {ratio_expr('sales', 'transactions', 2, 'duck')} AS avg_transaction
FROM weekly_sales"""
CW = "weekly_sales clean_weekly_sales"


def _reg(name, fn, sql, views=CW):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


_reg("M1_clean_weekly_sales", _cws, "SELECT * FROM clean_weekly_sales")
_reg("M2_domain_profile", lambda sp, d: profile(S.wks_weekly_sales(sp, d)),
     """SELECT COUNT(DISTINCT week_date) AS distinct_week_date, COUNT(DISTINCT region) AS distinct_region,
               COUNT(DISTINCT platform) AS distinct_platform, COUNT(DISTINCT segment) AS distinct_segment,
               COUNT(DISTINCT customer_type) AS distinct_customer_type,
               MIN(transactions) AS min_transactions, MAX(transactions) AS max_transactions,
               MIN(sales) AS min_sales, MAX(sales) AS max_sales FROM weekly_sales""", "weekly_sales")
_reg("M3_week_days", lambda sp, d: week_days(_cws(sp, d)),
     "SELECT DISTINCT week_date, dayname(week_date) AS day_of_week FROM clean_weekly_sales")
_reg("M3b_missing_weeks", lambda sp, d: missing_weeks(_cws(sp, d)),
     """SELECT y.calendar_year, CAST(r.range AS INTEGER) AS week_number
        FROM (SELECT DISTINCT calendar_year FROM clean_weekly_sales) y, range(1, 54) r
        EXCEPT SELECT calendar_year, week_number FROM clean_weekly_sales""")
_reg("M4_per_year", lambda sp, d: per_year(_cws(sp, d)),
     """SELECT calendar_year, COUNT(*) AS rows, CAST(SUM(transactions) AS BIGINT) AS total_transactions
        FROM clean_weekly_sales GROUP BY calendar_year""")
_reg("M4b_region_month_sales", lambda sp, d: region_month_sales(_cws(sp, d)),
     """SELECT region, calendar_year, month_number, CAST(SUM(sales) AS DECIMAL(38,2)) AS total_sales
        FROM clean_weekly_sales GROUP BY 1, 2, 3""")
_reg("M4c_platform_transactions", lambda sp, d: platform_transactions(_cws(sp, d)),
     """SELECT platform, CAST(SUM(transactions) AS BIGINT) AS total_transactions
        FROM clean_weekly_sales GROUP BY platform""")


def _share_sql(by, col, values, names):
    sums = ", ".join(f"SUM(CASE WHEN {col} = '{v}' THEN sales END) AS {n}" for v, n in zip(values, names))
    outs = ", ".join(f"ROUND(100.0 * CAST({n} AS DOUBLE) / CAST(_total AS DOUBLE), 2) AS {n}"
                     for n in names)
    b = ", ".join(by)
    return f"""SELECT {b}, {outs} FROM (SELECT {b}, {sums}, SUM(sales) AS _total
               FROM clean_weekly_sales GROUP BY {b}) t"""


_reg("M5_platform_share", lambda sp, d: platform_share(_cws(sp, d)),
     _share_sql(["calendar_year", "month_number"], "platform", ["Retail", "Shopify"],
                ["retail_pct", "shopify_pct"]))
_reg("M6_demographic_share", lambda sp, d: demographic_share(_cws(sp, d)),
     _share_sql(["calendar_year"], "demographic", ["Couples", "Families", UNKNOWN],
                ["couples_pct", "families_pct", "unknown_pct"]))
_reg("M7_retail_contribution", lambda sp, d: retail_contribution(_cws(sp, d)),
     """SELECT age_band, demographic, CAST(sales AS DECIMAL(38,2)) AS sales,
               ROUND(100.0 * CAST(sales AS DOUBLE) / CAST(SUM(sales) OVER () AS DOUBLE), 2) AS pct_of_retail
        FROM (SELECT age_band, demographic, SUM(sales) AS sales FROM clean_weekly_sales
              WHERE platform = 'Retail' GROUP BY 1, 2) t""")
_reg("M8_transaction_size", lambda sp, d: transaction_size(_cws(sp, d)),
     f"""SELECT calendar_year, platform,
               {avg_expr('avg_transaction', 2, 'duck')} AS avg_of_avg_transaction,
               {ratio_expr('SUM(sales)', 'SUM(transactions)', 2, 'duck')} AS ratio_of_sums
        FROM clean_weekly_sales GROUP BY 1, 2""")

def _stored(sp, d):
    """clean_weekly_sales as a table: a real date, partitioned by year, so date ranges reach the scan."""
    return materialize_once(sp, "clean_weekly_sales", d, lambda: _cws(sp, d), partition_by="calendar_year")


_P = f"DATE '{PIVOT}'"
for _w, _key in ((4, "M9_before_after_4_weeks"), (12, "M9b_before_after_12_weeks")):
    _reg(_key, (lambda w: lambda sp, d: before_after(_stored(sp, d), "week_date", PIVOT, w, "sales"))(_w),
         before_after_sql("clean_weekly_sales", "week_date", _P, _w, "sales"))

_reg("M9c_before_after_4_weeks_inclusive",
     lambda sp, d: before_after(_stored(sp, d), "week_date", PIVOT, 4, "sales", inclusive_after=True),
     before_after_sql("clean_weekly_sales", "week_date", _P, 4, "sales", inclusive_after=True))

for _w, _key in ((4, "M10_before_after_by_year_4_weeks"), (12, "M10b_before_after_by_year_12_weeks")):
    _reg(_key, (lambda w: lambda sp, d: before_after(
        _stored(sp, d), "week_date", None, w, "sales", by="calendar_year",
        pivot_per_row=F.make_date(F.col("calendar_year"), F.lit(6), F.lit(15))))(_w),
        before_after_sql("clean_weekly_sales", "week_date", "make_date(calendar_year, 6, 15)",
                         _w, "sales", by="calendar_year"))

for _dim, _key in (("region", "M11_before_after_by_region"), ("platform", "M11b_before_after_by_platform"),
                   ("age_band", "M11c_before_after_by_age_band"),
                   ("demographic", "M11d_before_after_by_demographic"),
                   ("customer_type", "M11e_before_after_by_customer_type")):
    _reg(_key, (lambda b: lambda sp, d: before_after(_stored(sp, d), "week_date", PIVOT, 12, "sales", by=b))(_dim),
         before_after_sql("clean_weekly_sales", "week_date", _P, 12, "sales", by=_dim))
