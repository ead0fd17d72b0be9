"""PostgreSQL semantics the analyses rely on, as Spark behaves here."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from casebook.functions.numeric import ratio_expr
from casebook.operators.funnel import funnel

D = dt.date


def one(spark, expr):
    return spark.range(1).select(F.expr(expr).alias("x")).first()["x"]


def test_t1_integer_division_and_exact_ratio(spark):
    assert one(spark, "7 / 2") == 3.5 and one(spark, "7 div 2") == 3
    assert one(spark, ratio_expr("7", "2", 2)) == Decimal("3.50")
    assert one(spark, ratio_expr("-7", "8", 2)) == Decimal("-0.88")         # half away from zero


def test_t3_t6_empty_unnest(spark):
    df = spark.createDataFrame([(1, None), (2, [5])], "k int, a array<int>")
    assert df.select(F.explode("a")).count() == 1 and df.select(F.explode_outer("a")).count() == 2
    seq = F.when(F.lit(2) <= F.lit(1), F.sequence(F.lit(2), F.lit(1))).otherwise(F.array().cast("array<int>"))
    assert spark.range(1).select(F.explode(seq)).count() == 0               # guarded series


def test_t7_t8_day_arithmetic(spark):
    assert one(spark, "datediff(DATE'2020-03-01', DATE'2020-02-01')") == 29
    assert one(spark, "date_add(DATE'2021-01-07', 6)") == D(2021, 1, 13)


def test_t12_ordered_string_agg(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c")], "k int, v string")
    assert df.groupBy("k").agg(F.array_join(F.array_sort(F.collect_list("v")), ", ").alias("s")).first()["s"] \
        == "a, b, c"


def test_t13_sum_of_no_match_is_null(spark):
    ev = spark.createDataFrame([("v1", 3, 1, dt.datetime(2024, 1, 1), 1)],
                               "visit_id string, page_id int, event_type int, event_time timestamp_ntz, event_id long")
    pages = spark.createDataFrame([(3, "Product 1", "Category 1", 1)],
                                  "page_id int, page_name string, product_category string, product_id int")
    r = funnel(ev, pages, "product_category").first()
    assert (r["viewed"], r["added_to_cart"], r["purchased"]) == (1, None, None)


def test_t14_number_text(spark):
    assert one(spark, "concat(CAST(12.5 AS DECIMAL(38,2)), ' minutes')") == "12.50 minutes"
    assert one(spark, "concat(CAST(3 AS DOUBLE), ' minutes')") == "3.0 minutes"     # why decimals are cast


def test_t15_t17_names_and_weeks(spark):
    assert one(spark, "date_format(DATE'2021-01-01', 'EEEE')") == "Friday"       # not padded
    assert one(spark, "weekofyear(DATE'2021-01-01')") == 53                       # ISO week
    assert one(spark, "CAST(ceil(dayofyear(DATE'2021-01-01') / 7) AS INT)") == 1  # 7-day block


def test_t16_seconds_between(spark):
    assert one(spark, "timestampdiff(SECOND, TIMESTAMP_NTZ'2020-01-01 18:05:02', "
                      "TIMESTAMP_NTZ'2020-01-01 18:15:34')") == 632


def test_t22_explicit_date_pattern(spark):
    assert one(spark, "to_date(concat('01-', '03-2019'), 'dd-MM-yyyy')") == D(2019, 3, 1)


def test_t25_size_of_null_guarded(spark):
    assert one(spark, "coalesce(size(CAST(NULL AS ARRAY<INT>)), 0)") in (0, -1)
    df = spark.createDataFrame([(None,), ([1, 4],)], "a array<int>")
    got = [r[0] for r in df.select(F.coalesce(F.size("a"), F.lit(0))).collect()]
    assert sorted(max(g, 0) for g in got) == [0, 2]


def test_t28_least_ignores_null(spark):
    assert one(spark, "least(DATE'2020-12-31', CAST(NULL AS DATE))") == D(2020, 12, 31)


def test_zero_total_share_is_null_not_an_error(spark):
    from casebook.operators import percent_of_group, with_total_share
    df = spark.createDataFrame([("a", Decimal("0.00")), ("b", Decimal("0.00"))], "k string, v decimal(18,2)")
    assert [r["s"] for r in with_total_share(df, "v", "s").collect()] == [None, None]
    assert [r["s"] for r in percent_of_group(df, "k", "v", "s").collect()] == [None, None]


def test_cleaning_turns_bad_dates_into_null(spark):  # T18: no job failure on dirty text
    from casebook.plans.seg import clean_metrics
    from casebook.plans.wks import clean_weekly_sales
    raw = spark.createDataFrame([("15/6/1998", "EUROPE", "Retail", "C1", "New", 3, Decimal("30.00")),
                                 ("31/2/1998", "ASIA", "Shopify", "null", "Guest", 1, Decimal("5.00"))],
                                "week_date string, region string, platform string, segment string, "
                                "customer_type string, transactions long, sales decimal(38,2)")
    got = {r.region: (r.week_date, r.segment, r.age_band, r.demographic) for r in clean_weekly_sales(raw).collect()}
    assert got["EUROPE"] == (D(1998, 6, 15), "C1", "Young Adults", "Couples")
    assert got["ASIA"] == (None, "unknown", "unknown", "unknown")
    m = spark.createDataFrame([("7", "2018", "07-2018", "1", 1.0, 1.0, 1, 1.0),
                               (None, None, None, "x", 1.0, 1.0, 1, 1.0),
                               ("13", "2018", "13-2018", "2", 1.0, 1.0, 1, 1.0)],
                              "_month string, _year string, month_year string, interest_id string, "
                              "composition double, index_value double, ranking int, percentile_ranking double")
    got = sorted(((r.month_year is None, r.interest_id) for r in clean_metrics(m).collect()), key=repr)
    assert got == sorted([(False, 1), (True, 2), (True, None)], key=repr)


def test_exact_average_never_overflows_or_wraps(spark):
    from decimal import ROUND_HALF_UP
    from casebook.functions.numeric import avg_expr, ratio_expr
    vals = ["1.01", "-3.3", "0.01", "99999999999999999.99", "12345678901234567.89"]
    rows = ", ".join(f"(CAST({v} AS DECIMAL(38,2)))" for v in vals)
    r = spark.sql(f"SELECT {avg_expr('x', 2)} AS a, {avg_expr('x', 4)} AS a4, {ratio_expr('SUM(x)', '7', 2)} AS r "
                  f"FROM (VALUES {rows}) t(x)").first()
    s = sum(Decimal(v) for v in vals)
    assert r["a"] == (s / 5).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert r["a4"] == (s / 5).quantize(Decimal("0.0001"), ROUND_HALF_UP)
    assert r["r"] == (s / 7).quantize(Decimal("0.01"), ROUND_HALF_UP)
