"""Rejection of the reference's two wrong rating rows, and property checks."""

from decimal import Decimal

from pyspark.sql import functions as F

import __spark_entry__ as E
from casebook.operators.validate import validate
from tests.conftest import SMALL, rows


def test_rejects_wrong_ratings(spark):  # S11, D21
    ref = spark.createDataFrame([(1, 1, 101), (2, 1, 101), (4, 2, 103)], "order_id int, runner_id int, customer_id int")
    cand = spark.createDataFrame([(1, 1, 101, 5), (2, 1, 101, 3), (4, 2, 103, 4), (1, 1, 111, 5), (1, 1, 101, 78)],
                                 "order_id int, runner_id int, customer_id int, rating int")
    valid, rejected = validate(cand, {"rating_out_of_range": F.col("rating").between(1, 5)}, key="order_id",
                               reference=ref, ref_cols=["order_id", "runner_id", "customer_id"])
    assert rows(valid, "order_id", "rating") == [(1, 5), (2, 3), (4, 4)]
    assert rows(rejected, "customer_id", "rating", "reasons") == [(101, 78, "rating_out_of_range"),
                                                                 (111, 5, "unknown_reference")]
    assert valid.count() + rejected.count() == cand.count()


def test_running_balance_ends_at_group_sum(spark):
    q = E.queries()
    rb = q["K9_running_balance"](spark, SMALL)
    last = rb.groupBy("customer_id").agg(F.max_by("running_balance", "txn_date").alias("last"),
                                         F.sum("signed_amount").alias("total"))
    assert last.filter(F.col("last") != F.col("total")).count() == 0


def test_shares_sum_to_100(spark):
    q = E.queries()
    s = q["L9c_category_share"](spark, SMALL).agg(F.sum("revenue_share")).first()[0]
    assert abs(s - 100.0) < 0.01 * 30


def test_funnel_adds_split(spark):
    q = E.queries()
    f = q["C8_product_funnel"](spark, SMALL).fillna(0)
    assert f.filter(F.col("added_to_cart") != F.col("abandoned") + F.col("purchased")).count() == 0


def test_before_after_within_total(spark):
    q = E.queries()
    ba = q["M9b_before_after_12_weeks"](spark, SMALL).first()
    total = q["M1_clean_weekly_sales"](spark, SMALL).agg(F.sum("sales")).first()[0]
    assert (ba["before_sales"] or Decimal(0)) + (ba["after_sales"] or Decimal(0)) <= total


def test_report_for_one_month_equals_its_slice(spark):
    from casebook.plans.report import monthly_report
    from casebook.sources import subjects as S
    sales, products = S.clo_sales(spark, SMALL), S.clo_products(spark, SMALL)
    month = sales.agg(F.date_format(F.min("txn_date"), "yyyy-MM")).first()[0]
    one = monthly_report(sales, products, month)
    every = monthly_report(sales, products)
    for section in ("high_level", "transactions", "top_products"):
        a = one[section]
        b = every[section].filter(F.date_format("month", "yyyy-MM") == month)
        assert rows(a) == rows(b.select(*a.columns)) and a.count() > 0
