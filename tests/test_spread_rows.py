"""Aggregations with a group per sales line: dealt by rows, with the results of the plain form."""

import datetime
from decimal import Decimal

import pytest

from casebook.operators.spread import ROWS_PER_TASK, spread, tasks_for
from casebook.plans import clo
from casebook.plans.report import monthly_report

SCHEMA = "prod_id long, qty int, price decimal(18,2), discount int, member boolean, txn_id long, txn_date date"


@pytest.fixture(scope="module")
def sales(spark):
    day = datetime.date(2020, 1, 31)
    rows = [(1, 2, Decimal("10.50"), 10, True, 7, day), (1, 2, Decimal("10.50"), 10, True, 7, day), (2, 1, Decimal("3.00"), None, True, 7, day),
            (None, 1, Decimal("4.00"), 5, True, 7, day), (3, 1, None, 5, False, 7, day), (1, 1, Decimal("1.00"), 0, None, None, None),
            (None, 1, Decimal("9.00"), 50, False, 8, datetime.date(2020, 2, 1)), (2, 4, Decimal("2.25"), 20, False, 9, day)]
    return spark.createDataFrame(rows, SCHEMA)


def held(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_tasks_follow_the_rows(spark):
    least = spark.sparkContext.defaultParallelism
    assert tasks_for(spark, 0) == least and tasks_for(spark, 1000 * ROWS_PER_TASK + 1) == 1001
    df = spark.range(1000)
    assert spread(df, 37, "id").rdd.getNumPartitions() == 37 and spread(df, None, "id") is df


def test_transactions_by_hand(sales):
    want = [(7, True, 2, Decimal("4.4000"), Decimal("41.6000")), (7, False, 1, None, None), (None, None, 1, Decimal("0.0000"), Decimal("1.0000")),
            (8, False, 0, Decimal("4.5000"), Decimal("4.5000")), (9, False, 1, Decimal("1.8000"), Decimal("7.2000"))]
    for tasks in (None, 5):
        assert held(clo.per_txn(sales, tasks)) == sorted(want, key=str)


def test_dealt_rows_give_the_same_results(spark, sales):
    products = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (3, "c2")], "product_id long, product_name string")
    for query in (clo.transaction_stats, clo.mean_discount_per_txn, clo.member_split, clo.member_revenue, clo.revenue_percentiles):
        assert held(query(sales, 5)) == held(query(sales))
    for query in (clo.penetration, clo.top_combination):
        assert held(query(sales, products, 5)) == held(query(sales, products))
    assert {(r.prod_id, r.txns, r.penetration) for r in clo.penetration(sales, products, 5).collect()} == {(1, 1, 33.33), (2, 2, 66.67), (3, 1, 33.33)}
    report = [monthly_report(sales, products, tasks=t)["transactions"] for t in (None, 5)]
    assert held(report[0]) == held(report[1])


def test_no_table_of_lines_before_the_shuffle(sales):
    """Every aggregation by line follows the shuffle to the stated tasks; none stands before it, in the scan."""
    plan = clo.per_txn(sales, 5)._jdf.queryExecution().executedPlan().toString()
    first = plan.rindex("REPARTITION_BY_NUM")
    assert plan.count("REPARTITION_BY_NUM") == 2 and "Aggregate" not in plan[first:] and "ENSURE_REQUIREMENTS" not in plan
