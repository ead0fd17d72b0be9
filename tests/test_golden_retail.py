"""Retail loyalty on the reference's own 15 sales rows, with worked answers."""

import datetime as dt
from decimal import Decimal

import pytest

from casebook.plans import ret
from tests.conftest import rows

D = dt.date


@pytest.fixture(scope="module")
def tables(spark):
    sales = spark.createDataFrame([
        ("A", D(2021, 1, 1), 1), ("A", D(2021, 1, 1), 2), ("A", D(2021, 1, 7), 2), ("A", D(2021, 1, 10), 3),
        ("A", D(2021, 1, 11), 3), ("A", D(2021, 1, 11), 3), ("B", D(2021, 1, 1), 2), ("B", D(2021, 1, 2), 2),
        ("B", D(2021, 1, 4), 1), ("B", D(2021, 1, 11), 1), ("B", D(2021, 1, 16), 3), ("B", D(2021, 2, 1), 3),
        ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 1), 3), ("C", D(2021, 1, 7), 3)],
        "customer_id string, order_date date, product_id int")
    menu = spark.createDataFrame([(1, "sushi", Decimal("10")), (2, "curry", Decimal("15")),
                                  (3, "ramen", Decimal("12"))],
                                 "product_id int, product_name string, price decimal(18,2)")
    members = spark.createDataFrame([("A", D(2021, 1, 7)), ("B", D(2021, 1, 9))],
                                    "customer_id string, join_date date")
    return sales, menu, members


def test_spend(tables):
    s, m, _ = tables
    assert rows(ret.spend_per_customer(s, m)) == [("A", 76), ("B", 74), ("C", 36)]


def test_visit_days(tables):
    assert rows(ret.visit_days(tables[0])) == [("A", 4), ("B", 6), ("C", 2)]


def test_first_items_keep_ties(tables):
    s, m, _ = tables
    assert rows(ret.first_items(s, m)) == [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen")]


def test_most_bought(tables):
    s, m, _ = tables
    assert rows(ret.most_purchased_item(s, m)) == [("ramen", 8)]
    assert rows(ret.most_purchased_item_by_customer(s, m), "customer_id", "purchase_count") == [
        ("A", 3), ("B", 2), ("C", 3)]


def test_member_first_and_last(tables):
    s, m, mem = tables
    assert rows(ret.first_item_as_member(s, mem, m), "customer_id", "product_name") == [
        ("A", "curry"), ("B", "sushi")]
    assert rows(ret.last_item_before_member(s, mem, m), "customer_id", "product_name") == [
        ("A", "curry"), ("A", "sushi"), ("B", "sushi")]


def test_before_joining(tables):
    s, m, mem = tables
    assert rows(ret.before_joining_totals(s, mem, m)) == [("A", 2, 25), ("B", 3, 40)]


def test_points(tables):
    s, m, mem = tables
    assert rows(ret.points(s, m, bonus_item="sushi")) == [("A", 860), ("B", 940), ("C", 360)]
    assert rows(ret.points_first_week(s, mem, m, bonus_item="sushi", cutoff="2021-01-31")) == [
        ("A", 1020), ("B", 320)]


def test_member_ranking_only_members(tables):
    s, m, mem = tables
    r = ret.member_ranking(s, mem, m)
    got = rows(r.filter("customer_id = 'A'"), "order_date", "member", "ranking")
    assert got[:2] == [(D(2021, 1, 1), "N", None), (D(2021, 1, 1), "N", None)]
    assert [g[2] for g in got[2:]] == [1, 2, 3, 3]
