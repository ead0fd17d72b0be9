"""Staging, pruning, ordering and joins of the analyses."""

import datetime as dt

import pytest

import __spark_entry__ as E
from casebook.functions.labels import month_name
from casebook.operators import rank_by, top_values
from casebook.operators.range_join import join_periods
from casebook.sources import io
from tests.conftest import SMALL, rows


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def test_two_segment_queries_write_the_metrics_once(spark, tmp_path):
    for name in ("part", "lineitem"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SMALL}/{name}.parquet")
    before = {k: len(v) for k, v in io._staged.items()}
    first = E.queries()["G1_clean_metrics"](spark, str(tmp_path))
    staged = sum(len(v) for v in io._staged.values()) - sum(before.values())
    second = E.queries()["G9_filtered_metrics"](spark, str(tmp_path))
    assert staged > 0 and sum(len(v) for v in io._staged.values()) - sum(before.values()) == staged
    assert second.count() <= first.count()


def test_null_months_come_first(spark):
    got = [r.month_year for r in E.queries()["G2_records_per_month"](spark, SMALL).collect()]
    assert got[0] is None and None not in got[1:] and got[1:] == sorted(got[1:])


@pytest.mark.parametrize("name", ["M9_before_after_4_weeks", "M11_before_after_by_region"])
def test_date_range_reaches_the_scan(spark, name):
    plan = plan_of(E.queries()[name](spark, SMALL))
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x]
    assert any("GreaterThanOrEqual(week_date,1998-" in x for x in pushed), plan


def test_periods_join_without_nested_loop(spark):
    day = dt.datetime(2024, 1, 1)
    events = spark.createDataFrame([(i, day + dt.timedelta(hours=7 * i)) for i in range(400)] + [(999, None)], "id long, t timestamp_ntz")
    periods = [(k, day + dt.timedelta(hours=5 * k), day + dt.timedelta(hours=5 * k + k % 60)) for k in range(500)] + [(900, None, None)]
    p = spark.createDataFrame(periods, "period long, s timestamp_ntz, e timestamp_ntz")
    out = join_periods(events, "t", p, "s", "e")
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)
    want = []
    for i, t in [(i, day + dt.timedelta(hours=7 * i)) for i in range(400)]:
        hits = [k for k, s, e in periods if s is not None and s <= t <= e]
        want += [(i, k) for k in hits] or [(i, None)]
    assert rows(out.select("id", "period").where("id <> 999 and period is not null")) == sorted(x for x in want if x[1] is not None)
    assert rows(out.where("period is null").select("id")) == sorted([(i,) for i, k in want if k is None] + [(999,)])


def test_rank_by_and_top_values(spark):
    data = [("a", v) for v in [5, 5, 3, 9, 9, 9, None]] + [("b", 1)]
    df = spark.createDataFrame(data, "g string, v int")
    got = rows(rank_by(df.where("v is not null"), "g", "v", desc=True), "g", "v", "rank")
    assert got == [("a", 3, 6), ("a", 5, 4), ("a", 5, 4), ("a", 9, 1), ("a", 9, 1), ("a", 9, 1), ("b", 1, 1)]
    assert rows(top_values(df, "v", 2), "v") == [(1,), (3,)]
    assert rows(top_values(df, "v", 1, desc=True), "v") == [(9,)] * 3


def test_month_names(spark):
    df = spark.createDataFrame([(dt.date(2020, m, 1),) for m in (1, 5, 12)], "d date")
    assert [r[0] for r in df.select(month_name("d")).collect()] == ["January", "May", "December"]


def test_array_labels_with_unknown_and_missing_toppings(spark):
    from casebook.plans import dlv
    co = spark.createDataFrame([(1, 1, 1, [99], None), (2, 1, 1, None, [1, 1, 2]), (3, 1, 1, [1, 2, 3], None)],
                               "order_id long, customer_id long, pizza_id long, exclusions array<int>, extras array<int>")
    names = spark.createDataFrame([(1, "P")], "pizza_id long, pizza_name string")
    recipes = spark.createDataFrame([(1, "1, 2, 3")], "pizza_id long, toppings string")
    toppings = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "topping_id int, topping_name string")
    assert rows(dlv.line_labels(co, names, toppings), "order_id", "order_item") == [(1, "P"), (2, "P - Extra a, b"), (3, "P - Exclude a, b, c")]
    assert rows(dlv.ingredient_labels(co, names, recipes, toppings), "order_id", "ingredients") == [(1, "P: a, b, c"), (2, "P: 3xa, 2xb, c")]
    ro = spark.createDataFrame([(1, None), (2, None), (3, None)], "order_id long, cancellation string")
    assert rows(dlv.ingredient_totals(co, ro, names, recipes, toppings)) == [("a", 4), ("b", 3), ("c", 2)]
