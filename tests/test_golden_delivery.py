"""Food delivery on the reference's own rows (14 order lines, 10 runner
orders, 2 pizzas, 12 toppings), with the worked answers."""

import datetime as dt
from decimal import Decimal

import pytest

from casebook.plans import dlv
from tests.conftest import rows

T = dt.datetime


@pytest.fixture(scope="module")
def t(spark):
    co_raw = spark.createDataFrame([
        (1, 101, 1, "", "", T(2020, 1, 1, 18, 5, 2)), (2, 101, 1, "", "", T(2020, 1, 1, 19, 0, 52)),
        (3, 102, 1, "", "", T(2020, 1, 2, 23, 51, 23)), (3, 102, 2, "", None, T(2020, 1, 2, 23, 51, 23)),
        (4, 103, 1, "4", "", T(2020, 1, 4, 13, 23, 46)), (4, 103, 1, "4", "", T(2020, 1, 4, 13, 23, 46)),
        (4, 103, 2, "4", "", T(2020, 1, 4, 13, 23, 46)), (5, 104, 1, None, "1", T(2020, 1, 8, 21, 0, 29)),
        (6, 101, 2, None, None, T(2020, 1, 8, 21, 3, 13)), (7, 105, 2, None, "1", T(2020, 1, 8, 21, 20, 29)),
        (8, 102, 1, None, None, T(2020, 1, 9, 23, 54, 33)), (9, 103, 1, "4", "1,5", T(2020, 1, 10, 11, 22, 59)),
        (10, 104, 1, None, None, T(2020, 1, 11, 18, 34, 49)),
        (10, 104, 1, "2, 6", "1,4", T(2020, 1, 11, 18, 34, 49))],
        "order_id long, customer_id long, pizza_id long, exclusions string, extras string, order_time timestamp_ntz")
    ro_raw = spark.createDataFrame([
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
        (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
        (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
        (5, 3, "2020-01-08 21:10:57", "10", "15", None),
        (6, 3, None, None, None, "Restaurant Cancellation"),
        (7, 2, "2020-01-08 21:30:45", "25km", "25mins", None),
        (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", None),
        (9, 2, None, None, None, "Customer Cancellation"),
        (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", None)],
        "order_id long, runner_id long, pickup_time string, distance string, duration string, cancellation string")
    names = spark.createDataFrame([(1, "Meatlovers"), (2, "Vegetarian")], "pizza_id long, pizza_name string")
    recipes = spark.createDataFrame([(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")],
                                    "pizza_id long, toppings string")
    toppings = spark.createDataFrame(list(enumerate(
        ["Bacon", "BBQ Sauce", "Beef", "Cheese", "Chicken", "Mushrooms", "Onions", "Pepperoni", "Peppers",
         "Salami", "Tomatoes", "Tomato Sauce"], start=1)), "topping_id int, topping_name string")
    runners = spark.createDataFrame([(1, dt.date(2021, 1, 1)), (2, dt.date(2021, 1, 3)), (3, dt.date(2021, 1, 8)),
                                     (4, dt.date(2021, 1, 15))], "runner_id long, registration_date date")
    return dict(co=dlv.clean_customer_orders(co_raw), ro=dlv.clean_runner_orders(ro_raw), names=names,
                recipes=recipes, toppings=toppings, runners=runners)


def test_counts(t):
    assert rows(dlv.order_counts(t["co"])) == [(14, 5, 10)]
    assert rows(dlv.deliveries_per_runner(t["ro"])) == [(1, 4), (2, 3), (3, 1)]
    assert rows(dlv.success_rate(t["ro"])) == [(1, 100.0), (2, 75.0), (3, 50.0)]
    assert rows(dlv.delivered_by_type(t["co"], t["ro"], t["names"])) == [("Meatlovers", 9), ("Vegetarian", 3)]
    assert rows(dlv.largest_order(t["co"], t["ro"])) == [(4, 3)]


def test_changes(t):
    assert rows(dlv.changes_per_customer(t["co"], t["ro"])) == [
        (101, 0, 2), (102, 0, 3), (103, 3, 0), (104, 2, 1), (105, 1, 0)]
    assert rows(dlv.both_changed(t["co"], t["ro"])) == [(1,)]


def test_volume_and_signups(t):
    assert rows(dlv.volume_by_hour(t["co"])) == [(11, 1), (13, 3), (18, 3), (19, 1), (21, 3), (23, 3)]
    assert rows(dlv.signups_per_week(t["runners"])) == [(1, 2), (2, 1), (3, 1)]
    assert rows(dlv.duration_range(t["ro"])) == [(30,)]


def test_cleaning(t):
    r = {x.order_id: x for x in t["ro"].collect()}
    assert (r[3].distance, r[3].duration, r[1].cancellation) == (Decimal("13.40"), 20, None)
    assert (r[10].duration, r[6].pickup_time, r[6].cancellation) == (10, None, "Restaurant Cancellation")
    c = {(x.order_id, x.extras and tuple(x.extras)) for x in t["co"].collect()}
    assert (9, (1, 5)) in c and (10, (1, 4)) in c and (3, None) in c


def test_top_extra_and_exclusion(t):
    assert rows(dlv._top_topping(t["co"], "extras", t["toppings"], "extra")) == [("Bacon", 4)]
    assert rows(dlv._top_topping(t["co"], "exclusions", t["toppings"], "exclusion")) == [("Cheese", 4)]


def test_revenue_and_profit(t):
    assert rows(dlv.revenue(t["co"], t["ro"])) == [(138, 142)]
    assert rows(dlv.profit_total(t["co"], t["ro"]), "profit") == [(Decimal("94.44"),)]


def test_labels(t):
    lab = rows(dlv.line_labels(t["co"], t["names"], t["toppings"]), "order_id", "order_item")
    assert (4, "Meatlovers - Exclude Cheese") in lab and (4, "Vegetarian - Exclude Cheese") in lab
    assert (10, "Meatlovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese") in lab
    assert (9, "Meatlovers - Exclude Cheese - Extra Bacon, Chicken") in lab and len(lab) == 14
    ing = rows(dlv.ingredient_labels(t["co"], t["names"], t["recipes"], t["toppings"]), "order_id", "ingredients")
    assert (10, "Meatlovers: 2xBacon, Beef, 2xCheese, Chicken, Pepperoni, Salami") in ing
    assert (3, "Vegetarian: Cheese, Mushrooms, Onions, Peppers, Tomato Sauce, Tomatoes") in ing and len(ing) == 14


def test_cleaning_rejects_counted_not_fatal(spark):
    raw = spark.createDataFrame([
        (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
        (6, 3, None, None, None, "Restaurant Cancellation"),
        (9, 2, "null", "null", "null", "Customer Cancellation"),
        (11, 2, "yesterday", "far", "soon", None)],
        "order_id long, runner_id long, pickup_time string, distance string, duration string, cancellation string")
    r = dlv.cleaning_rejects(raw).first()
    assert (r.pickup_time_rejects, r.distance_rejects, r.duration_rejects, r.rows) == (1, 1, 1, 4)
    assert dlv.clean_runner_orders(raw).filter("order_id = 11").first().distance is None


def test_delays_keep_their_seconds(t):
    """Runner orders of the reference: 632, 602, 1274, 1757, 628, 616, 1229 and 931 seconds."""
    assert rows(dlv.pickup_delay_per_runner(t["co"], t["ro"])) == [(1, "16 minutes"), (2, "24 minutes"), (3, "10 minutes")]
    assert rows(dlv.prep_time_by_size(t["co"], t["ro"])) == [
        (1, 5, Decimal("12.36")), (2, 2, Decimal("18.38")), (3, 1, Decimal("29.28"))]
    two = t["ro"].where("order_id in (1, 2)")
    assert rows(dlv.prep_time_by_size(t["co"], two)) == [(1, 2, Decimal("10.28"))]
    sheet = {r.order_id: r for r in dlv.fact_sheet(t["co"], t["ro"]).collect()}
    assert (sheet[3].order_time, sheet[3].pickup_time, sheet[3].seconds_to_pickup) == ("23:51:23", "00:12:37", 1274)
