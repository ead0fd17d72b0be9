"""Food delivery: cleaning, delivery metrics, ingredients, pricing, ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.functions.cleaning import null_text, number_in, to_int_array, to_timestamp_or_null
from casebook.functions.dates import seconds_between, time_of_day
from casebook.functions.labels import day_name
from casebook.functions.numeric import avg_expr, exact_avg, ratio_expr
from casebook.operators import first_rows
from casebook.operators.lookup import names_by_role
from casebook.operators.validate import validate
from casebook.sources.io import materialize
from casebook.sources import subjects as S
from casebook.sources.subjects_sql import VIEWS, with_views

COST_PER_KM = "0.30"
PRICE_ODD, PRICE_EVEN, EXTRA_CHARGE = 12, 10, 1     # two price tiers by id parity; $1 per extra
NEW_PIZZA = "Supreme"                                # the added menu item (all toppings)

QUERIES: dict = {}
ORACLE: dict = {}


# ---- cleaning (D1) -------------------------------------------------------------
def clean_customer_orders(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", "customer_id", "pizza_id", to_int_array("exclusions").alias("exclusions"),
                      to_int_array("extras").alias("extras"), "order_time")


def clean_runner_orders(raw: DataFrame) -> DataFrame:
    return raw.select("order_id", "runner_id", to_timestamp_or_null("pickup_time").alias("pickup_time"),
                      number_in("distance", "decimal(6,2)").alias("distance"),
                      number_in("duration", "int").alias("duration"),
                      null_text("cancellation").alias("cancellation"))


def cleaning_rejects(ro_raw: DataFrame) -> DataFrame:
    """Values that carried text but did not parse (T18): counted, not fatal."""
    def bad(col, parsed):
        return F.count_if(null_text(col).isNotNull() & parsed.isNull()).alias(f"{col}_rejects")
    return ro_raw.agg(bad("pickup_time", to_timestamp_or_null("pickup_time")),
                      bad("distance", number_in("distance", "decimal(6,2)")),
                      bad("duration", number_in("duration", "int")),
                      F.count(F.lit(1)).alias("rows"))


def delivered(ro: DataFrame) -> DataFrame:
    return ro.filter(F.col("cancellation").isNull())


def price_of(pizza_id) -> F.Column:
    return F.when(F.col(pizza_id) % 2 == 0, PRICE_EVEN).otherwise(PRICE_ODD)


# ---- metrics ------------------------------------------------------------------
def recipe_bridge(recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    b = recipes.select("pizza_id", F.explode(F.split("toppings", r",\s*").try_cast("array<int>")).alias("topping_id"))
    return b.join(broadcast_if_small(toppings), "topping_id").select("pizza_id", "topping_id", "topping_name")


def order_counts(co: DataFrame) -> DataFrame:
    return co.agg(F.count(F.lit(1)).alias("pizzas_ordered"),
                  F.count_distinct("customer_id").alias("unique_customers"),
                  F.count_distinct("order_id").alias("unique_orders"))


def deliveries_per_runner(ro: DataFrame) -> DataFrame:
    return delivered(ro).groupBy("runner_id").agg(F.count(F.lit(1)).alias("delivered"))


def _delivered_lines(co, ro):
    return co.join(delivered(ro).select("order_id"), "order_id", "left_semi")


def delivered_by_type(co, ro, names):
    return (_delivered_lines(co, ro).join(names, "pizza_id").groupBy("pizza_name")
            .agg(F.count(F.lit(1)).alias("delivered")))


def delivered_by_customer_type(co, ro, names):
    return (_delivered_lines(co, ro).join(names, "pizza_id").groupBy("customer_id", "pizza_name")
            .agg(F.count(F.lit(1)).alias("delivered")))


def largest_order(co, ro):
    c = _delivered_lines(co, ro).groupBy("order_id").agg(F.count(F.lit(1)).alias("items"))
    return first_rows(c, [], "items", desc=True)


def _changed():
    return (F.coalesce(F.size("exclusions"), F.lit(0)) > 0) | (F.coalesce(F.size("extras"), F.lit(0)) > 0)


def changes_per_customer(co, ro):
    return _delivered_lines(co, ro).groupBy("customer_id").agg(
        F.count_if(_changed()).alias("changed"), F.count_if(~_changed()).alias("unchanged"))


def both_changed(co, ro):
    both = (F.coalesce(F.size("exclusions"), F.lit(0)) > 0) & (F.coalesce(F.size("extras"), F.lit(0)) > 0)
    return _delivered_lines(co, ro).agg(F.count_if(both).alias("both_changed"))


def volume_by_hour(co):
    return co.groupBy(F.hour("order_time").alias("hour")).agg(F.count(F.lit(1)).alias("pizzas"))


def volume_by_weekday(co):
    return co.groupBy(day_name("order_time").alias("weekday")).agg(F.count(F.lit(1)).alias("pizzas"))


def signups_per_week(runners):
    start = F.trunc("registration_date", "year")
    wk = (F.floor(F.datediff("registration_date", start) / 7) + 1).cast("int")
    return runners.groupBy(wk.alias("week_number")).agg(F.count(F.lit(1)).alias("runners"))


def signups_per_iso_week(runners):
    """EXTRACT(WEEK): the ISO week, in which the first days of a year may belong to the last one's."""
    return runners.groupBy(F.weekofyear("registration_date").alias("week")).agg(F.count(F.lit(1)).alias("runners_per_week"))


def _orders(co):
    return co.groupBy("order_id").agg(F.min("customer_id").alias("customer_id"),
                                      F.min("order_time").alias("order_time"),
                                      F.count(F.lit(1)).alias("items"))


def _pickups(co, ro):
    """Delivered orders with the seconds from order to pickup."""
    return delivered(ro).join(_orders(co), "order_id").withColumn("secs", seconds_between("order_time", "pickup_time"))


def pickup_delay_per_runner(co, ro):
    """Mean over the ordered pizzas (an order counts once per pizza), rounded once, to whole minutes."""
    mean = F.expr(ratio_expr("SUM(secs * items)", "SUM(IF(secs IS NULL, 0, items)) * 60", 0))
    return _pickups(co, ro).groupBy("runner_id").agg(mean.alias("_m")).select(
        "runner_id", F.concat(F.col("_m").cast("string"), F.lit(" minutes")).alias("avg_pickup"))


def prep_time_by_size(co, ro):
    return _pickups(co, ro).groupBy("items").agg(
        F.count(F.lit(1)).alias("orders"), F.expr(ratio_expr("SUM(secs)", "COUNT(secs) * 60", 2)).alias("avg_prep_minutes"))


def mean_distance_per_customer(co, ro):
    j = delivered(ro).join(_orders(co), "order_id")
    return j.groupBy("customer_id").agg(exact_avg("distance").alias("avg_distance"))


def duration_range(ro):
    return delivered(ro).agg((F.max("duration") - F.min("duration")).alias("duration_range"))


def speeds(ro):
    return delivered(ro).select("order_id", "runner_id", "distance", "duration",
                                F.expr(ratio_expr("distance * 60", "duration")).alias("speed_kmh"))


def speed_per_runner(ro):
    return speeds(ro).groupBy("runner_id").agg(exact_avg("speed_kmh").alias("avg_speed_kmh"))


def success_rate(ro):
    return ro.groupBy("runner_id").agg(
        F.round(F.lit(100.0) * F.count_if(F.col("cancellation").isNull()) / F.count(F.lit(1)), 2)
        .alias("success_pct"))


def ingredient_lists(recipes, toppings, names):
    b = recipe_bridge(recipes, toppings)
    return (b.groupBy("pizza_id").agg(F.array_join(F.array_sort(F.collect_list("topping_name")), ", ")
                                      .alias("ingredients"))
             .join(names, "pizza_id"))


def _top_topping(co, col, toppings, name):
    e = co.select(F.explode(col).alias("topping_id"))
    c = e.groupBy("topping_id").agg(F.count(F.lit(1)).alias("times"))
    return first_rows(c, [], "times", desc=True).join(broadcast_if_small(toppings), "topping_id") \
        .select(F.col("topping_name").alias(name), "times")


def revenue(co, ro):
    l = _delivered_lines(co, ro)
    return l.agg(F.sum(price_of("pizza_id")).cast("bigint").alias("revenue"),
                 F.sum(price_of("pizza_id") + EXTRA_CHARGE * F.coalesce(F.size("extras"), F.lit(0)))
                 .cast("bigint").alias("revenue_with_extras"))


def rating_candidates(co, ro) -> DataFrame:
    return rating_candidates_from(runner_order(co, ro))


def rating_candidates_from(ref: DataFrame) -> DataFrame:
    """Ratings to load: one per delivered order, plus two kinds of wrong rows
    (unknown customer; rating out of range) that repeat an order id."""
    good = ref.withColumn("rating", (F.col("order_id") % 5 + 1).cast("int"))
    bad_ref = (ref.filter(F.col("order_id") % 50 == 0)
                  .withColumn("customer_id", F.col("customer_id") + 1).withColumn("rating", F.lit(5)))
    bad_range = ref.filter(F.col("order_id") % 70 == 0).withColumn("rating", F.lit(78))
    return good.unionByName(bad_ref).unionByName(bad_range)


def runner_order(co, ro) -> DataFrame:
    return (delivered(ro).join(co.select("order_id", "customer_id"), "order_id")
            .select("order_id", "runner_id", "customer_id").distinct())


def validated_ratings(co, ro, stage: str | None = "runner_order"):
    """The reference table (one row per delivered order) is read by every
    candidate branch and by the check; it is staged once in the shared folder."""
    ref = runner_order(co, ro)
    if stage:
        ref = materialize(ref, stage)
    cands = rating_candidates_from(ref)
    return validate(cands, {"rating_out_of_range": F.col("rating").between(1, 5)}, key="order_id",
                    reference=ref, ref_cols=["order_id", "runner_id", "customer_id"])


def fact_sheet(co, ro):
    valid, _ = validated_ratings(co, ro)
    j = _pickups(co, ro).join(valid.select("order_id", "rating"), "order_id", "left")
    return j.select("customer_id", "order_id", "runner_id", "rating", time_of_day("order_time").alias("order_time"),
                    time_of_day("pickup_time").alias("pickup_time"), F.col("secs").alias("seconds_to_pickup"), "duration",
                    F.expr(ratio_expr("distance * 60", "duration")).alias("avg_speed"),
                    F.col("items").alias("total_pizzas"))


def profit_per_order(co, ro):
    rev = _delivered_lines(co, ro).groupBy("order_id").agg(F.sum(price_of("pizza_id")).alias("rev"))
    j = rev.join(delivered(ro).select("order_id", "distance"), "order_id")
    cost = (F.col("distance") * F.lit(COST_PER_KM).cast("decimal(3,2)")).cast("decimal(38,2)")
    return j.select("order_id", F.col("rev").cast("decimal(38,2)").alias("revenue"), cost.alias("delivery_cost"),
                    (F.col("rev") - cost).cast("decimal(38,2)").alias("profit"))


def profit_total(co, ro):
    p = profit_per_order(co, ro)
    return p.agg(*[F.sum(c).cast("decimal(38,2)").alias(c) for c in ("revenue", "delivery_cost", "profit")])


def menu_extension(names, recipes, toppings):
    """Append a pizza with every topping; its id follows the largest id."""
    new_id = names.agg((F.max("pizza_id") + 1).alias("pizza_id"))
    all_tops = toppings.agg(F.array_join(F.array_sort(F.collect_list("topping_id")).cast("array<string>"),
                                         ", ")).scalar()          # the vocabulary is bounded
    names2 = names.unionByName(new_id.select("pizza_id", F.lit(NEW_PIZZA).alias("pizza_name")))
    recipes2 = recipes.unionByName(new_id.select("pizza_id", all_tops.alias("toppings")))
    return names2.join(recipes2, "pizza_id")


# ---- ingredient work per order line (D17-D19) ----------------------------------
# Names come from the topping table by one join per role (operators/lookup.py),
# so the vocabulary may have any size; D19 counts before it joins.
def _names(found) -> F.Column:
    return F.array_sort(F.filter(F.transform(found, lambda x: x["name"]), lambda n: n.isNotNull()))


def line_labels(co, names, toppings):
    lines = co.withColumns({c: F.array_distinct(c) for c in ("exclusions", "extras")})
    lines = names_by_role(lines, ["exclusions", "extras"], toppings, "topping_id", "topping_name", stage="label_lines")

    def part(word, found):
        named = _names(F.col(found))
        return F.when(F.size(named) > 0, F.concat(F.lit(f" - {word} "), F.array_join(named, ", "))).otherwise(F.lit(""))
    label = F.concat(F.col("pizza_name"), part("Exclude", "exclusions_found"), part("Extra", "extras_found"))
    return lines.join(names, "pizza_id").select("order_id", "customer_id", "pizza_id", label.alias("order_item"))


def two_roles(co, toppings):
    """Exclusions and extras of every line by name, each in its stored order; NULL where there is none."""
    lines = names_by_role(co, ["exclusions", "extras"], toppings, "topping_id", "topping_name", stage="role_lines")

    def text(found):
        return F.nullif(F.array_join(F.transform(found, lambda x: x["name"]), ", "), F.lit(""))
    return lines.select("order_id", "customer_id", "pizza_id", text("exclusions_found").alias("excluded"), text("extras_found").alias("added"))


def _recipe_arrays(recipes):
    return recipes.select("pizza_id", F.split("toppings", r",\s*").try_cast("array<int>").alias("recipe"))


def ingredient_labels(co, names, recipes, toppings):
    none = F.array().cast("array<int>")
    j = co.join(names.join(_recipe_arrays(recipes), "pizza_id"), "pizza_id")
    used = F.concat(F.array_except("recipe", F.coalesce("exclusions", none)), F.coalesce("extras", none))
    j = j.select("order_id", "customer_id", "pizza_id", "pizza_name", used.alias("used"), F.array_distinct(used).alias("kinds"))
    j = names_by_role(j, ["kinds"], toppings, "topping_id", "topping_name", stage="ingredient_lines")
    count = F.transform("kinds_found", lambda x: F.struct(x["name"].alias("name"), F.size(F.filter("used", lambda y: y == x["id"])).alias("k")))
    count = F.array_sort(F.filter(count, lambda c: c["name"].isNotNull()))
    text = F.array_join(F.transform(count, lambda c: F.when(c["k"] > 1, F.concat(c["k"].cast("string"), F.lit("x"), c["name"]))
                                    .otherwise(c["name"])), ", ")
    j = j.select("order_id", "customer_id", "pizza_id", "pizza_name", text.alias("_ing")).where("_ing <> ''")
    return j.select("order_id", "customer_id", "pizza_id", F.concat("pizza_name", F.lit(": "), "_ing").alias("ingredients"))


def ingredient_totals(co, ro, names, recipes, toppings):
    """Pizzas sold times their recipe, less the exclusions that are in it, plus the extras.

    One pass over the lines counts (pizza, topping, kind); everything after that is menu-sized.
    """
    none = F.array().cast("array<struct<pizza_id: bigint, topping_id: int, kind: string>>")

    def entries(ids, kind):
        each = F.transform(F.array_distinct(ids) if kind == "less" else F.col(ids), lambda t: F.struct(
            F.col("pizza_id").cast("bigint").alias("pizza_id"), t.alias("topping_id"), F.lit(kind).alias("kind")))
        return F.coalesce(each, none)
    sold = F.array(F.struct(F.col("pizza_id").cast("bigint").alias("pizza_id"), F.lit(None).cast("int").alias("topping_id"),
                            F.lit("sold").alias("kind")))
    parts = F.explode(F.concat(sold, entries("exclusions", "less"), entries("extras", "more")))
    counts = (_delivered_lines(co, ro).select(parts.alias("p")).select("p.*")
              .groupBy("pizza_id", "topping_id", "kind").agg(F.count(F.lit(1)).alias("n")))
    menu = recipes.select("pizza_id", F.explode(F.split("toppings", r",\s*").try_cast("array<int>")).alias("in_recipe"))
    base = counts.join(menu, "pizza_id").where("kind = 'sold' or (kind = 'less' and topping_id = in_recipe)").select(
        F.col("in_recipe").alias("topping_id"), F.when(F.col("kind") == "sold", F.col("n")).otherwise(-F.col("n")).alias("n"))
    extra = counts.where("kind = 'more'").select("topping_id", "n")
    total = base.unionByName(extra).groupBy("topping_id").agg(F.sum("n").alias("times")).where("times > 0")
    return (total.join(broadcast_if_small(toppings), "topping_id").groupBy("topping_name")
                 .agg(F.sum("times").cast("bigint").alias("times_used")))


def zipped_changes(co):
    """Exclusions and extras side by side as rows (UNNEST of two arrays; the shorter is filled with NULL)."""
    pair = F.arrays_zip(F.coalesce("exclusions", F.array().cast("array<int>")).alias("exclusion"),
                        F.coalesce("extras", F.array().cast("array<int>")).alias("extra"))
    rows = co.select("order_id", F.explode(pair).alias("z"))
    return rows.groupBy("order_id", F.col("z.exclusion").alias("exclusion"), F.col("z.extra").alias("extra")).agg(
        F.count(F.lit(1)).alias("times"))


# ---- registry -----------------------------------------------------------------
def _co(sp, d):
    return clean_customer_orders(S.dlv_customer_orders_raw(sp, d))


def _ro(sp, d):
    return clean_runner_orders(S.dlv_runner_orders_raw(sp, d))


CO = "customer_orders_raw customer_orders"
RO = "runner_orders_raw runner_orders"
BOTH = CO + " " + RO
DEL = "(SELECT * FROM customer_orders WHERE order_id IN (SELECT order_id FROM runner_orders WHERE cancellation IS NULL))"
PRICE = f"CASE WHEN pizza_id % 2 = 0 THEN {PRICE_EVEN} ELSE {PRICE_ODD} END"
ORD = """(SELECT order_id, MIN(customer_id) AS customer_id, MIN(order_time) AS order_time, COUNT(*) AS items
          FROM customer_orders GROUP BY order_id)"""
SECS = "CAST(epoch(pickup_time) - epoch(order_time) AS BIGINT)"
VIEWS["runner_order"] = """
SELECT DISTINCT r.order_id, r.runner_id, c.customer_id FROM runner_orders r
JOIN customer_orders c USING (order_id) WHERE r.cancellation IS NULL"""
VIEWS["rating_candidates"] = """
SELECT order_id, runner_id, customer_id, CAST(order_id % 5 + 1 AS INTEGER) AS rating FROM runner_order
UNION ALL SELECT order_id, runner_id, customer_id + 1, 5 FROM runner_order WHERE order_id % 50 = 0
UNION ALL SELECT order_id, runner_id, customer_id, 78 FROM runner_order WHERE order_id % 70 = 0"""
VIEWS["rating_checked"] = """
SELECT c.*, CASE WHEN r.order_id IS NULL THEN 'unknown_reference' END AS r1,
       CASE WHEN NOT (rating BETWEEN 1 AND 5) THEN 'rating_out_of_range' END AS r2
FROM rating_candidates c LEFT JOIN runner_order r USING (order_id, runner_id, customer_id)"""
VIEWS["rating_valid"] = """
SELECT order_id, runner_id, customer_id, rating FROM rating_checked WHERE r1 IS NULL AND r2 IS NULL"""
RT = BOTH + " runner_order rating_candidates rating_checked rating_valid"
VIEWS["bridge"] = """
SELECT pizza_id, CAST(unnest(string_split(toppings, ',')) AS INTEGER) AS topping_id FROM pizza_recipes"""
ING = "pizza_toppings pizza_names pizza_recipes bridge"
VIEWS["lines"] = """
SELECT order_id, customer_id, pizza_id, exclusions, extras, order_time, COUNT(*) AS n
FROM customer_orders GROUP BY ALL"""
VIEWS["line_ing"] = """
SELECT order_id, customer_id, pizza_id, exclusions, extras, order_time, n, topping_id, COUNT(*) AS k FROM (
  SELECT l.*, b.topping_id FROM lines l JOIN bridge b USING (pizza_id)
  WHERE NOT COALESCE(list_contains(l.exclusions, b.topping_id), FALSE)
  UNION ALL
  SELECT l.*, unnest(l.extras) AS topping_id FROM lines l) u
GROUP BY ALL"""


def _reg(name, fn, sql, views):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


_reg("D1_clean_customer_orders", _co, "SELECT * FROM customer_orders", CO)
_reg("D1b_clean_runner_orders", _ro, "SELECT * FROM runner_orders", RO)
_reg("D1c_cleaning_rejects", lambda sp, d: cleaning_rejects(S.dlv_runner_orders_raw(sp, d)),
     """SELECT COUNT(*) FILTER (WHERE NULLIF(NULLIF(trim(pickup_time), ''), 'null') IS NOT NULL
                                 AND TRY_CAST(pickup_time AS TIMESTAMP) IS NULL) AS pickup_time_rejects,
               COUNT(*) FILTER (WHERE NULLIF(NULLIF(trim(distance), ''), 'null') IS NOT NULL AND
                                 TRY_CAST(NULLIF(regexp_extract(distance, '[0-9]+(\\.[0-9]+)?', 0), '')
                                          AS DECIMAL(6,2)) IS NULL) AS distance_rejects,
               COUNT(*) FILTER (WHERE NULLIF(NULLIF(trim(duration), ''), 'null') IS NOT NULL AND
                                 TRY_CAST(NULLIF(regexp_extract(duration, '[0-9]+', 0), '') AS INTEGER) IS NULL)
                 AS duration_rejects,
               COUNT(*) AS rows
        FROM runner_orders_raw""", "runner_orders_raw")
_reg("D2_recipe_bridge", lambda sp, d: recipe_bridge(S.dlv_recipes(sp, d), S.dlv_toppings(sp, d)),
     "SELECT pizza_id, topping_id, topping_name FROM bridge JOIN pizza_toppings USING (topping_id)", ING)
_reg("D3_order_counts", lambda sp, d: order_counts(_co(sp, d)),
     """SELECT COUNT(*) AS pizzas_ordered, COUNT(DISTINCT customer_id) AS unique_customers,
               COUNT(DISTINCT order_id) AS unique_orders FROM customer_orders""", CO)
_reg("D4_deliveries_per_runner", lambda sp, d: deliveries_per_runner(_ro(sp, d)),
     "SELECT runner_id, COUNT(*) AS delivered FROM runner_orders WHERE cancellation IS NULL GROUP BY runner_id", RO)
_reg("D5_delivered_by_type", lambda sp, d: delivered_by_type(_co(sp, d), _ro(sp, d), S.dlv_pizza_names(sp, d)),
     f"SELECT pizza_name, COUNT(*) AS delivered FROM {DEL} c JOIN pizza_names USING (pizza_id) GROUP BY 1",
     BOTH + " pizza_names")
_reg("D5b_delivered_by_customer_type",
     lambda sp, d: delivered_by_customer_type(_co(sp, d), _ro(sp, d), S.dlv_pizza_names(sp, d)),
     f"""SELECT customer_id, pizza_name, COUNT(*) AS delivered FROM {DEL} c JOIN pizza_names USING (pizza_id)
        GROUP BY 1, 2""", BOTH + " pizza_names")
_reg("D6_largest_delivered_order", lambda sp, d: largest_order(_co(sp, d), _ro(sp, d)),
     f"""WITH c AS (SELECT order_id, COUNT(*) AS items FROM {DEL} x GROUP BY 1)
        SELECT * FROM c WHERE items = (SELECT MAX(items) FROM c)""", BOTH)
_CH = "(COALESCE(len(exclusions), 0) > 0 OR COALESCE(len(extras), 0) > 0)"
_reg("D7_changes_per_customer", lambda sp, d: changes_per_customer(_co(sp, d), _ro(sp, d)),
     f"""SELECT customer_id, COUNT(*) FILTER (WHERE {_CH}) AS changed,
               COUNT(*) FILTER (WHERE NOT {_CH}) AS unchanged FROM {DEL} x GROUP BY 1""", BOTH)
_reg("D7b_both_changed", lambda sp, d: both_changed(_co(sp, d), _ro(sp, d)),
     f"""SELECT COUNT(*) FILTER (WHERE COALESCE(len(exclusions), 0) > 0 AND COALESCE(len(extras), 0) > 0)
          AS both_changed FROM {DEL} x""", BOTH)
_reg("D8_volume_by_hour", lambda sp, d: volume_by_hour(_co(sp, d)),
     "SELECT CAST(hour(order_time) AS INTEGER) AS hour, COUNT(*) AS pizzas FROM customer_orders GROUP BY 1", CO)
_reg("D8b_volume_by_weekday", lambda sp, d: volume_by_weekday(_co(sp, d)),
     "SELECT dayname(order_time) AS weekday, COUNT(*) AS pizzas FROM customer_orders GROUP BY 1", CO)
_reg("D9_signups_per_week", lambda sp, d: signups_per_week(S.dlv_runners(sp, d)),
     """SELECT CAST(floor((registration_date - CAST(date_trunc('year', registration_date) AS DATE)) / 7) + 1
                    AS INTEGER) AS week_number, COUNT(*) AS runners FROM runners GROUP BY 1""", "runners")
_reg("D9b_signups_per_iso_week", lambda sp, d: signups_per_iso_week(S.dlv_runners(sp, d)),
     """SELECT CAST(weekofyear(registration_date) AS INTEGER) AS week, COUNT(*) AS runners_per_week
        FROM runners GROUP BY 1""", "runners")
_reg("D10_pickup_delay_per_runner", lambda sp, d: pickup_delay_per_runner(_co(sp, d), _ro(sp, d)),
     """SELECT r.runner_id, CAST(CAST(round(sum(epoch(pickup_time) - epoch(order_time)) / 60.0 / count(pickup_time)) AS BIGINT)
                                 AS VARCHAR) || ' minutes' AS avg_pickup
        FROM runner_orders r JOIN customer_orders c USING (order_id)
        WHERE r.cancellation IS NULL GROUP BY r.runner_id""", BOTH)
_reg("D11_prep_time_by_size", lambda sp, d: prep_time_by_size(_co(sp, d), _ro(sp, d)),
     f"""SELECT items, COUNT(*) AS orders,
               CAST(round(CAST(sum({SECS}) AS DOUBLE) / (60 * count({SECS})), 2) AS DECIMAL(38,2)) AS avg_prep_minutes
        FROM runner_orders r JOIN {ORD} o USING (order_id) WHERE r.cancellation IS NULL GROUP BY items""", BOTH)
_reg("D12_mean_distance_per_customer", lambda sp, d: mean_distance_per_customer(_co(sp, d), _ro(sp, d)),
     f"""SELECT customer_id, {avg_expr('distance', 2, 'duck')} AS avg_distance
        FROM runner_orders r JOIN {ORD} o USING (order_id) WHERE r.cancellation IS NULL GROUP BY 1""", BOTH)
_reg("D12b_duration_range", lambda sp, d: duration_range(_ro(sp, d)),
     "SELECT MAX(duration) - MIN(duration) AS duration_range FROM runner_orders WHERE cancellation IS NULL", RO)
_reg("D13_speed_per_delivery", lambda sp, d: speeds(_ro(sp, d)),
     f"""SELECT order_id, runner_id, distance, duration,
               {ratio_expr('distance * 60', 'duration', 2, 'duck')} AS speed_kmh
        FROM runner_orders WHERE cancellation IS NULL""", RO)
_reg("D13b_speed_per_runner", lambda sp, d: speed_per_runner(_ro(sp, d)),
     f"""SELECT runner_id, {avg_expr('speed_kmh', 2, 'duck')} AS avg_speed_kmh FROM (
          SELECT runner_id, {ratio_expr('distance * 60', 'duration', 2, 'duck')} AS speed_kmh
          FROM runner_orders WHERE cancellation IS NULL) t GROUP BY 1""", RO)
_reg("D14_success_rate", lambda sp, d: success_rate(_ro(sp, d)),
     """SELECT runner_id, ROUND(100.0 * COUNT(*) FILTER (WHERE cancellation IS NULL) / COUNT(*), 2) AS success_pct
        FROM runner_orders GROUP BY 1""", RO)
_reg("D15_ingredient_lists",
     lambda sp, d: ingredient_lists(S.dlv_recipes(sp, d), S.dlv_toppings(sp, d), S.dlv_pizza_names(sp, d)),
     """SELECT pizza_id, string_agg(topping_name, ', ' ORDER BY topping_name) AS ingredients, pizza_name
        FROM bridge JOIN pizza_toppings USING (topping_id) JOIN pizza_names USING (pizza_id)
        GROUP BY pizza_id, pizza_name""", ING)
for _col, _key, _name in (("extras", "D16_most_common_extra", "extra"),
                          ("exclusions", "D16b_most_common_exclusion", "exclusion")):
    _reg(_key, (lambda c, nm: lambda sp, d: _top_topping(_co(sp, d), c, S.dlv_toppings(sp, d), nm))(_col, _name),
         f"""WITH c AS (SELECT topping_id, COUNT(*) AS times FROM
                          (SELECT unnest({_col}) AS topping_id FROM customer_orders) u GROUP BY 1)
            SELECT topping_name AS {_name}, times FROM c JOIN pizza_toppings USING (topping_id)
            WHERE times = (SELECT MAX(times) FROM c)""", CO + " pizza_toppings")
_LBL = """(SELECT string_agg(t.topping_name, ', ' ORDER BY t.topping_name) FROM pizza_toppings t
           WHERE list_contains(l.{c}, t.topping_id))"""
_reg("D17_order_line_labels",
     lambda sp, d: line_labels(_co(sp, d), S.dlv_pizza_names(sp, d), S.dlv_toppings(sp, d)),
     f"""SELECT order_id, customer_id, pizza_id, order_item FROM (
          SELECT l.*, pizza_name || COALESCE(' - Exclude ' || {_LBL.format(c='exclusions')}, '')
                      || COALESCE(' - Extra ' || {_LBL.format(c='extras')}, '') AS order_item
          FROM lines l JOIN pizza_names USING (pizza_id)) x, range(0, CAST(n AS BIGINT)) r""",
     CO + " " + ING + " lines")
_reg("op_J5_two_role_lookup", lambda sp, d: two_roles(_co(sp, d), S.dlv_toppings(sp, d)),
     """WITH e AS (SELECT order_id, customer_id, pizza_id, exclusions, extras, n, row_number() OVER () AS r FROM lines),
             x AS (SELECT r, 'e' AS role, unnest(exclusions) AS topping_id, generate_subscripts(exclusions, 1) AS place FROM e
                   UNION ALL SELECT r, 'a', unnest(extras), generate_subscripts(extras, 1) FROM e),
             t AS (SELECT r, string_agg(topping_name, ', ' ORDER BY place) FILTER (WHERE role = 'e') AS excluded,
                          string_agg(topping_name, ', ' ORDER BY place) FILTER (WHERE role = 'a') AS added
                   FROM x JOIN pizza_toppings USING (topping_id) GROUP BY r)
        SELECT order_id, customer_id, pizza_id, excluded, added
        FROM e LEFT JOIN t USING (r), range(0, CAST(n AS BIGINT)) q""", CO + " " + ING + " lines")
_reg("D18_ingredient_labels",
     lambda sp, d: ingredient_labels(_co(sp, d), S.dlv_pizza_names(sp, d), S.dlv_recipes(sp, d),
                                     S.dlv_toppings(sp, d)),
     """SELECT order_id, customer_id, pizza_id, pizza_name || ': ' || ing AS ingredients FROM (
          SELECT order_id, customer_id, pizza_id, exclusions, extras, order_time, n,
                 string_agg(CASE WHEN k > 1 THEN CAST(k AS VARCHAR) || 'x' || topping_name ELSE topping_name END,
                            ', ' ORDER BY topping_name) AS ing
          FROM line_ing JOIN pizza_toppings USING (topping_id) GROUP BY ALL) x
        JOIN pizza_names USING (pizza_id), range(0, CAST(n AS BIGINT)) r""",
     CO + " " + ING + " lines line_ing")
_reg("D19_ingredient_totals",
     lambda sp, d: ingredient_totals(_co(sp, d), _ro(sp, d), S.dlv_pizza_names(sp, d), S.dlv_recipes(sp, d),
                                     S.dlv_toppings(sp, d)),
     """SELECT topping_name, CAST(SUM(k * n) AS BIGINT) AS times_used
        FROM line_ing JOIN pizza_toppings USING (topping_id)
        WHERE order_id IN (SELECT order_id FROM runner_orders WHERE cancellation IS NULL)
        GROUP BY topping_name""", BOTH + " " + ING + " lines line_ing")
_reg("D20_revenue", lambda sp, d: revenue(_co(sp, d), _ro(sp, d)),
     f"""SELECT CAST(SUM({PRICE}) AS BIGINT) AS revenue,
               CAST(SUM({PRICE} + {EXTRA_CHARGE} * COALESCE(len(extras), 0)) AS BIGINT) AS revenue_with_extras
        FROM {DEL} x""", BOTH)
_reg("D21_valid_ratings", lambda sp, d: validated_ratings(_co(sp, d), _ro(sp, d))[0],
     "SELECT * FROM rating_valid", RT)
_reg("D21b_rejected_ratings", lambda sp, d: validated_ratings(_co(sp, d), _ro(sp, d))[1],
     """SELECT order_id, runner_id, customer_id, rating,
               array_to_string(list_sort(list_filter([r1, r2], lambda x: x IS NOT NULL)), ', ') AS reasons
        FROM rating_checked WHERE r1 IS NOT NULL OR r2 IS NOT NULL""", RT)
_reg("D22_delivery_fact_sheet", lambda sp, d: fact_sheet(_co(sp, d), _ro(sp, d)),
     f"""SELECT o.customer_id, r.order_id, r.runner_id, v.rating, strftime(o.order_time, '%H:%M:%S') AS order_time,
               strftime(r.pickup_time, '%H:%M:%S') AS pickup_time, {SECS} AS seconds_to_pickup, r.duration,
               {ratio_expr('distance * 60', 'duration', 2, 'duck')} AS avg_speed, o.items AS total_pizzas
        FROM runner_orders r JOIN {ORD} o USING (order_id) LEFT JOIN rating_valid v USING (order_id)
        WHERE r.cancellation IS NULL""", RT)
_PROFIT = f"""(SELECT order_id, CAST(rev AS DECIMAL(38,2)) AS revenue,
                      CAST(distance * {COST_PER_KM} AS DECIMAL(38,2)) AS delivery_cost,
                      CAST(rev - CAST(distance * {COST_PER_KM} AS DECIMAL(38,2)) AS DECIMAL(38,2)) AS profit
               FROM (SELECT order_id, SUM({PRICE}) AS rev FROM {DEL} x GROUP BY 1) a
               JOIN runner_orders USING (order_id) WHERE cancellation IS NULL)"""
_reg("D23_profit_per_order", lambda sp, d: profit_per_order(_co(sp, d), _ro(sp, d)),
     f"SELECT * FROM {_PROFIT} p", BOTH)
_reg("D23b_profit_total", lambda sp, d: profit_total(_co(sp, d), _ro(sp, d)),
     f"""SELECT CAST(SUM(revenue) AS DECIMAL(38,2)) AS revenue,
               CAST(SUM(delivery_cost) AS DECIMAL(38,2)) AS delivery_cost,
               CAST(SUM(profit) AS DECIMAL(38,2)) AS profit FROM {_PROFIT} p""", BOTH)
_reg("D24_menu_extension",
     lambda sp, d: menu_extension(S.dlv_pizza_names(sp, d), S.dlv_recipes(sp, d), S.dlv_toppings(sp, d)),
     f"""WITH n AS (SELECT * FROM pizza_names UNION ALL
                    SELECT MAX(pizza_id) + 1, '{NEW_PIZZA}' FROM pizza_names),
             r AS (SELECT * FROM pizza_recipes UNION ALL
                   SELECT (SELECT MAX(pizza_id) + 1 FROM pizza_names),
                          string_agg(CAST(topping_id AS VARCHAR), ', ' ORDER BY topping_id) FROM pizza_toppings)
        SELECT pizza_id, pizza_name, toppings FROM n JOIN r USING (pizza_id)""", ING)

_reg("op_F25_zipped_changes", lambda sp, d: zipped_changes(_co(sp, d)),
     """SELECT order_id, exclusion, extra, COUNT(*) AS times FROM (
          SELECT order_id, unnest(exclusions) AS exclusion, unnest(extras) AS extra FROM customer_orders) z
        GROUP BY ALL""", CO)
_reg("op_F26_array_remove", lambda sp, d: _co(sp, d).select(
        "order_id", "pizza_id", F.array_remove("extras", 4).alias("other_extras")),
     "SELECT order_id, pizza_id, list_filter(extras, lambda x: x <> 4) AS other_extras FROM customer_orders", CO)
