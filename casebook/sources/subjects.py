"""Subject tables of the eight analysis areas, derived from the stored tables.

Each builder takes ``(spark, sf_dir)`` and returns DataFrames with the
columns and types the analyses use. The mapping from stored tables is fixed
(see README, "Data mapping"); the SQL twins used by the oracle live in
``casebook.sources.subjects_sql`` and must stay in step with these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from casebook.operators.broadcast import broadcast_if_small
from casebook.operators.ranking import rank_by
from casebook.operators.rowid import global_row_number
from casebook.operators.spread import tasks_for
from casebook.sources.io import materialize, materialize_once
from casebook.sources.tables import table

# ---- fixed values of the mapping -------------------------------------------
MEMBER_EPOCH = "1997-01-01"      # join_date = epoch + (custkey % 365) days
OPEN_END = "9999-12-31"          # end date of the open node row
TXN_TYPES = {"F": "deposit", "O": "purchase", "P": "withdrawal"}


def _d(c: str):
    return F.to_date(F.col(c))


def literal_table(spark: SparkSession, rows, ddl: str) -> DataFrame:
    """A small fixed table (code list) as an inline plan.

    Unlike ``createDataFrame`` rows, an inline table carries a size estimate,
    so the optimizer (and ``broadcast_if_small``) knows it is tiny.
    """
    schema = T._parse_datatype_string(ddl)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)])
               for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


# ---- retail loyalty (RET) ---------------------------------------------------
def ret_sales(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(F.col("o_custkey").alias("customer_id"),
                      _d("o_orderdate").alias("order_date"),
                      F.col("l_partkey").alias("product_id")))


def ret_menu(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part", "p_partkey", "p_name", "p_retailprice").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"))


def ret_members(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer", "c_custkey")
    return (c.filter(F.col("c_custkey") % 2 == 0)
             .select(F.col("c_custkey").alias("customer_id"),
                     F.date_add(F.lit(MEMBER_EPOCH).cast("date"),
                                (F.col("c_custkey") % 365).cast("int")).alias("join_date")))


# ---- bank (BNK) -------------------------------------------------------------
def bnk_regions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region", "r_regionkey", "r_name").select(
        F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region_name"))


def customer_region(spark: SparkSession, d: str) -> DataFrame:
    """customer -> region id; nation (25 rows by definition) is broadcast."""
    c = table(spark, d, "customer", "c_custkey", "c_nationkey")
    n = table(spark, d, "nation", "n_nationkey", "n_regionkey")
    return (c.join(broadcast_if_small(n), c.c_nationkey == n.n_nationkey)
             .select(F.col("c_custkey").alias("customer_id"),
                     F.col("n_regionkey").alias("region_id")))


def bnk_transactions(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    ttype = _mapped(F.col("o_orderstatus"), TXN_TYPES)
    return o.select(F.col("o_custkey").alias("customer_id"),
                    _d("o_orderdate").alias("txn_date"),
                    ttype.alias("txn_type"),
                    F.col("o_totalprice").cast("decimal(18,2)").alias("txn_amount"))


def bnk_nodes(spark: SparkSession, d: str) -> DataFrame:
    """One node row per (customer, order day); it ends at the next order day.

    The window runs over distinct (customer, day) keys, whose count per
    customer is bounded by the calendar.
    """
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    days = (o.groupBy(F.col("o_custkey").alias("customer_id"),
                      _d("o_orderdate").alias("start_date"))
             .agg(F.min("o_orderkey").alias("_k")))
    w = W.partitionBy("customer_id").orderBy("start_date")
    nodes = days.select(
        "customer_id",
        ((F.col("_k") % 5) + 1).cast("int").alias("node_id"),
        "start_date",
        F.coalesce(F.lead("start_date").over(w), F.lit(OPEN_END).cast("date")).alias("end_date"))
    return (nodes.join(customer_region(spark, d), "customer_id")
                 .select("customer_id", "region_id", "node_id", "start_date", "end_date"))


# ---- clothing sales (CLO) ---------------------------------------------------
def clo_sales(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_discount")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    p = table(spark, d, "part", "p_partkey", "p_retailprice")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .join(p, li.l_partkey == p.p_partkey)
              .select(F.col("l_partkey").alias("prod_id"),
                      F.col("l_quantity").cast("int").alias("qty"),
                      F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
                      F.round(F.col("l_discount") * 100).cast("int").alias("discount"),
                      (F.col("o_custkey") % 2 == 0).alias("member"),
                      F.col("l_orderkey").alias("txn_id"),
                      _d("o_orderdate").alias("txn_date")))


def clo_tasks(spark: SparkSession, d: str) -> int:
    """Tasks for aggregations with a group per sales line or transaction (counted from the files' footers)."""
    return tasks_for(spark, table(spark, d, "lineitem").count())


def clo_products(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_brand").alias("category_name"), F.col("p_type").alias("segment_name"),
                    F.col("p_retailprice").cast("decimal(18,2)").alias("price"))


def clo_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """Three levels: region (category) > nation (segment) > customer (style)."""
    r = table(spark, d, "region", "r_regionkey", "r_name")
    n = table(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    big = lambda x, k: (F.col(x).cast("bigint") * 3 + k)
    return (r.select(big("r_regionkey", 0).alias("id"), F.lit(None).cast("bigint").alias("parent_id"),
                     F.col("r_name").alias("level_text"), F.lit("Category").alias("level_name"))
             .unionByName(n.select(big("n_nationkey", 1).alias("id"), big("n_regionkey", 0).alias("parent_id"),
                                   F.col("n_name").alias("level_text"), F.lit("Segment").alias("level_name")))
             .unionByName(c.select(big("c_custkey", 2).alias("id"), big("c_nationkey", 1).alias("parent_id"),
                                   F.col("c_name").alias("level_text"), F.lit("Style").alias("level_name"))))


def clo_prices(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer", "c_custkey", "c_acctbal")
    return c.select((F.col("c_custkey") * 3 + 2).alias("id"),
                    F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("product_id"),
                    F.col("c_acctbal").cast("decimal(18,2)").alias("price"))


# ---- weekly sales (WKS) -----------------------------------------------------
# Fixed values of the mapping: order priority digit -> segment code,
# market segment -> customer type, order status -> platform.
SEGMENT_OF_PRIORITY = {"1": "C1", "2": "F2", "3": "C3", "4": "F4", "5": "null"}
CUSTOMER_TYPE = {"AUTOMOBILE": "New", "BUILDING": "New", "HOUSEHOLD": "Existing",
                 "MACHINERY": "Existing", "FURNITURE": "Guest"}


def _mapped(col, mapping):
    out = F.lit(None).cast("string")
    for k, v in reversed(list(mapping.items())):
        out = F.when(col == k, v).otherwise(out)
    return out


def wks_weekly_sales(spark: SparkSession, d: str) -> DataFrame:
    """Raw weekly sales: week_date as 'd/M/yyyy' text, segment with 'null' text."""
    o = table(spark, d, "orders", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority")
    c = table(spark, d, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, d, "nation", "n_nationkey", "n_regionkey")
    r = table(spark, d, "region", "r_regionkey", "r_name")
    geo = n.join(r, n.n_regionkey == r.r_regionkey)            # 25 rows by definition
    j = (o.join(c, o.o_custkey == c.c_custkey)
          .join(broadcast_if_small(geo), F.col("c_nationkey") == F.col("n_nationkey")))
    week = F.to_date(F.date_trunc("week", F.col("o_orderdate")))
    g = j.groupBy(
        F.concat_ws("/", F.dayofmonth(week).cast("string"), F.month(week).cast("string"),
                    F.year(week).cast("string")).alias("week_date"),                  # d/M/yyyy
        F.col("r_name").alias("region"),
        F.when(F.col("o_orderstatus") == "P", "Shopify").otherwise("Retail").alias("platform"),
        _mapped(F.substring("o_orderpriority", 1, 1), SEGMENT_OF_PRIORITY).alias("segment"),
        _mapped(F.col("c_mktsegment"), CUSTOMER_TYPE).alias("customer_type"))
    return g.agg(F.count(F.lit(1)).alias("transactions"),
                 F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("sales"))


# ---- clickstream (CLK) ------------------------------------------------------
# Event codes and names of the clickstream, stored event type
# -> event code, and three campaign periods inside the January of the data.
EVENT_NAMES = [(1, "Page View"), (2, "Add to Cart"), (3, "Purchase"), (4, "Ad Impression"),
               (5, "Ad Click")]
EVENT_CODE = {"view": 1, "click": 2, "purchase": 3, "signup": 4, "error": 5}
CAMPAIGNS = [("Campaign A", "2024-01-01 00:00:00", "2024-01-09 23:59:59"),
             ("Campaign B", "2024-01-10 00:00:00", "2024-01-19 23:59:59"),
             ("Campaign C", "2024-01-20 00:00:00", "2024-01-27 23:59:59")]
N_PAGES = 13          # 1 home, 2 all products, 3..11 products, 12 checkout, 13 confirmation


def clk_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events", "event_id", "ts", "user_id", "event_type")
    code = _mapped(F.col("event_type"), {k: str(v) for k, v in EVENT_CODE.items()}).cast("int")
    day = F.regexp_replace(F.to_date("ts").cast("string"), "-", "")      # yyyyMMdd, no time-zone step
    visit = F.concat(F.col("user_id").cast("string"), F.lit("-"), day)
    cookie = F.concat(F.col("user_id").cast("string"), F.lit("-"), F.weekofyear("ts").cast("string"))
    ev = e.select(visit.alias("visit_id"), cookie.alias("cookie_id"), F.col("user_id"),
                  (F.col("event_id") % N_PAGES + 1).cast("int").alias("page_id"),
                  code.alias("event_type"), F.col("ts").alias("event_time"), "event_id")
    # sequence within a visit; pruned away by Catalyst when a query does not read it
    w = W.partitionBy("visit_id").orderBy("event_time", "event_id")
    return ev.withColumn("sequence_number", F.row_number().over(w))


def clk_users(spark: SparkSession, d: str) -> DataFrame:
    return clk_events(spark, d).select("user_id", "cookie_id").distinct()


def clk_event_identifier(spark: SparkSession) -> DataFrame:
    return literal_table(spark, EVENT_NAMES, "event_type int, event_name string")


def clk_page_hierarchy(spark: SparkSession) -> DataFrame:
    p = F.col("page_id")
    name = (F.when(p == 1, "Home Page").when(p == 2, "All Products").when(p == 12, "Checkout")
             .when(p == 13, "Confirmation").otherwise(F.concat(F.lit("Product "), (p - 2).cast("string"))))
    is_product = p.between(3, 11)
    cat = F.when(is_product, F.concat(F.lit("Category "), (F.floor((p - 3) / 3) + 1).cast("string")))
    return (spark.range(1, N_PAGES + 1).select(F.col("id").cast("int").alias("page_id"))
                 .select("page_id", name.alias("page_name"), cat.alias("product_category"),
                         F.when(is_product, p - 2).alias("product_id")))


def clk_campaigns(spark: SparkSession) -> DataFrame:
    return (literal_table(spark, CAMPAIGNS, "campaign_name string, s string, e string")
                 .select("campaign_name", F.to_timestamp_ntz("s").alias("start_date"),
                         F.to_timestamp_ntz("e").alias("end_date")))


# ---- interest segments (SEG) ------------------------------------------------
INTEREST_EPOCH = "1996-01-01"    # created_at = epoch + (id % 1500) days


SHORT_LIVED_UNTIL = "1992-06-01"   # interests with id % 23 = 5 have no month from here on


def _interest_ids(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part", "p_partkey", "p_name")
    return p.groupBy(F.col("p_name").alias("interest_name")).agg(F.min("p_partkey").cast("int").alias("id"))


def seg_interest_map(spark: SparkSession, d: str) -> DataFrame:
    """Interests by id. Some that have metrics are missing (id % 97 = 0), some here have none (retired)."""
    ids = _interest_ids(spark, d)
    retired = ids.where("id % 89 = 0").select(F.concat("interest_name", F.lit(" (retired)")).alias("interest_name"),
                                              (F.col("id") + 1000000).alias("id"))
    m = ids.where("id % 97 <> 0").unionByName(retired)
    created = F.date_add(F.lit(INTEREST_EPOCH).cast("date"), (F.col("id") % 1500)).cast("timestamp_ntz")
    return m.select("id", "interest_name",
                    F.concat(F.lit("Parts named "), F.col("interest_name")).alias("interest_summary"),
                    created.alias("created_at"),
                    F.date_add(created.cast("date"), 30).cast("timestamp_ntz").alias("last_modified"))


def seg_interest_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Raw monthly metrics per interest (part name), text-typed like a CSV load.

    composition = share of the month's shipped quantity (%); index_value =
    composition over the month's mean composition; ranking by index_value.
    Month totals are aggregates joined back (a row per calendar month). Some
    rows have 'NULL' texts instead of a month, some interests stop early.
    """
    li = table(spark, d, "lineitem", "l_partkey", "l_quantity", "l_shipdate")
    p = table(spark, d, "part", "p_partkey", "p_name")
    a = (li.join(p, li.l_partkey == p.p_partkey)
           .groupBy(F.trunc(F.to_date("l_shipdate"), "month").alias("m"), "p_name")
           .agg(F.sum("l_quantity").alias("qty")))
    a = materialize(a, "interest_months")
    month = a.groupBy("m").agg(F.sum("qty").alias("tq"), F.count(F.lit(1)).alias("n"))
    b = a.join(broadcast_if_small(month), "m").withColumn("composition", F.round(F.lit(100.0) * F.col("qty") / F.col("tq"), 2))
    cd = F.col("composition").cast("decimal(10,2)")
    c = b.join(broadcast_if_small(b.groupBy("m").agg(F.sum(cd).alias("tc"))), "m").withColumn("index_value", F.round(
        (cd * F.col("n")).cast("double") / F.col("tc").cast("double"), 2))
    c = rank_by(c, "m", "index_value", "ranking", desc=True)
    c = c.withColumn("percentile_ranking", F.round(F.lit(100.0) * (F.col("n") - F.col("ranking") + 1) / F.col("n"), 2))
    ids = _interest_ids(spark, d).select(F.col("interest_name").alias("p_name"), "id")
    j = c.join(ids, "p_name").where(~((F.col("id") % 23 == 5) & (F.col("m") >= F.lit(SHORT_LIVED_UNTIL).cast("date"))))
    lost = (F.col("id") + F.month("m")) % 50 == 0
    text = lambda x: F.when(lost, F.lit("NULL")).otherwise(x)
    return j.select(
        text(F.month("m").cast("string")).alias("_month"), text(F.year("m").cast("string")).alias("_year"),
        text(F.concat(F.lpad(F.month("m").cast("string"), 2, "0"), F.lit("-"), F.year("m").cast("string")))
        .alias("month_year"), F.col("id").cast("string").alias("interest_id"),
        "composition", "index_value", "ranking", "percentile_ranking")


# ---- subscriptions (SUB) ----------------------------------------------------
# The plan catalogue (price NULL for churn) and the stored event
# type that marks each plan's start.
PLANS = [(0, "trial", "0.00"), (1, "basic monthly", "9.90"), (2, "pro monthly", "19.90"),
         (3, "pro annual", "199.00"), (4, "churn", None)]
PLAN_OF_EVENT = {"view": 0, "click": 1, "signup": 2, "purchase": 3, "error": 4}


def sub_plans(spark: SparkSession) -> DataFrame:
    return (literal_table(spark, PLANS, "plan_id int, plan_name string, p string")
                 .select("plan_id", "plan_name", F.col("p").cast("decimal(5,2)").alias("price")))


def sub_subscriptions(spark: SparkSession, d: str) -> DataFrame:
    """One row per (customer, plan): the plan starts on the first day its event occurs."""
    e = table(spark, d, "events", "user_id", "event_type", "ts")
    plan = _mapped(F.col("event_type"), {k: str(v) for k, v in PLAN_OF_EVENT.items()}).cast("int")
    return (e.groupBy(F.col("user_id").alias("customer_id"), plan.alias("plan_id"))
             .agg(F.to_date(F.min("ts")).alias("start_date")))


def sub_order_subscriptions(spark: SparkSession, d: str) -> DataFrame:
    """Subscriptions over the seven years of orders: a plan (by order priority) starts with its first order."""
    o = table(spark, d, "orders", "o_custkey", "o_orderpriority", "o_orderdate")
    plan = (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("plan_id")
    return (o.groupBy(F.col("o_custkey").alias("customer_id"), plan)
             .agg(F.to_date(F.min("o_orderdate")).alias("start_date")))


# ---- food delivery (DLV) ----------------------------------------------------
REG_EPOCH = "1995-01-01"         # runner registration = epoch + (suppkey % 28) days


def dlv_runners(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier", "s_suppkey")
    return s.select(F.col("s_suppkey").alias("runner_id"),
                    F.date_add(F.lit(REG_EPOCH).cast("date"), (F.col("s_suppkey") % 28).cast("int"))
                     .alias("registration_date"))


def dlv_toppings(spark: SparkSession, d: str) -> DataFrame:
    """Toppings = words of part names; ids by alphabetical order, numbered across partitions."""
    def build():
        p = table(spark, d, "part", "p_name")
        words = p.select(F.explode(F.split("p_name", " ")).alias("topping_name")).distinct()
        numbered = global_row_number(words, "topping_name", "topping_id", stage="topping_numbers")
        return numbered.select(F.col("topping_id").cast("int").alias("topping_id"), "topping_name")
    return materialize_once(spark, "toppings", d, build)


def dlv_pizza_names(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part", "p_partkey", "p_name")
    return p.select(F.col("p_partkey").alias("pizza_id"), F.col("p_name").alias("pizza_name"))


def dlv_recipes(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part", "p_partkey", "p_name")
    w = p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("topping_name"))
    j = w.join(broadcast_if_small(dlv_toppings(spark, d)), "topping_name")   # bounded vocabulary
    return (j.groupBy(F.col("p_partkey").alias("pizza_id"))
             .agg(F.array_join(F.array_sort(F.collect_list("topping_id")).cast("array<string>"), ", ")
                  .alias("toppings")))


def _order_time():
    return F.expr("timestampadd(MINUTE, (o_orderkey % 24) * 60 + o_orderkey % 60, o_orderdate)")


def dlv_customer_orders_raw(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o = table(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    ln, s = F.col("l_linenumber"), F.col("l_suppkey")
    t1 = ((s % 16) + 1).cast("string")
    t2 = (((s + 5) % 16) + 1).cast("string")
    excl = (F.when(ln % 4 == 0, F.lit("")).when(ln % 4 == 1, F.lit("null"))
             .when(ln % 4 == 2, ((F.col("l_partkey") % 16) + 1).cast("string")))
    extras = (F.when(ln % 3 == 0, F.concat(t1, F.lit(", "), t2)).when(ln % 3 == 1, t1)
               .when(F.col("l_orderkey") % 2 == 0, F.lit("")))
    return j.select(F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    F.col("l_partkey").alias("pizza_id"), excl.alias("exclusions"), extras.alias("extras"),
                    _order_time().alias("order_time"))


def dlv_runner_orders_raw(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders", "o_orderkey", "o_orderstatus", "o_orderdate")
    li = table(spark, d, "lineitem", "l_orderkey", "l_suppkey")
    runner = li.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("runner_id"))
    j = o.join(runner, o.o_orderkey == runner.l_orderkey)
    k = F.col("o_orderkey")
    cancelled = F.col("o_orderstatus") == "P"
    dist = ((k % 25) + 1).cast("string")
    mins = ((k % 30) + 10).cast("string")
    # TIMESTAMP_NTZ -> text without a time-zone step ('yyyy-MM-dd HH:mm:ss')
    pickup = F.expr("timestampadd(SECOND, (10 + o_orderkey % 20) * 60 + o_orderkey * 7 % 60, "
                    "timestampadd(MINUTE, (o_orderkey % 24) * 60 + o_orderkey % 60, o_orderdate))").cast("string")
    return j.select(
        F.col("o_orderkey").alias("order_id"), "runner_id",
        F.when(cancelled, F.lit("null")).when(k % 227 == 0, F.lit("late")).otherwise(pickup).alias("pickup_time"),
        F.when(cancelled, F.lit("null")).when(k % 211 == 0, F.lit("unknown")).when(k % 4 == 0, F.concat(dist, F.lit("km")))
         .when(k % 4 == 1, F.concat(dist, F.lit(".4 km"))).when(k % 4 == 2, dist)
         .otherwise(F.concat(dist, F.lit(" km"))).alias("distance"),
        F.when(cancelled, F.lit("null")).when(k % 223 == 0, F.lit("soon")).when(k % 3 == 0, F.concat(mins, F.lit("mins")))
         .when(k % 3 == 1, F.concat(mins, F.lit(" minute"))).otherwise(F.concat(mins, F.lit(" minutes")))
         .alias("duration"),
        F.when(cancelled, F.when(k % 2 == 0, F.lit("Restaurant Cancellation"))
                           .otherwise(F.lit("Customer Cancellation")))
         .when(k % 3 == 0, F.lit("")).when(k % 3 == 1, F.lit("null")).alias("cancellation"))
