"""Operator-level entries for inventory ids that no analysis names directly."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F, types as T

from casebook.operators.broadcast import broadcast_if_small
from casebook.operators.hierarchy import ancestors
from casebook.operators.neighbours import over_all
from casebook.operators.rowid import global_row_number
from casebook.operators.sample import bottom_k
from casebook.sources import subjects as S
from casebook.sources.tables import table
from casebook.sources.subjects_sql import with_views

QUERIES: dict = {}
ORACLE: dict = {}

ORDERS_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])


def typed_scan(sp, d):
    """A table read with a declared schema (not inferred)."""
    return sp.read.schema(ORDERS_SCHEMA).parquet(f"{d}/orders.parquet")


def namespaced_scan(sp, d):
    """S3: a table addressed through a catalog namespace."""
    table(sp, d, "nation").createOrReplaceGlobalTempView("casebook_nation")
    return sp.table("global_temp.casebook_nation")


def hierarchy_paths(sp, d):
    """Recursive expansion of the product hierarchy."""
    return ancestors(S.clo_hierarchy(sp, d).select("id", "parent_id"))


def _reg(name, fn, sql, views=()):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views) if views else sql


_reg("op_S1_typed_scan", typed_scan, "SELECT * FROM orders")
_reg("op_S2_full_scan", lambda sp, d: table(sp, d, "customer"), "SELECT * FROM customer")
_reg("op_S3_namespaced_scan", namespaced_scan, "SELECT * FROM nation")
_reg("op_P1_projection", lambda sp, d: table(sp, d, "customer", "c_custkey", "c_name"),
     "SELECT c_custkey, c_name FROM customer")
_reg("op_P2_computed_alias",
     lambda sp, d: table(sp, d, "lineitem", "l_orderkey", "l_extendedprice", "l_discount").select(
         "l_orderkey", (F.col("l_extendedprice").cast("decimal(18,2)")
                        * (1 - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(38,4)").alias("net_price")),
     "SELECT l_orderkey, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) "
     "AS DECIMAL(38,4)) AS net_price FROM lineitem")
_reg("op_P4_literal_column",
     lambda sp, d: table(sp, d, "orders", "o_orderkey").withColumn("source", F.lit("orders")),
     "SELECT o_orderkey, 'orders' AS source FROM orders")
_reg("op_P8_in_list",
     lambda sp, d: table(sp, d, "orders", "o_orderkey", "o_orderpriority").filter(
         F.col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~F.col("o_orderkey").isin(0, 1, 2)),
     "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') "
     "AND o_orderkey NOT IN (0, 1, 2)")


def status_share(sp, d):
    """A scalar subquery in the projection."""
    o = table(sp, d, "orders", "o_orderstatus")
    g = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    total = o.agg(F.count(F.lit(1))).scalar()
    return g.select("o_orderstatus", "orders", F.round(F.lit(100.0) * F.col("orders") / total, 2).alias("pct"))


_reg("op_P16_scalar_subquery_share", status_share,
     "SELECT o_orderstatus, COUNT(*) AS orders, ROUND(100.0 * COUNT(*) / (SELECT COUNT(*) FROM orders), 2) AS pct "
     "FROM orders GROUP BY o_orderstatus")


def nation_spend(sp, d):
    """Chained derived tables (customer spend -> nation totals)."""
    o = table(sp, d, "orders", "o_custkey", "o_totalprice")
    c = table(sp, d, "customer", "c_custkey", "c_nationkey")
    n = table(sp, d, "nation", "n_nationkey", "n_name")
    spend = o.groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spend"))
    cust = spend.join(c, spend.o_custkey == c.c_custkey)
    return (cust.groupBy("c_nationkey").agg(F.sum("spend").cast("decimal(38,2)").alias("spend"),
                                            F.count(F.lit(1)).alias("customers"))
                .join(broadcast_if_small(n), F.col("c_nationkey") == F.col("n_nationkey"))
                .select("n_name", "customers", "spend"))


_reg("op_P21_chained_ctes", nation_spend,
     """WITH spend AS (SELECT o_custkey, SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS spend FROM orders GROUP BY 1),
             cust AS (SELECT c_nationkey, spend FROM spend JOIN customer ON o_custkey = c_custkey),
             nat AS (SELECT c_nationkey, CAST(SUM(spend) AS DECIMAL(38,2)) AS spend, COUNT(*) AS customers
                     FROM cust GROUP BY 1)
        SELECT n_name, customers, spend FROM nat JOIN nation ON c_nationkey = n_nationkey""")


def cast_key_join(sp, d):
    """Join on a key stored as text in one table (retyped, then joined)."""
    m = S.seg_interest_metrics(sp, d)
    imap = S.seg_interest_map(sp, d)
    return (m.join(imap, m.interest_id.try_cast("int") == imap.id)
             .groupBy("interest_name").agg(F.count(F.lit(1)).alias("months")))


_reg("op_J15_cast_key_join", cast_key_join,
     """SELECT interest_name, COUNT(*) AS months FROM interest_metrics m
        JOIN interest_map im ON TRY_CAST(m.interest_id AS INTEGER) = im.id GROUP BY interest_name""",
     "interest_ids interest_map interest_metrics")
_reg("op_O2_descending_sort",
     lambda sp, d: table(sp, d, "customer", "c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey"),
     "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
_reg("op_U5_hierarchy_paths", hierarchy_paths,
     """WITH RECURSIVE p(id, ancestor_id, depth) AS (
          SELECT id, parent_id, 1 FROM product_hierarchy WHERE parent_id IS NOT NULL
          UNION ALL
          SELECT p.id, h.parent_id, p.depth + 1 FROM p JOIN product_hierarchy h ON p.ancestor_id = h.id
          WHERE h.parent_id IS NOT NULL)
        SELECT id, ancestor_id, depth FROM p""", "product_hierarchy")
_reg("op_F20_floor_buckets",
     lambda sp, d: table(sp, d, "lineitem", "l_extendedprice").groupBy(
         (F.floor(F.col("l_extendedprice") / 10000) * 10000).cast("bigint").alias("price_bucket"))
     .agg(F.count(F.lit(1)).alias("lines")),
     "SELECT CAST(floor(l_extendedprice / 10000) * 10000 AS BIGINT) AS price_bucket, COUNT(*) AS lines "
     "FROM lineitem GROUP BY 1")
_reg("op_W3_global_row_id",
     lambda sp, d: global_row_number(table(sp, d, "orders", "o_orderkey", "o_custkey"), "o_orderkey"),
     "SELECT o_orderkey, o_custkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS row_id FROM orders")

_reg("op_F22_least", lambda sp, d: table(sp, d, "orders", "o_orderkey", "o_orderdate").select(
        "o_orderkey", F.least(F.to_date("o_orderdate"), F.lit("1996-01-01").cast("date")).alias("capped_date")),
     "SELECT o_orderkey, least(CAST(o_orderdate AS DATE), DATE '1996-01-01') AS capped_date FROM orders")
_reg("op_U2_union_distinct", lambda sp, d: table(sp, d, "customer").select(F.col("c_nationkey").alias("nation")).union(
        table(sp, d, "supplier").select("s_nationkey")).distinct(),
     "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier")


# ---- samples (O7) ---------------------------------------------------------------
_reg("op_O7_row_sample", lambda sp, d: bottom_k(table(sp, d, "orders", "o_orderkey", "o_custkey"), "o_orderkey", 100, seed=7),
     "SELECT o_orderkey, o_custkey, md5(concat_ws('|', '7', o_orderkey)) AS draw FROM orders ORDER BY draw LIMIT 100")
_reg("op_O7b_sample_per_stratum",
     lambda sp, d: bottom_k(table(sp, d, "customer", "c_custkey", "c_nationkey"), "c_custkey", 5, by="c_nationkey").drop("draw"),
     """SELECT c_custkey, c_nationkey FROM customer
        QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY md5(concat_ws('|', '0', c_custkey))) <= 5""")


# ---- correlated subqueries (P17, P19, O6) ---------------------------------------
def customer_orders_summary(sp, d):
    """Correlated scalar subqueries. A count over no rows is 0, any other aggregate NULL."""
    c = table(sp, d, "customer", "c_custkey")
    o = table(sp, d, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    own = o.where(F.col("o_custkey") == F.col("c_custkey").outer())
    return c.select("c_custkey", own.select(F.count(F.lit(1))).scalar().alias("orders"),
                    own.select(F.max("o_orderdate")).scalar().alias("last_order"),
                    own.select(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(38,2)")).scalar().alias("spend"))


def _sold(sp, d, brand="p_brand"):
    li = table(sp, d, "lineitem", "l_partkey", "l_extendedprice")
    p = table(sp, d, "part", "p_partkey", "p_brand", "p_type").withColumnRenamed("p_brand", brand)
    j = li.join(p, li.l_partkey == p.p_partkey)
    return j.groupBy(brand, "p_type").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(38,2)").alias("revenue"))


def share_in_group(sp, d):
    """P17 over an aggregate: the brand's total beside each type's revenue, by a correlated subquery.

    The inner query calls the brand by another name from its scan on: Spark looks for the
    outer name in the inner query first, hidden columns included.
    """
    inner = _sold(sp, d, "brand")
    total = inner.where(F.col("brand") == F.col("p_brand").outer()).select(F.sum("revenue").cast("decimal(38,2)")).scalar()
    return _sold(sp, d).select("p_brand", "p_type", "revenue", total.alias("brand_revenue"))


def first_per_key(sp, d):
    """DISTINCT ON by a lateral subquery: each nation's richest customer, ties to the smallest key."""
    n = table(sp, d, "nation", "n_nationkey", "n_name")
    c = table(sp, d, "customer", "c_custkey", "c_nationkey", "c_acctbal")
    best = c.where(F.col("c_nationkey") == F.col("n_nationkey").outer()).orderBy(F.desc("c_acctbal"), "c_custkey").limit(1)
    return n.lateralJoin(best.select("c_custkey", "c_acctbal"), how="left").select("n_name", "c_custkey", "c_acctbal")


def last_orders(sp, d):
    """The three latest orders of every customer that has any, by a lateral subquery."""
    c = table(sp, d, "customer", "c_custkey")
    o = table(sp, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    last = o.where(F.col("o_custkey") == F.col("c_custkey").outer()).orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(3)
    return c.lateralJoin(last.select("o_orderkey", "o_orderdate"))


_reg("op_P17_correlated_scalar", customer_orders_summary,
     """SELECT c_custkey, (SELECT COUNT(*) FROM orders WHERE o_custkey = c_custkey) AS orders,
               (SELECT MAX(o_orderdate) FROM orders WHERE o_custkey = c_custkey) AS last_order,
               (SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) FROM orders WHERE o_custkey = c_custkey) AS spend
        FROM customer""")
_reg("op_P17b_correlated_group_total", share_in_group,
     """WITH s AS (SELECT p_brand, p_type, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS revenue
                   FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
        SELECT p_brand, p_type, CAST(revenue AS DECIMAL(38,2)) AS revenue,
               CAST((SELECT SUM(revenue) FROM s i WHERE i.p_brand = s.p_brand) AS DECIMAL(38,2)) AS brand_revenue FROM s""")
_reg("op_P19_lateral_first", first_per_key,
     """SELECT n_name, c_custkey, c_acctbal FROM nation LEFT JOIN (
          SELECT * FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1) c
        ON c_nationkey = n_nationkey""")
_reg("op_O6_lateral_top3", last_orders,
     """SELECT c_custkey, o_orderkey, o_orderdate FROM customer JOIN (
          SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) <= 3) o
        ON o_custkey = c_custkey""")


# ---- windows over a whole result (W7, W9, W10, W15) ------------------------------
def daily_orders(sp, d):
    """LAG by 1 and 2, a 3-row mean and the day after, over all days; no partition, no single task."""
    o = table(sp, d, "orders", "o_orderdate").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return over_all(o, "day", {
        "previous": lambda w: F.lag("orders", 1).over(w), "before_previous": lambda w: F.lag("orders", 2).over(w),
        "sum_3": lambda w: F.sum("orders").over(w.rowsBetween(-2, 0)), "next_day": lambda w: F.lead("day", 1).over(w)}, back=2, ahead=1, stage="daily_orders")


def first_and_last_value(sp, d):
    """LAST_VALUE under the default frame (up to the row and its peers) and under the whole partition."""
    s = S.sub_subscriptions(sp, d)
    w = W.partitionBy("customer_id").orderBy("start_date")
    whole = w.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return s.select("customer_id", "plan_id", "start_date", F.first("start_date").over(w).alias("first_date"),
                    F.last("start_date").over(w).alias("last_so_far"), F.last("start_date").over(whole).alias("last_date"))


_reg("op_W10_whole_result_lag", daily_orders,
     """SELECT *, LAG(orders, 1) OVER (ORDER BY day) AS previous, LAG(orders, 2) OVER (ORDER BY day) AS before_previous,
               CAST(SUM(orders) OVER (ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS BIGINT) AS sum_3, LEAD(day) OVER (ORDER BY day) AS next_day
        FROM (SELECT CAST(o_orderdate AS DATE) AS day, COUNT(*) AS orders FROM orders GROUP BY 1) o""")
_reg("op_W7_last_value", first_and_last_value,
     """SELECT customer_id, plan_id, start_date, FIRST_VALUE(start_date) OVER w AS first_date, LAST_VALUE(start_date) OVER w AS last_so_far,
               LAST_VALUE(start_date) OVER (PARTITION BY customer_id ORDER BY start_date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_date
        FROM subscriptions WINDOW w AS (PARTITION BY customer_id ORDER BY start_date)""", "subscriptions")
