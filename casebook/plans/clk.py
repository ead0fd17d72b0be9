"""Clickstream: visits, pages, product and category funnels, campaigns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.operators.range_join import join_periods
from casebook.functions.numeric import avg_expr, exact_avg, ratio_expr
from casebook.operators import first_rows, top_n
from casebook.operators.funnel import CART, CLICK, IMPRESSION, PURCHASE, VIEW, funnel, funnel_sql
from casebook.sources import subjects as S
from casebook.sources.subjects_sql import VIEWS, with_views

QUERIES: dict = {}
ORACLE: dict = {}


def users_and_cookies(users: DataFrame) -> DataFrame:
    per = users.groupBy("user_id").agg(F.count_distinct("cookie_id").alias("cookies"))
    return per.agg(F.count(F.lit(1)).alias("users"), exact_avg("cookies").alias("avg_cookies_per_user"))


def visits_per_month(ev: DataFrame) -> DataFrame:
    return ev.groupBy(F.month("event_time").alias("month_number")).agg(
        F.count_distinct("visit_id").alias("visits"))


def events_per_type(ev: DataFrame, ident: DataFrame) -> DataFrame:
    return (ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
              .join(broadcast_if_small(ident), "event_type").select("event_name", "events"))


def purchase_visit_share(ev: DataFrame) -> DataFrame:
    return ev.agg(F.count_distinct(F.when(F.col("event_type") == PURCHASE, F.col("visit_id")))
                  .alias("purchase_visits"),
                  F.count_distinct("visit_id").alias("total_visits")) \
             .withColumn("pct_purchase_visits",
                         F.round(F.lit(100.0) * F.col("purchase_visits") / F.col("total_visits"), 2))


def checkout_without_purchase(ev: DataFrame) -> DataFrame:
    checkout = ev.filter((F.col("event_type") == VIEW) & (F.col("page_id") == 12)).select("visit_id").distinct()
    buyers = ev.filter(F.col("event_type") == PURCHASE).select("visit_id")
    c = checkout.join(buyers, "visit_id", "left_anti").agg(F.count(F.lit(1)).alias("visits"))
    total = ev.agg(F.count_distinct("visit_id")).scalar()
    return c.withColumn("total_visits", total).withColumn(
        "pct_of_visits", F.round(F.lit(100.0) * F.col("visits") / F.col("total_visits"), 2))


def top_pages_by_views(ev: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    v = (ev.filter(F.col("event_type") == VIEW).groupBy("page_id").agg(F.count(F.lit(1)).alias("views"))
           .join(broadcast_if_small(pages.select("page_id", "page_name")), "page_id"))
    return top_n(v, [F.desc("views"), F.asc("page_id")], n)


def category_views_and_adds(ev: DataFrame, pages: DataFrame) -> DataFrame:
    e = ev.join(broadcast_if_small(pages), "page_id").filter(F.col("product_category").isNotNull())
    t = F.col("event_type")
    return e.groupBy("product_category").agg(F.count_if(t == VIEW).alias("views"),
                                             F.count_if(t == CART).alias("cart_adds"))


def top_products_in_purchase_visits(ev: DataFrame, pages: DataFrame, n: int = 3) -> DataFrame:
    buyers = ev.filter(F.col("event_type") == PURCHASE).select("visit_id")
    adds = (ev.filter(F.col("event_type") == CART).join(buyers, "visit_id", "left_semi")
              .join(broadcast_if_small(pages.select("page_id", "page_name")), "page_id")
              .groupBy("page_name").agg(F.count(F.lit(1)).alias("cart_adds")))
    return top_n(adds, [F.desc("cart_adds"), F.asc("page_name")], n)


def product_funnel(ev, pages):
    return funnel(ev, pages, ["product_id", "page_name"])


def category_funnel(ev, pages):
    return funnel(ev, pages, "product_category")


LEADER_METRICS = ("viewed", "added_to_cart", "purchased", "abandoned", "purchase_to_view_pct")


def funnel_leaders(ev, pages) -> DataFrame:
    f = product_funnel(ev, pages).withColumn(
        "purchase_to_view_pct", F.expr(ratio_expr("100 * purchased", "viewed")))
    long = f.unpivot(["page_name"], [F.col(m).cast("decimal(38,2)").alias(m) for m in LEADER_METRICS],
                     "metric", "value")
    return first_rows(long.filter(F.col("value").isNotNull()), "metric", "value", desc=True)


def conversion_rates(ev, pages) -> DataFrame:
    f = product_funnel(ev, pages).select(
        F.expr(ratio_expr("100 * added_to_cart", "viewed")).alias("v2c"),
        F.expr(ratio_expr("100 * purchased", "added_to_cart")).alias("c2p"))
    return f.agg(exact_avg("v2c").alias("avg_view_to_cart"), exact_avg("c2p").alias("avg_cart_to_purchase"))


def cart_products(ev: DataFrame, pages: DataFrame) -> DataFrame:
    """Cart-added product names per visit, comma separated in event order.

    Two levels, so a visit with a huge number of cart adds is not gathered in
    one task: names are joined per (visit, minute) in parallel, then each
    visit joins its minute pieces (at most 1,440 per day) in order.
    """
    c = (ev.filter(F.col("event_type") == CART)
           .join(broadcast_if_small(pages.select("page_id", "page_name")), "page_id"))
    per_minute = c.groupBy("visit_id", F.date_trunc("minute", "event_time").alias("_m")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_time", "event_id", "page_name"))),
                                 lambda x: x["page_name"]), ", ").alias("_s"))
    return per_minute.groupBy("visit_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_m", "_s"))), lambda x: x["_s"]), ", ")
        .alias("cart_products"))


def visit_summary(ev: DataFrame, pages: DataFrame, campaigns: DataFrame) -> DataFrame:
    """One row per visit; campaign by the visit start (range join by
    day); cart products in event order."""
    t = F.col("event_type")
    cnt = lambda code: F.sum(F.when(t == code, 1).otherwise(0)).cast("bigint")
    v = ev.groupBy("user_id", "visit_id").agg(
        F.min("event_time").alias("visit_start_time"),
        cnt(VIEW).alias("page_views"), cnt(CART).alias("cart_adds"),
        F.max(F.when(t == PURCHASE, 1).otherwise(0)).alias("purchase"),
        cnt(IMPRESSION).alias("impression"), cnt(CLICK).alias("click"))
    v = v.join(cart_products(ev, pages), "visit_id", "left")
    return (join_periods(v, "visit_start_time", campaigns, "start_date", "end_date")
             .select("user_id", "visit_id", "visit_start_time", "page_views", "cart_adds", "purchase",
                     "campaign_name", "impression", "click", "cart_products"))


def _imp_group(v):
    return F.when(v.impression > 0, "imp_user").otherwise("non_imp_user")


def impression_funnel(ev, pages, campaigns) -> DataFrame:
    v = visit_summary(ev, pages, campaigns)
    groups = v.select("visit_id", _imp_group(v).alias("imp_user"))
    return funnel(ev.join(groups, "visit_id"), pages, "imp_user")


def impression_click_purchase_share(ev, pages, campaigns) -> DataFrame:
    v = visit_summary(ev, pages, campaigns)
    return (v.groupBy(_imp_group(v).alias("imp_user"),
                      F.when(v.click > 0, "clicked").otherwise("not_clicked").alias("clicked"))
             .agg(F.count(F.lit(1)).alias("visits"),
                  F.round(F.lit(100.0) * F.sum("purchase") / F.count(F.lit(1)), 2).alias("purchase_pct")))


def purchase_events(ev) -> DataFrame:
    return ev.filter(F.col("event_type") == PURCHASE).select(
        "visit_id", "cookie_id", "page_id", "event_type", "event_time")


# ---- registry -----------------------------------------------------------------
def _ev(sp, d):
    return S.clk_events(sp, d)


def _pg(sp):
    return S.clk_page_hierarchy(sp)


def _reg(name, fn, sql, views="clk_events page_hierarchy"):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


VIEWS["visit_summary"] = """
SELECT v.user_id, v.visit_id, v.visit_start_time, v.page_views, v.cart_adds, v.purchase,
       c.campaign_name, v.impression, v.click, v.cart_products
FROM (SELECT user_id, visit_id, MIN(event_time) AS visit_start_time,
             CAST(SUM(CASE WHEN event_type = 1 THEN 1 ELSE 0 END) AS BIGINT) AS page_views,
             CAST(SUM(CASE WHEN event_type = 2 THEN 1 ELSE 0 END) AS BIGINT) AS cart_adds,
             MAX(CASE WHEN event_type = 3 THEN 1 ELSE 0 END) AS purchase,
             CAST(SUM(CASE WHEN event_type = 4 THEN 1 ELSE 0 END) AS BIGINT) AS impression,
             CAST(SUM(CASE WHEN event_type = 5 THEN 1 ELSE 0 END) AS BIGINT) AS click,
             string_agg(page_name, ', ' ORDER BY event_time, event_id)
               FILTER (WHERE event_type = 2) AS cart_products
      FROM clk_events JOIN page_hierarchy USING (page_id)
      GROUP BY user_id, visit_id) v
LEFT JOIN campaign_identifier c
  ON v.visit_start_time >= c.start_date AND v.visit_start_time <= c.end_date"""
VS = "clk_events page_hierarchy campaign_identifier visit_summary"

_reg("C1_users_and_cookies", lambda sp, d: users_and_cookies(S.clk_users(sp, d)),
     f"""SELECT COUNT(*) AS users, {avg_expr('cookies', 2, 'duck')} AS avg_cookies_per_user
        FROM (SELECT user_id, COUNT(DISTINCT cookie_id) AS cookies FROM clk_users GROUP BY user_id) t""",
     "clk_events clk_users")
_reg("C2_visits_per_month", lambda sp, d: visits_per_month(_ev(sp, d)),
     """SELECT CAST(month(event_time) AS INTEGER) AS month_number, COUNT(DISTINCT visit_id) AS visits
        FROM clk_events GROUP BY 1""", "clk_events")
_reg("C2b_events_per_type", lambda sp, d: events_per_type(_ev(sp, d), S.clk_event_identifier(sp)),
     """SELECT event_name, COUNT(*) AS events FROM clk_events JOIN event_identifier USING (event_type)
        GROUP BY event_name""", "clk_events event_identifier")
_reg("C3_purchase_visit_share", lambda sp, d: purchase_visit_share(_ev(sp, d)),
     """SELECT COUNT(DISTINCT CASE WHEN event_type = 3 THEN visit_id END) AS purchase_visits,
               COUNT(DISTINCT visit_id) AS total_visits,
               ROUND(100.0 * COUNT(DISTINCT CASE WHEN event_type = 3 THEN visit_id END)
                     / COUNT(DISTINCT visit_id), 2) AS pct_purchase_visits FROM clk_events""", "clk_events")
_reg("C4_checkout_without_purchase", lambda sp, d: checkout_without_purchase(_ev(sp, d)),
     """WITH c AS (SELECT COUNT(*) AS visits FROM (
                     SELECT DISTINCT visit_id FROM clk_events WHERE event_type = 1 AND page_id = 12
                     EXCEPT SELECT visit_id FROM clk_events WHERE event_type = 3) x),
             t AS (SELECT COUNT(DISTINCT visit_id) AS total_visits FROM clk_events)
        SELECT visits, total_visits, ROUND(100.0 * visits / total_visits, 2) AS pct_of_visits
        FROM c, t""", "clk_events")
_reg("C5_top_pages_by_views", lambda sp, d: top_pages_by_views(_ev(sp, d), _pg(sp)),
     """SELECT page_id, COUNT(*) AS views, page_name
        FROM clk_events JOIN page_hierarchy USING (page_id) WHERE event_type = 1
        GROUP BY page_id, page_name ORDER BY views DESC, page_id LIMIT 3""")
_reg("C6_category_views_and_adds", lambda sp, d: category_views_and_adds(_ev(sp, d), _pg(sp)),
     """SELECT product_category, COUNT(*) FILTER (WHERE event_type = 1) AS views,
               COUNT(*) FILTER (WHERE event_type = 2) AS cart_adds
        FROM clk_events JOIN page_hierarchy USING (page_id) WHERE product_category IS NOT NULL
        GROUP BY product_category""")
_reg("C7_top_products_in_purchase_visits",
     lambda sp, d: top_products_in_purchase_visits(_ev(sp, d), _pg(sp)),
     """SELECT page_name, COUNT(*) AS cart_adds
        FROM clk_events JOIN page_hierarchy USING (page_id)
        WHERE event_type = 2 AND visit_id IN (SELECT visit_id FROM clk_events WHERE event_type = 3)
        GROUP BY page_name ORDER BY cart_adds DESC, page_name LIMIT 3""")
_reg("C8_product_funnel", lambda sp, d: product_funnel(_ev(sp, d), _pg(sp)),
     funnel_sql("clk_events", ["product_id", "page_name"]))
_reg("C9_category_funnel", lambda sp, d: category_funnel(_ev(sp, d), _pg(sp)),
     funnel_sql("clk_events", "product_category"))
_FUN = funnel_sql("clk_events", ["product_id", "page_name"])
_reg("C10_funnel_leaders", lambda sp, d: funnel_leaders(_ev(sp, d), _pg(sp)),
     f"""WITH f AS ({_FUN}),
             l AS (SELECT page_name, 'viewed' AS metric, CAST(viewed AS DECIMAL(38,2)) AS value FROM f
                   UNION ALL SELECT page_name, 'added_to_cart', CAST(added_to_cart AS DECIMAL(38,2)) FROM f
                   UNION ALL SELECT page_name, 'purchased', CAST(purchased AS DECIMAL(38,2)) FROM f
                   UNION ALL SELECT page_name, 'abandoned', CAST(abandoned AS DECIMAL(38,2)) FROM f
                   UNION ALL SELECT page_name, 'purchase_to_view_pct',
                                    {ratio_expr('100 * purchased', 'viewed', 2, 'duck')} FROM f)
        SELECT page_name, metric, value FROM l
        WHERE value IS NOT NULL
          AND value = (SELECT MAX(value) FROM l l2 WHERE l2.metric = l.metric)""")
_reg("C10b_conversion_rates", lambda sp, d: conversion_rates(_ev(sp, d), _pg(sp)),
     f"""WITH f AS ({_FUN}),
             r AS (SELECT {ratio_expr('100 * added_to_cart', 'viewed', 2, 'duck')} AS v2c,
                          {ratio_expr('100 * purchased', 'added_to_cart', 2, 'duck')} AS c2p FROM f)
        SELECT {avg_expr('v2c', 2, 'duck')} AS avg_view_to_cart,
               {avg_expr('c2p', 2, 'duck')} AS avg_cart_to_purchase FROM r""")
_reg("C11_visit_summary", lambda sp, d: visit_summary(_ev(sp, d), _pg(sp), S.clk_campaigns(sp)),
     "SELECT * FROM visit_summary", VS)
_reg("C12_impression_funnel", lambda sp, d: impression_funnel(_ev(sp, d), _pg(sp), S.clk_campaigns(sp)),
     funnel_sql("""(SELECT e.*, CASE WHEN v.impression > 0 THEN 'imp_user' ELSE 'non_imp_user' END
                      AS imp_user
                    FROM clk_events e JOIN visit_summary v USING (visit_id))""", "imp_user"), VS)
_reg("C13_impression_click_purchase_share",
     lambda sp, d: impression_click_purchase_share(_ev(sp, d), _pg(sp), S.clk_campaigns(sp)),
     """SELECT CASE WHEN impression > 0 THEN 'imp_user' ELSE 'non_imp_user' END AS imp_user,
               CASE WHEN click > 0 THEN 'clicked' ELSE 'not_clicked' END AS clicked,
               COUNT(*) AS visits, ROUND(100.0 * SUM(purchase) / COUNT(*), 2) AS purchase_pct
        FROM visit_summary GROUP BY 1, 2""", VS)
_reg("C14_purchase_events", lambda sp, d: purchase_events(_ev(sp, d)),
     """SELECT visit_id, cookie_id, page_id, event_type, event_time FROM clk_events
        WHERE event_type = 3""", "clk_events")
