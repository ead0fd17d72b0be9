"""Retail loyalty: spend, visits, first/favourite items, points, member ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.operators import first_rows, dense_rank_by
from casebook.sources import subjects as S
from casebook.sources.subjects_sql import with_views

# Fixed parameters of the analyses (mapped onto the stored data).
BONUS_ITEM = "small ring"        # the item with the 2x points multiplier
POINTS_CUTOFF = "1998-01-31"     # "end of January" after the joining year

QUERIES: dict = {}
ORACLE: dict = {}


def _money(c):
    return c.cast("decimal(38,2)")


def spend_per_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return (sales.join(menu, "product_id")
                 .groupBy("customer_id")
                 .agg(_money(F.sum("price")).alias("total_spent")))


def visit_days(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(
        F.count_distinct("order_date").alias("visit_count"))


def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    s = sales.join(menu, "product_id")
    return first_rows(s, "customer_id", "order_date").select(
        "customer_id", "product_name").distinct()


def item_counts(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return (sales.join(menu, "product_id").groupBy("product_name")
                 .agg(F.count(F.lit(1)).alias("times_purchased")))


def most_purchased_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    return first_rows(item_counts(sales, menu), [], "times_purchased", desc=True)


def most_purchased_item_by_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    top = most_purchased_item(sales, menu).select("product_name")
    return (sales.join(menu, "product_id").join(top, "product_name", "left_semi")
                 .groupBy("customer_id", "product_name")
                 .agg(F.count(F.lit(1)).alias("purchase_count")))


def favourite_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    c = (sales.join(menu, "product_id").groupBy("customer_id", "product_name")
              .agg(F.count(F.lit(1)).alias("purchase_count")))
    return first_rows(c, "customer_id", "purchase_count", desc=True)


def _member_sales(sales, members, menu):
    return sales.join(members, "customer_id").join(menu, "product_id")


def first_item_as_member(sales, members, menu) -> DataFrame:
    s = _member_sales(sales, members, menu).filter(F.col("order_date") >= F.col("join_date"))
    return first_rows(s, "customer_id", "order_date").select(
        "customer_id", "order_date", "product_name")


def last_item_before_member(sales, members, menu) -> DataFrame:
    s = _member_sales(sales, members, menu).filter(F.col("order_date") < F.col("join_date"))
    return first_rows(s, "customer_id", "order_date", desc=True).select(
        "customer_id", "order_date", "product_name")


def before_joining_totals(sales, members, menu) -> DataFrame:
    s = _member_sales(sales, members, menu).filter(F.col("order_date") < F.col("join_date"))
    return s.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_items"),
        _money(F.sum("price")).alias("amount_spent"))


def points(sales, menu, bonus_item: str = BONUS_ITEM) -> DataFrame:
    s = sales.join(menu, "product_id")
    mult = F.when(F.col("product_name") == bonus_item, 20).otherwise(10)
    return s.groupBy("customer_id").agg(_money(F.sum(F.col("price") * mult)).alias("points"))


def points_first_week(sales, members, menu, bonus_item: str = BONUS_ITEM,
                      cutoff: str = POINTS_CUTOFF) -> DataFrame:
    s = (_member_sales(sales, members, menu)
         .filter((F.col("order_date") >= F.col("join_date"))
                 & (F.col("order_date") <= F.lit(cutoff).cast("date"))))
    first_week = F.col("order_date") <= F.date_add("join_date", 6)
    mult = (F.when(first_week, 20).when(F.col("product_name") == bonus_item, 20)
             .otherwise(10))
    return s.groupBy("customer_id").agg(_money(F.sum(F.col("price") * mult)).alias("points"))


def enriched_sales(sales, members, menu) -> DataFrame:
    s = sales.join(menu, "product_id").join(members, "customer_id", "left")
    member = F.when(F.col("join_date").isNotNull() & (F.col("order_date") >= F.col("join_date")),
                    "Y").otherwise("N")
    return s.select("customer_id", "order_date", "product_name", "price", member.alias("member"))


def member_ranking(sales, members, menu) -> DataFrame:
    e = enriched_sales(sales, members, menu)
    keys = e.filter(F.col("member") == "Y").select("customer_id", "order_date").distinct()
    ranked = dense_rank_by(keys, "customer_id", "order_date", out="ranking")
    return (e.join(ranked, ["customer_id", "order_date"], "left")
             .withColumn("ranking", F.col("ranking").cast("bigint")))


# ---- registry -----------------------------------------------------------------
def _t(spark, d):
    return S.ret_sales(spark, d), S.ret_menu(spark, d), S.ret_members(spark, d)


def _reg(name, fn, sql, views="sales menu members"):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


_reg("R1_spend_per_customer",
     lambda sp, d: spend_per_customer(*_t(sp, d)[:2]),
     """SELECT customer_id, CAST(SUM(price) AS DECIMAL(38,2)) AS total_spent
        FROM sales JOIN menu USING (product_id) GROUP BY customer_id""", "sales menu")

_reg("R2_visit_days",
     lambda sp, d: visit_days(S.ret_sales(sp, d)),
     """SELECT customer_id, COUNT(DISTINCT order_date) AS visit_count
        FROM sales GROUP BY customer_id""", "sales")

_reg("R3_first_items",
     lambda sp, d: first_items(*_t(sp, d)[:2]),
     """SELECT DISTINCT customer_id, product_name FROM (
          SELECT customer_id, product_name,
                 RANK() OVER (PARTITION BY customer_id ORDER BY order_date) AS rnk
          FROM sales JOIN menu USING (product_id)) t WHERE rnk = 1""", "sales menu")

_reg("R4_most_purchased_item",
     lambda sp, d: most_purchased_item(*_t(sp, d)[:2]),
     """WITH c AS (SELECT product_name, COUNT(*) AS times_purchased
                   FROM sales JOIN menu USING (product_id) GROUP BY product_name)
        SELECT * FROM c WHERE times_purchased = (SELECT MAX(times_purchased) FROM c)""",
     "sales menu")

_reg("R4b_most_purchased_item_by_customer",
     lambda sp, d: most_purchased_item_by_customer(*_t(sp, d)[:2]),
     """WITH c AS (SELECT product_name, COUNT(*) AS n
                   FROM sales JOIN menu USING (product_id) GROUP BY product_name),
             top AS (SELECT product_name FROM c WHERE n = (SELECT MAX(n) FROM c))
        SELECT customer_id, product_name, COUNT(*) AS purchase_count
        FROM sales JOIN menu USING (product_id) JOIN top USING (product_name)
        GROUP BY customer_id, product_name""", "sales menu")

_reg("R5_favourite_item",
     lambda sp, d: favourite_items(*_t(sp, d)[:2]),
     """SELECT customer_id, product_name, purchase_count FROM (
          SELECT customer_id, product_name, COUNT(*) AS purchase_count,
                 RANK() OVER (PARTITION BY customer_id ORDER BY COUNT(*) DESC) AS rnk
          FROM sales JOIN menu USING (product_id)
          GROUP BY customer_id, product_name) t WHERE rnk = 1""", "sales menu")

_reg("R6_first_item_as_member",
     lambda sp, d: first_item_as_member(*_t(sp, d)[:1], *_t(sp, d)[2:], _t(sp, d)[1]),
     """SELECT customer_id, order_date, product_name FROM (
          SELECT customer_id, order_date, product_name,
                 RANK() OVER (PARTITION BY customer_id ORDER BY order_date) AS rnk
          FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
          WHERE order_date >= join_date) t WHERE rnk = 1""")

_reg("R7_last_item_before_member",
     lambda sp, d: last_item_before_member(S.ret_sales(sp, d), S.ret_members(sp, d), S.ret_menu(sp, d)),
     """SELECT customer_id, order_date, product_name FROM (
          SELECT customer_id, order_date, product_name,
                 RANK() OVER (PARTITION BY customer_id ORDER BY order_date DESC) AS rnk
          FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
          WHERE order_date < join_date) t WHERE rnk = 1""")

_reg("R8_before_joining_totals",
     lambda sp, d: before_joining_totals(S.ret_sales(sp, d), S.ret_members(sp, d), S.ret_menu(sp, d)),
     """SELECT customer_id, COUNT(*) AS total_items,
               CAST(SUM(price) AS DECIMAL(38,2)) AS amount_spent
        FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
        WHERE order_date < join_date GROUP BY customer_id""")

_reg("R9_points",
     lambda sp, d: points(S.ret_sales(sp, d), S.ret_menu(sp, d)),
     f"""SELECT customer_id,
               CAST(SUM(CASE WHEN product_name = '{BONUS_ITEM}' THEN price * 20
                             ELSE price * 10 END) AS DECIMAL(38,2)) AS points
        FROM sales JOIN menu USING (product_id) GROUP BY customer_id""", "sales menu")

_reg("R10_points_first_week",
     lambda sp, d: points_first_week(S.ret_sales(sp, d), S.ret_members(sp, d), S.ret_menu(sp, d)),
     f"""SELECT customer_id,
               CAST(SUM(CASE WHEN order_date <= join_date + 6 THEN price * 20
                             WHEN product_name = '{BONUS_ITEM}' THEN price * 20
                             ELSE price * 10 END) AS DECIMAL(38,2)) AS points
        FROM sales JOIN members USING (customer_id) JOIN menu USING (product_id)
        WHERE order_date >= join_date AND order_date <= DATE '{POINTS_CUTOFF}'
        GROUP BY customer_id""")

_reg("R11_enriched_sales",
     lambda sp, d: enriched_sales(S.ret_sales(sp, d), S.ret_members(sp, d), S.ret_menu(sp, d)),
     """SELECT customer_id, order_date, product_name, price,
               CASE WHEN join_date IS NOT NULL AND order_date >= join_date THEN 'Y'
                    ELSE 'N' END AS member
        FROM sales JOIN menu USING (product_id) LEFT JOIN members USING (customer_id)""")

_reg("R12_member_ranking",
     lambda sp, d: member_ranking(S.ret_sales(sp, d), S.ret_members(sp, d), S.ret_menu(sp, d)),
     """WITH e AS (
          SELECT customer_id, order_date, product_name, price,
                 CASE WHEN join_date IS NOT NULL AND order_date >= join_date THEN 'Y'
                      ELSE 'N' END AS member
          FROM sales JOIN menu USING (product_id) LEFT JOIN members USING (customer_id))
        SELECT *, CASE WHEN member = 'Y' THEN
                    DENSE_RANK() OVER (PARTITION BY customer_id, member ORDER BY order_date)
                  END AS ranking
        FROM e""")
