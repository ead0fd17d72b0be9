"""Monthly sales report (U1): one parameter, one scan, three sections.

``monthly_report(sales, products, month=None)`` returns the sections as
DataFrames. With ``month`` ("yyyy-MM") the scan is filtered to that month
(a range predicate pushed into the reader); without it every month is
reported at once, grouped by month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.functions.numeric import avg_expr, exact_avg
from casebook.operators import top_per_group
from casebook.operators.spread import spread
from casebook.plans.clo import amounts
from casebook.sources import subjects as S
from casebook.sources.subjects_sql import with_views

QUERIES: dict = {}
ORACLE: dict = {}


def _scope(sales: DataFrame, month: str | None) -> DataFrame:
    s = sales.withColumn("month", F.trunc("txn_date", "month"))
    if month:
        start = F.lit(f"{month}-01").cast("date")
        s = s.filter((F.col("txn_date") >= start) & (F.col("txn_date") < F.add_months(start, 1)))
    return s.withColumns(amounts())


def monthly_report(sales: DataFrame, products: DataFrame, month: str | None = None, tasks: int | None = None) -> dict:
    s = _scope(sales, month)
    high = s.groupBy("month").agg(F.sum("qty").alias("total_qty"),
                                  F.sum("gross").cast("decimal(38,2)").alias("gross_revenue"),
                                  F.sum("disc").cast("decimal(38,4)").alias("total_discount"))
    keys = ["month", "txn_id", "member"]
    lines = spread(s, tasks, *keys, "prod_id").groupBy(*keys, "prod_id").agg(F.sum("disc").alias("disc"))
    t = spread(lines, tasks, *keys).groupBy(*keys).agg(F.count("prod_id").alias("products"),
                                                       F.sum("disc").cast("decimal(38,4)").alias("discount"))
    txn = t.groupBy("month").agg(
        F.count(F.lit(1)).alias("unique_txn"), exact_avg("products").alias("avg_unique_products"),
        exact_avg("discount", 4).alias("avg_discount"),
        F.round(F.lit(100.0) * F.count_if(F.col("member")) / F.count(F.lit(1)), 2).alias("member_pct"))
    p = (s.groupBy("month", "prod_id").agg(F.sum("gross").cast("decimal(38,2)").alias("revenue"))
          .join(products.select(F.col("product_id").alias("prod_id"), "product_name"), "prod_id"))
    top = top_per_group(p, "month", [F.desc("revenue"), F.asc("prod_id")], 3, "row_number", out="rank")
    return {"high_level": high, "transactions": txn,
            "top_products": top.withColumn("rank", F.col("rank").cast("int"))}


def _r(sp, d, section):
    return monthly_report(S.clo_sales(sp, d), S.clo_products(sp, d), tasks=S.clo_tasks(sp, d))[section]


G, D = "qty * price", "price * qty * discount * 0.01"
M = "CAST(date_trunc('month', txn_date) AS DATE)"
V = "clo_sales product_details"
QUERIES["L13_U1_report_high_level"] = lambda sp, d: _r(sp, d, "high_level")
ORACLE["L13_U1_report_high_level"] = with_views(
    f"""SELECT {M} AS month, CAST(SUM(qty) AS BIGINT) AS total_qty, CAST(SUM({G}) AS DECIMAL(38,2)) AS gross_revenue,
               CAST(SUM({D}) AS DECIMAL(38,4)) AS total_discount FROM clo_sales GROUP BY 1""", V)
QUERIES["L13b_U1_report_transactions"] = lambda sp, d: _r(sp, d, "transactions")
ORACLE["L13b_U1_report_transactions"] = with_views(
    f"""SELECT month, COUNT(*) AS unique_txn, {avg_expr('products', 2, 'duck')} AS avg_unique_products,
               {avg_expr('discount', 4, 'duck')} AS avg_discount,
               ROUND(100.0 * COUNT(*) FILTER (WHERE member) / COUNT(*), 2) AS member_pct
        FROM (SELECT {M} AS month, txn_id, member, COUNT(DISTINCT prod_id) AS products,
                     CAST(SUM({D}) AS DECIMAL(38,4)) AS discount FROM clo_sales GROUP BY 1, 2, 3) t
        GROUP BY month""", V)
QUERIES["L13c_U1_report_top_products"] = lambda sp, d: _r(sp, d, "top_products")
ORACLE["L13c_U1_report_top_products"] = with_views(
    f"""SELECT month, prod_id, revenue, product_name, CAST(rank AS INTEGER) AS rank FROM (
          SELECT {M} AS month, prod_id, CAST(SUM({G}) AS DECIMAL(38,2)) AS revenue, product_name,
                 ROW_NUMBER() OVER (PARTITION BY {M} ORDER BY SUM({G}) DESC, prod_id) AS rank
          FROM clo_sales s JOIN (SELECT product_id, product_name FROM product_details) p
            ON s.prod_id = p.product_id GROUP BY 1, 2, 4) t WHERE rank <= 3""", V)
