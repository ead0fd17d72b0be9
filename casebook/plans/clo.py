"""Clothing sales: totals, baskets, revenue splits, product hierarchy."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.functions import exact_avg
from casebook.functions.numeric import avg_expr
from casebook.operators import top_per_group, top_n, percent_of_group, with_total_share
from casebook.operators.baskets import top_triples
from casebook.operators.quantiles import percentile_disc
from casebook.operators.spread import spread
from casebook.sources import subjects as S
from casebook.sources.subjects_sql import with_views

QUERIES: dict = {}
ORACLE: dict = {}



def amounts() -> dict:
    """Gross revenue, discount amount and net revenue of a sales line (exact decimals)."""
    gross = F.col("qty") * F.col("price")
    disc = F.col("price") * F.col("qty") * F.col("discount") * F.lit(0.01).cast("decimal(3,2)")
    return {"gross": gross, "disc": disc, "net": gross - disc}


def _d2(c):
    return c.cast("decimal(38,2)")


def _d4(c):
    return c.cast("decimal(38,4)")


def with_amounts(sales: DataFrame) -> DataFrame:
    return sales.withColumns(amounts())


def qty_per_product(sales, products) -> DataFrame:
    return (sales.groupBy("prod_id").agg(F.sum("qty").alias("total_qty"))
                 .join(products.select(F.col("product_id").alias("prod_id"), "product_name"), "prod_id"))


def sales_totals(sales) -> DataFrame:
    s = with_amounts(sales)
    return s.agg(F.sum("qty").alias("total_qty"), _d2(F.sum("gross")).alias("total_revenue"),
                 _d4(F.sum("disc")).alias("total_discount"))


def per_txn(sales, tasks: int | None = None) -> DataFrame:
    """One row per transaction; its products are grouped first, so that no task holds more than its share of the lines."""
    keys = ["txn_id", "member"]
    s = (spread(with_amounts(sales), tasks, *keys, "prod_id").groupBy(*keys, "prod_id")
         .agg(F.sum("disc").alias("disc"), F.sum("net").alias("net")))
    return spread(s, tasks, *keys).groupBy(*keys).agg(
        F.count("prod_id").alias("products"),
        _d4(F.sum("disc")).alias("discount"), _d4(F.sum("net")).alias("revenue"))


def transaction_stats(sales, tasks: int | None = None) -> DataFrame:
    t = per_txn(sales, tasks)
    return t.agg(F.count(F.lit(1)).alias("unique_txn"),
                 exact_avg("products").alias("avg_unique_products"))


def revenue_percentiles(sales, tasks: int | None = None) -> DataFrame:
    return percentile_disc(per_txn(sales, tasks), "revenue", [0.25, 0.5, 0.75],
                           ["p25_revenue", "p50_revenue", "p75_revenue"])


def mean_discount_per_txn(sales, tasks: int | None = None) -> DataFrame:
    return per_txn(sales, tasks).agg(exact_avg("discount", 4).alias("avg_discount"))


def member_split(sales, tasks: int | None = None) -> DataFrame:
    t = (per_txn(sales, tasks)
         .groupBy(F.when(F.col("member"), "member").otherwise("non_member").alias("membership"))
         .agg(F.count(F.lit(1)).alias("transactions")))
    return with_total_share(t, "transactions", "pct_split")


def member_revenue(sales, tasks: int | None = None) -> DataFrame:
    return (per_txn(sales, tasks)
            .groupBy(F.when(F.col("member"), "member").otherwise("non_member").alias("membership"))
            .agg(exact_avg("revenue", 4).alias("avg_revenue")))


def top_products_by_revenue(sales, products, n: int = 3) -> DataFrame:
    r = (with_amounts(sales).groupBy("prod_id").agg(_d2(F.sum("gross")).alias("revenue"))
         .join(products.select(F.col("product_id").alias("prod_id"), "product_name"), "prod_id"))
    return top_n(r, [F.desc("revenue"), F.asc("prod_id")], n)


def _joined(sales, products):
    return with_amounts(sales).join(
        products.select(F.col("product_id").alias("prod_id"), "product_name",
                        "category_name", "segment_name"), "prod_id")


def sales_by(sales, products, by: str) -> DataFrame:
    return _joined(sales, products).groupBy(by).agg(
        F.sum("qty").alias("total_quantity"), _d4(F.sum("net")).alias("total_revenue"),
        _d4(F.sum("disc")).alias("total_discount"))


def best_product_by(sales, products, by: str) -> DataFrame:
    q = _joined(sales, products).groupBy(by, "product_name").agg(F.sum("qty").alias("sold_quant"))
    return top_per_group(q, by, [F.desc("sold_quant"), F.asc("product_name")], 1, "row_number") \
        .withColumnRenamed("product_name", "top_selling")


def revenue_share(sales, products, parent, child) -> DataFrame:
    keys = [c for c in (parent, child) if c]
    r = _joined(sales, products).groupBy(*keys).agg(_d4(F.sum("net")).alias("revenue"))
    if parent:
        return percent_of_group(r, parent, "revenue", "revenue_share")
    return with_total_share(r, "revenue", "revenue_share")


def penetration(sales, products, tasks: int | None = None) -> DataFrame:
    total = spread(sales.select("txn_id"), tasks, "txn_id").distinct().agg(F.count("txn_id")).scalar()
    pairs = spread(sales.select("prod_id", "txn_id"), tasks, "prod_id", "txn_id").distinct()
    per = pairs.groupBy("prod_id").agg(F.count("txn_id").alias("txns"))
    return (per.withColumn("penetration", F.round(F.lit(100.0) * F.col("txns") / total, 2))
               .join(products.select(F.col("product_id").alias("prod_id"), "product_name"), "prod_id"))


def top_combination(sales, products, tasks: int | None = None) -> DataFrame:
    s = sales.join(products.select(F.col("product_id").alias("prod_id"), "product_name"), "prod_id")
    return top_triples(s, "txn_id", "product_name", tasks=tasks)


def product_details_from_hierarchy(hierarchy: DataFrame, prices: DataFrame) -> DataFrame:
    h = hierarchy.select("id", "parent_id", "level_text")
    st, sg, ct = h.alias("st"), h.alias("sg"), h.alias("ct")
    j = (prices.alias("x").join(st, F.col("x.id") == F.col("st.id"))
               .join(sg, F.col("st.parent_id") == F.col("sg.id"))
               .join(ct, F.col("sg.parent_id") == F.col("ct.id")))
    return j.select(
        F.col("x.product_id").alias("product_id"), F.col("x.price").alias("price"),
        F.concat_ws("", F.col("st.level_text"), F.lit(" "), F.col("sg.level_text"), F.lit(" - "),
                    F.col("ct.level_text")).alias("product_name"),
        F.col("ct.id").alias("category_id"), F.col("sg.id").alias("segment_id"),
        F.col("st.id").alias("style_id"), F.col("ct.level_text").alias("category_name"),
        F.col("sg.level_text").alias("segment_name"), F.col("st.level_text").alias("style_name"))


# ---- registry -----------------------------------------------------------------
def _reg(name, fn, sql, views="clo_sales product_details"):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


def _sp(sp, d):
    return S.clo_sales(sp, d), S.clo_products(sp, d)


def _st(sp, d):
    return S.clo_sales(sp, d), S.clo_tasks(sp, d)


def _spt(sp, d):
    return *_sp(sp, d), S.clo_tasks(sp, d)


G, D = "qty * price", "price * qty * discount * 0.01"
N = f"({G} - {D})"
PER_TXN = f"""(SELECT txn_id, member, COUNT(DISTINCT prod_id) AS products,
                      CAST(SUM({D}) AS DECIMAL(38,4)) AS discount,
                      CAST(SUM({N}) AS DECIMAL(38,4)) AS revenue
               FROM clo_sales GROUP BY txn_id, member)"""
JOINED = """clo_sales s JOIN (SELECT product_id, product_name, category_name, segment_name
                              FROM product_details) p ON s.prod_id = p.product_id"""
MEMB = "CASE WHEN member THEN 'member' ELSE 'non_member' END"

_reg("L1_qty_per_product", lambda sp, d: qty_per_product(*_sp(sp, d)),
     """SELECT prod_id, product_name, CAST(SUM(qty) AS BIGINT) AS total_qty
        FROM clo_sales s JOIN product_details p ON s.prod_id = p.product_id
        GROUP BY prod_id, product_name""")
_reg("L1b_sales_totals", lambda sp, d: sales_totals(S.clo_sales(sp, d)),
     f"""SELECT CAST(SUM(qty) AS BIGINT) AS total_qty, CAST(SUM({G}) AS DECIMAL(38,2)) AS total_revenue,
               CAST(SUM({D}) AS DECIMAL(38,4)) AS total_discount FROM clo_sales""", "clo_sales")
_reg("L2_transaction_stats", lambda sp, d: transaction_stats(*_st(sp, d)),
     f"""SELECT COUNT(*) AS unique_txn, {avg_expr('products', 2, 'duck')} AS avg_unique_products
        FROM {PER_TXN} t""", "clo_sales")
_reg("L3_revenue_percentiles", lambda sp, d: revenue_percentiles(*_st(sp, d)),
     f"""WITH t AS (SELECT revenue, CUME_DIST() OVER (ORDER BY revenue) AS cd FROM {PER_TXN} x)
        SELECT MIN(CASE WHEN cd >= 0.25 THEN revenue END) AS p25_revenue,
               MIN(CASE WHEN cd >= 0.5 THEN revenue END) AS p50_revenue,
               MIN(CASE WHEN cd >= 0.75 THEN revenue END) AS p75_revenue FROM t""", "clo_sales")
_reg("L4_mean_discount_per_txn", lambda sp, d: mean_discount_per_txn(*_st(sp, d)),
     f"SELECT {avg_expr('discount', 4, 'duck')} AS avg_discount FROM {PER_TXN} t", "clo_sales")
_reg("L5_member_split", lambda sp, d: member_split(*_st(sp, d)),
     f"""SELECT membership, transactions,
               ROUND(100.0 * transactions / SUM(transactions) OVER (), 2) AS pct_split
        FROM (SELECT {MEMB} AS membership, COUNT(*) AS transactions FROM {PER_TXN} t
              GROUP BY 1) x""", "clo_sales")
_reg("L5b_member_revenue", lambda sp, d: member_revenue(*_st(sp, d)),
     f"""SELECT {MEMB} AS membership, {avg_expr('revenue', 4, 'duck')} AS avg_revenue
        FROM {PER_TXN} t GROUP BY 1""", "clo_sales")
_reg("L6_top_products_by_revenue", lambda sp, d: top_products_by_revenue(*_sp(sp, d)),
     f"""SELECT prod_id, CAST(SUM({G}) AS DECIMAL(38,2)) AS revenue, product_name
        FROM {JOINED}
        GROUP BY prod_id, product_name ORDER BY revenue DESC, prod_id LIMIT 3""")
for _by, _key in (("segment_name", "L7_sales_by_segment"), ("category_name", "L7b_sales_by_category")):
    _reg(_key, (lambda b: lambda sp, d: sales_by(*_sp(sp, d), b))(_by),
         f"""SELECT {_by}, CAST(SUM(qty) AS BIGINT) AS total_quantity,
                   CAST(SUM({N}) AS DECIMAL(38,4)) AS total_revenue,
                   CAST(SUM({D}) AS DECIMAL(38,4)) AS total_discount
            FROM {JOINED} GROUP BY {_by}""")
for _by, _key in (("segment_name", "L8_best_product_by_segment"),
                  ("category_name", "L8b_best_product_by_category")):
    _reg(_key, (lambda b: lambda sp, d: best_product_by(*_sp(sp, d), b))(_by),
         f"""SELECT {_by}, product_name AS top_selling, sold_quant FROM (
              SELECT {_by}, product_name, CAST(SUM(qty) AS BIGINT) AS sold_quant,
                     ROW_NUMBER() OVER (PARTITION BY {_by}
                                        ORDER BY SUM(qty) DESC, product_name) AS rn
              FROM {JOINED} GROUP BY {_by}, product_name) t WHERE rn = 1""")
for _parent, _child, _key in (("segment_name", "product_name", "L9_product_share_in_segment"),
                              ("category_name", "segment_name", "L9b_segment_share_in_category"),
                              (None, "category_name", "L9c_category_share")):
    _keys = ", ".join(c for c in (_parent, _child) if c)
    _over = f"PARTITION BY {_parent}" if _parent else ""
    _reg(_key, (lambda p, c: lambda sp, d: revenue_share(*_sp(sp, d), p, c))(_parent, _child),
         f"""SELECT {_keys}, revenue,
                   ROUND(100.0 * CAST(revenue AS DOUBLE)
                         / CAST(SUM(revenue) OVER ({_over}) AS DOUBLE), 2) AS revenue_share
            FROM (SELECT {_keys}, CAST(SUM({N}) AS DECIMAL(38,4)) AS revenue
                  FROM {JOINED} GROUP BY {_keys}) t""")
_reg("L10_product_penetration", lambda sp, d: penetration(*_spt(sp, d)),
     """SELECT prod_id, product_name, COUNT(DISTINCT txn_id) AS txns,
               ROUND(100.0 * COUNT(DISTINCT txn_id)
                     / (SELECT COUNT(DISTINCT txn_id) FROM clo_sales), 2) AS penetration
        FROM clo_sales s JOIN product_details p ON s.prod_id = p.product_id
        GROUP BY prod_id, product_name""")
_reg("L11_top_3_item_combination", lambda sp, d: top_combination(*_spt(sp, d)),
     """WITH bi AS (SELECT DISTINCT txn_id, product_name AS item
                    FROM clo_sales s JOIN product_details p ON s.prod_id = p.product_id),
             c AS (SELECT a.item AS product_1, b.item AS product_2, c.item AS product_3,
                          COUNT(*) AS buying_freq
                   FROM bi a JOIN bi b ON a.txn_id = b.txn_id AND a.item < b.item
                   JOIN bi c ON a.txn_id = c.txn_id AND b.item < c.item
                   GROUP BY 1, 2, 3)
        SELECT * FROM c WHERE buying_freq = (SELECT MAX(buying_freq) FROM c)""")
_reg("L12_product_details_from_hierarchy",
     lambda sp, d: product_details_from_hierarchy(S.clo_hierarchy(sp, d), S.clo_prices(sp, d)),
     """SELECT x.product_id, x.price,
               CONCAT(st.level_text, ' ', sg.level_text, ' - ', ct.level_text) AS product_name,
               ct.id AS category_id, sg.id AS segment_id, st.id AS style_id,
               ct.level_text AS category_name, sg.level_text AS segment_name,
               st.level_text AS style_name
        FROM product_prices x JOIN product_hierarchy st ON x.id = st.id
        JOIN product_hierarchy sg ON st.parent_id = sg.id
        JOIN product_hierarchy ct ON sg.parent_id = ct.id""", "product_hierarchy product_prices")
