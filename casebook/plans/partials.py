"""Jobs over stored partials and text files: additive distinct counts (A2, A3, A25), the
monthly report from partials (U1), file reading with rejects (S1), recursion with state (U5)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from casebook.operators.distinct import distinct_counts, distinct_partials, merge_partials
from casebook.plans.clo import amounts
from casebook.sources import catalog as C, subjects as S
from casebook.sources.io import materialize, stage_path
from casebook.sources.subjects_sql import with_views
from casebook.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}


def _reg(name, fn, sql, views=()):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views) if views else sql


# ---- additive distinct counts (A2, A3, A25) ---------------------------------------
def shipped_per_period(sp, d):
    """Distinct parts and suppliers per month, year and over all, from one set of monthly bitmaps."""
    li = table(sp, d, "lineitem", "l_shipdate", "l_partkey", "l_suppkey").select(F.trunc("l_shipdate", "month").alias("start"), "l_partkey", "l_suppkey")
    months = materialize(distinct_partials(li, "start", {"parts": "l_partkey", "suppliers": "l_suppkey"}), "shipped_bitmaps")
    grains = {"month": months, "year": merge_partials(months, [F.trunc("start", "year").alias("start")]),
              "all": merge_partials(months, [F.lit(None).cast("date").alias("start")])}
    out = None
    for grain, p in grains.items():
        one = distinct_counts(p, "start", ["parts", "suppliers"]).select(F.lit(grain).alias("grain"), "start", "parts", "suppliers")
        out = one if out is None else out.unionAll(one)
    return out


_reg("op_A3_distinct_rollup", shipped_per_period,
     """WITH l AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS m, CAST(date_trunc('year', l_shipdate) AS DATE) AS y, l_partkey, l_suppkey FROM lineitem)
        SELECT 'month' AS grain, m AS start, COUNT(DISTINCT l_partkey) AS parts, COUNT(DISTINCT l_suppkey) AS suppliers FROM l GROUP BY m
        UNION ALL SELECT 'year', y, COUNT(DISTINCT l_partkey), COUNT(DISTINCT l_suppkey) FROM l GROUP BY y
        UNION ALL SELECT 'all', NULL, COUNT(DISTINCT l_partkey), COUNT(DISTINCT l_suppkey) FROM l""")


# ---- monthly report from stored partials (U1) --------------------------------------
SUMS, BITMAPS = "report_month_sums", "report_month_products"


def _month_sums(sales: DataFrame) -> DataFrame:
    s = sales.withColumn("month", F.trunc("txn_date", "month")).withColumns(amounts())
    return s.groupBy("month").agg(F.sum("qty").alias("total_qty"), F.sum("gross").cast("decimal(38,2)").alias("gross_revenue"),
                                  F.sum("disc").cast("decimal(38,4)").alias("total_discount"), F.count(F.lit(1)).alias("lines"))


def _month_products(sales: DataFrame) -> DataFrame:
    return distinct_partials(sales.withColumn("month", F.trunc("txn_date", "month")), "month", {"products": "prod_id"})


def build_partials(sales: DataFrame) -> None:
    """Writes the partial aggregates of every month, one partition a month."""
    C.replace_table(_month_sums(sales).repartition("month"), SUMS, "month")
    C.replace_table(_month_products(sales).repartition("month"), BITMAPS, "month")


def refresh_month(sales: DataFrame, month: str) -> None:
    """Rebuilds the partials of one month ("yyyy-MM"), after late or corrected rows; other months' files stay."""
    spark, start = sales.sparkSession, F.lit(f"{month}-01").cast("date")
    rows = sales.where((F.col("txn_date") >= start) & (F.col("txn_date") < F.add_months(start, 1)))
    C.replace_partitions(_month_sums(rows), SUMS)
    C.replace_partitions(_month_products(rows), BITMAPS)
    spark.catalog.refreshTable(C.full_name(spark, SUMS))
    spark.catalog.refreshTable(C.full_name(spark, BITMAPS))


def report(spark: SparkSession, grain: str) -> DataFrame:
    """The report per ``grain`` (month, quarter, year) from the partials alone: sums add up, bitmaps merge."""
    period = F.trunc("month", grain).alias("period")
    sums = spark.table(C.full_name(spark, SUMS)).groupBy(period).agg(
        F.sum("total_qty").cast("long").alias("total_qty"), F.sum("gross_revenue").cast("decimal(38,2)").alias("gross_revenue"),
        F.sum("total_discount").cast("decimal(38,4)").alias("total_discount"), F.sum("lines").cast("long").alias("lines"))
    products = distinct_counts(merge_partials(spark.table(C.full_name(spark, BITMAPS)), [period]), "period", ["products"])
    return sums.join(products, "period")


def report_per_year(sp, d):
    build_partials(S.clo_sales(sp, d))
    return report(sp, "year")


_reg("op_U1_report_from_partials", report_per_year,
     """SELECT CAST(date_trunc('year', txn_date) AS DATE) AS period, CAST(SUM(qty) AS BIGINT) AS total_qty,
               CAST(SUM(qty * price) AS DECIMAL(38,2)) AS gross_revenue, CAST(SUM(price * qty * discount * 0.01) AS DECIMAL(38,4)) AS total_discount,
               COUNT(*) AS lines, COUNT(DISTINCT prod_id) AS products
        FROM clo_sales GROUP BY 1""", "clo_sales")


# ---- files with rejects (S1) --------------------------------------------------------
BAD_ROW = "_bad_row"


def read_csv_with_rejects(spark: SparkSession, path: str, schema: str, **options) -> tuple[DataFrame, DataFrame]:
    """(typed rows, rejected lines as text): lines that do not fit the declared schema fail neither the job nor other lines.

    The files are parsed once; what was parsed is staged and both results read the stage.
    """
    reader = spark.read.schema(f"{schema}, {BAD_ROW} string").options(mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_ROW, **options)
    parsed = materialize(reader.csv(path), "parsed_files")
    return parsed.where(F.col(BAD_ROW).isNull()).drop(BAD_ROW), parsed.where(F.col(BAD_ROW).isNotNull()).select(F.col(BAD_ROW).alias("line"))


def _order_files(sp, d) -> str:
    """Orders as CSV files; the price of every 97th is no number, the date of every 89th no date, every 83rd lacks its end."""
    o = table(sp, d, "orders", "o_orderkey", "o_orderpriority", "o_orderdate")
    k, price = F.col("o_orderkey"), (F.col("o_orderkey") % 1000).cast("string")
    line = F.concat_ws(",", k.cast("string"), F.when(k % 97 == 0, F.lit("n/a")).otherwise(price), "o_orderpriority",
                       F.when(k % 89 == 0, F.lit("soon")).otherwise(F.to_date("o_orderdate").cast("string")))
    path = stage_path(sp, "order_files")
    o.select(F.when(k % 83 == 0, F.substring_index(line, ",", 2)).otherwise(line).alias("value")).write.text(path)
    return path


ORDER_COLS = "o_orderkey long, units int, o_orderpriority string, day date"
_reg("op_S1b_csv_typed_rows", lambda sp, d: read_csv_with_rejects(sp, _order_files(sp, d), ORDER_COLS)[0],
     """SELECT o_orderkey, CAST(o_orderkey % 1000 AS INTEGER) AS units, o_orderpriority, CAST(o_orderdate AS DATE) AS day FROM orders
        WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 83 <> 0""")
_reg("op_S1c_csv_rejects", lambda sp, d: read_csv_with_rejects(sp, _order_files(sp, d), ORDER_COLS)[1],
     """SELECT CASE WHEN o_orderkey % 83 = 0 THEN head ELSE head || ',' || o_orderpriority || ',' || CASE WHEN o_orderkey % 89 = 0 THEN 'soon'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END END AS line
        FROM (SELECT *, CAST(o_orderkey AS VARCHAR) || ',' || CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 1000 AS VARCHAR) END AS head
              FROM orders) o WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0 OR o_orderkey % 83 = 0""")


# ---- recursion that carries state (U5) ----------------------------------------------
def hierarchy_paths(edges: DataFrame) -> DataFrame:
    """``(id, path, depth)`` of every node by Spark's recursive CTE: base, step and stop.

    The path from the root is carried along, which doubling (``ancestors``) cannot give.
    A node is left where its path already holds it, so cycles end.
    """
    view = f"edges_{uuid.uuid4().hex}"
    edges.select("id", "parent_id").createOrReplaceTempView(view)
    return edges.sparkSession.sql(f"""
        WITH RECURSIVE walk(id, ids, depth) MAX RECURSION LEVEL 1000 AS (
          SELECT id, array(id), 0 FROM {view} WHERE parent_id IS NULL
          UNION ALL
          SELECT e.id, concat(w.ids, array(e.id)), w.depth + 1 FROM walk w JOIN {view} e ON e.parent_id = w.id WHERE NOT array_contains(w.ids, e.id))
        SELECT id, array_join(transform(ids, x -> cast(x AS string)), '/') AS path, depth FROM walk""")


_reg("op_U5b_recursive_paths", lambda sp, d: hierarchy_paths(S.clo_hierarchy(sp, d)),
     """WITH RECURSIVE walk(id, path, depth) AS (
          SELECT id, CAST(id AS VARCHAR), 0 FROM product_hierarchy WHERE parent_id IS NULL
          UNION ALL
          SELECT h.id, w.path || '/' || CAST(h.id AS VARCHAR), w.depth + 1 FROM walk w JOIN product_hierarchy h ON h.parent_id = w.id)
        SELECT id, path, depth FROM walk""", "product_hierarchy")
