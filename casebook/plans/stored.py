"""Stored tables: create, replace, append, update and delete."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from casebook.sources import catalog as C, subjects as S
from casebook.sources.subjects_sql import with_views
from casebook.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}

UPDATED_FROM = "1997-01-01"      # the update touches orders of these years only
MIN_MONTHS = 6                   # interests seen in fewer months are deleted


def _reg(name, fn, sql, views=()):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views) if views else sql


def created(sp, d):
    """CREATE TABLE AS, dropped first so that the job can be repeated."""
    C.drop_table(sp, "orders_per_customer")
    o = table(sp, d, "orders", "o_custkey", "o_totalprice")
    return C.create_table(o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("largest")), "orders_per_customer")


def replaced(sp, d):
    """DROP IF EXISTS and CREATE in one step."""
    return C.replace_table(S.wks_weekly_sales(sp, d), "weekly_sales")


def appended(sp, d):
    """A table created from one part of the customers, the rest inserted into it. Each run has a table of its own."""
    c = table(sp, d, "customer", "c_custkey", "c_name", "c_acctbal")
    positive = F.coalesce(F.col("c_acctbal") > 0, F.lit(False))
    name = f"customers_by_part_{uuid.uuid4().hex[:8]}"
    C.create_table(c.where(positive), name)
    return C.append(c.where(~positive).select("c_acctbal", "c_name", "c_custkey"), name)


def _orders_by_year(sp, d, name):
    o = table(sp, d, "orders", "o_orderkey", "o_orderpriority", "o_orderdate")
    return C.replace_table(o.withColumn("year", F.year("o_orderdate")).repartition("year"), name, "year")


def updated(sp, d):
    """UPDATE ... SET priority = NULL for unspecified ones from one date on; earlier years' files stay."""
    _orders_by_year(sp, d, "orders_updated")
    return C.update_where(sp, "orders_updated", {"o_orderpriority": F.lit(None)},
                          (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderdate") >= F.lit(UPDATED_FROM).cast("date")))


def deleted(sp, d):
    """DELETE ... WHERE a condition; rows for which it is unknown stay."""
    _orders_by_year(sp, d, "orders_deleted")
    return C.delete_where(sp, "orders_deleted", (F.col("year") == 1994) | (F.col("o_orderpriority") == "5-LOW") & (F.col("year") > 1996))


def deleted_by_subquery(sp, d):
    """DELETE ... WHERE interest_id IN (SELECT ...): interests seen in too few months."""
    m = S.seg_interest_metrics(sp, d)
    C.replace_table(m.repartition("month_year"), "interest_metrics_kept", "month_year")
    few = m.groupBy("interest_id").agg(F.count_distinct("month_year").alias("months")).where(F.col("months") < MIN_MONTHS)
    return C.delete_keys(sp, "interest_metrics_kept", few, "interest_id")


_reg("op_S4_create_table_as", created, "SELECT o_custkey, COUNT(*) AS orders, MAX(o_totalprice) AS largest FROM orders GROUP BY 1")
_reg("op_S6_replace_table", replaced, "SELECT * FROM weekly_sales", "weekly_sales")
_reg("op_S7_append", appended, "SELECT c_custkey, c_name, c_acctbal FROM customer")
_reg("op_S8_update", updated,
     f"""SELECT o_orderkey, CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderdate >= DATE '{UPDATED_FROM}' THEN NULL ELSE o_orderpriority END
               AS o_orderpriority, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
_reg("op_S9_delete", deleted,
     """SELECT o_orderkey, o_orderpriority, o_orderdate, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
        WHERE (year(o_orderdate) = 1994 OR o_orderpriority = '5-LOW' AND year(o_orderdate) > 1996) IS NOT TRUE""")
_reg("op_S9b_delete_by_subquery", deleted_by_subquery,
     f"""SELECT * FROM interest_metrics WHERE interest_id IS NULL OR interest_id NOT IN (
          SELECT interest_id FROM interest_metrics WHERE interest_id IS NOT NULL GROUP BY interest_id HAVING COUNT(DISTINCT month_year) < {MIN_MONTHS})""",
     "interest_ids interest_map interest_metrics")
