"""Bank: node allocation, transaction mix, balances, interest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.functions import exact_avg
from casebook.functions.numeric import avg_expr
from casebook.operators import running_sum
from casebook.operators.rowid import row_number_by
from casebook.sources import subjects as S
from casebook.sources.subjects_sql import with_views

INTEREST_RATE = "0.06"           # simple annual interest
GROWTH = "1.05"                  # "more than 5%" balance growth

QUERIES: dict = {}
ORACLE: dict = {}


def _money(c):
    return c.cast("decimal(38,2)")


def signed(df: DataFrame) -> DataFrame:
    amt = F.when(F.col("txn_type") == "deposit", F.col("txn_amount")).otherwise(-F.col("txn_amount"))
    return df.withColumn("signed_amount", amt)


def month_of(c: str):
    return F.trunc(F.col(c), "month")


def unique_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.agg(F.count_distinct("node_id").alias("unique_nodes"))


def nodes_per_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    return (nodes.join(broadcast_if_small(regions), "region_id")   # 5 regions, fixed domain
                 .groupBy("region_id", "region_name")
                 .agg(F.count("node_id").alias("node_rows"),
                      F.count_distinct("customer_id").alias("customers")))


def closed_node_days(nodes: DataFrame) -> DataFrame:
    """Node rows that ended (end < the open-row sentinel = max end), with days."""
    last = nodes.agg(F.max("end_date")).scalar()                   # scalar subquery
    return (nodes.filter(F.col("end_date") < last)
                 .withColumn("days", F.datediff("end_date", "start_date")))


def mean_reallocation_days(nodes: DataFrame) -> DataFrame:
    return closed_node_days(nodes).agg(
        exact_avg("days").alias("avg_reallocation_days"))


def reallocation_percentiles(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    # exact percentiles keep one counter per distinct day count (bounded)
    p = F.percentile("days", F.array(F.lit(0.5), F.lit(0.8), F.lit(0.95)))
    r = (closed_node_days(nodes).groupBy("region_id")
         .agg(exact_avg("days").alias("avg_days"), p.alias("_p")))
    return (r.join(broadcast_if_small(regions), "region_id")
             .select("region_id", "region_name",
                     "avg_days",
                     F.round(F.col("_p")[0], 2).alias("median_days"),
                     F.round(F.col("_p")[1], 2).alias("p80_days"),
                     F.round(F.col("_p")[2], 2).alias("p95_days")))


def txn_type_summary(tx: DataFrame) -> DataFrame:
    return tx.groupBy("txn_type").agg(F.count(F.lit(1)).alias("unique_count"),
                                      _money(F.sum("txn_amount")).alias("total_amount"))


def mean_deposits(tx: DataFrame) -> DataFrame:
    per = (tx.filter(F.col("txn_type") == "deposit").groupBy("customer_id")
             .agg(F.count(F.lit(1)).alias("n"), F.sum("txn_amount").alias("amt")))
    return per.agg(exact_avg("n").alias("avg_deposit_count"),
                   exact_avg("amt").alias("avg_total_amount"))


def active_customers_per_month(tx: DataFrame) -> DataFrame:
    t = F.col("txn_type")
    per = (tx.groupBy("customer_id", month_of("txn_date").alias("month"))
             .agg(F.count_if(t == "deposit").alias("deposit"),
                  F.count_if(t == "purchase").alias("purchase"),
                  F.count_if(t == "withdrawal").alias("withdrawal")))
    return (per.filter((F.col("deposit") > 1) & ((F.col("purchase") >= 1) | (F.col("withdrawal") >= 1)))
               .groupBy("month").agg(F.count(F.lit(1)).alias("customers")))


def monthly_net(tx: DataFrame) -> DataFrame:
    return (signed(tx).groupBy("customer_id", month_of("txn_date").alias("month"))
                      .agg(_money(F.sum("signed_amount")).alias("net_amount")))


def closing_balance(tx: DataFrame) -> DataFrame:
    m = monthly_net(tx)
    return (running_sum(m, "customer_id", "month", "net_amount", "closing_balance", join_back=False)
            .withColumn("closing_balance", _money(F.col("closing_balance"))))


def balance_growth_share(tx: DataFrame) -> DataFrame:
    c = closing_balance(tx)
    prev = F.lag("closing_balance").over(W.partitionBy("customer_id").orderBy("month"))
    g = c.withColumn("prev", prev)
    grew = g.filter((F.col("prev") > 0)
                    & (F.col("closing_balance") > F.col("prev") * F.lit(GROWTH).cast("decimal(3,2)")))
    n_all = tx.agg(F.count_distinct("customer_id")).scalar()
    return (grew.agg(F.count_distinct("customer_id").alias("customers_with_growth"))
                .withColumn("total_customers", n_all)
                .withColumn("pct_customers",
                              F.round(F.lit(100.0) * F.col("customers_with_growth")
                                      / F.col("total_customers"), 2)))


def running_balance(tx: DataFrame) -> DataFrame:
    s = signed(tx)
    r = running_sum(s, "customer_id", "txn_date", "signed_amount", "running_balance")
    return r.select("customer_id", "txn_date", "txn_type", "txn_amount", "signed_amount",
                    _money(F.col("running_balance")).alias("running_balance"))


def running_balance_stats(tx: DataFrame) -> DataFrame:
    return running_balance(tx).groupBy("customer_id").agg(
        F.min("running_balance").alias("min_running_bal"),
        exact_avg("running_balance").alias("avg_running_bal"),
        F.max("running_balance").alias("max_running_bal"))


def running_balance_stats_global(tx: DataFrame) -> DataFrame:
    """The same three statistics over all transactions (the written form)."""
    return running_balance(tx).agg(
        F.min("running_balance").alias("min_running_bal"),
        exact_avg("running_balance").alias("avg_running_bal"),
        F.max("running_balance").alias("max_running_bal"))


def yearly_interest(tx: DataFrame, rate: str = INTEREST_RATE) -> DataFrame:
    y = (signed(tx).groupBy("customer_id", F.year("txn_date").alias("year"))
                   .agg(_money(F.sum("signed_amount")).alias("total_amt")))
    return y.withColumn("interest",
                        (F.col("total_amt") * F.lit(rate).cast("decimal(4,2)")).cast("decimal(38,4)"))


def transaction_sequence(tx: DataFrame) -> DataFrame:
    """Per-customer transaction order; a customer with a third of all rows is
    spread over several sorted partitions (see ``row_number_by``)."""
    return row_number_by(tx, "customer_id", ["txn_date", "txn_type", "txn_amount"], out="seq",
                         stage="transaction_sequence")


# ---- registry -----------------------------------------------------------------
def _reg(name, fn, sql, views):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


TX = "customer_transactions"
ND = "customer_nodes"
SIGNED = "CASE WHEN txn_type = 'deposit' THEN txn_amount ELSE -txn_amount END"
MONTH = "CAST(date_trunc('month', txn_date) AS DATE)"
CLOSED = """(SELECT *, end_date - start_date AS days FROM customer_nodes
             WHERE end_date < (SELECT MAX(end_date) FROM customer_nodes))"""

_reg("K1_unique_nodes", lambda sp, d: unique_nodes(S.bnk_nodes(sp, d)),
     "SELECT COUNT(DISTINCT node_id) AS unique_nodes FROM customer_nodes", ND)
_reg("K1b_nodes_customers_per_region",
     lambda sp, d: nodes_per_region(S.bnk_nodes(sp, d), S.bnk_regions(sp, d)),
     """SELECT region_id, region_name, COUNT(node_id) AS node_rows,
               COUNT(DISTINCT customer_id) AS customers
        FROM customer_nodes JOIN regions USING (region_id) GROUP BY region_id, region_name""",
     [ND, "regions"])
_reg("K2_mean_reallocation_days", lambda sp, d: mean_reallocation_days(S.bnk_nodes(sp, d)),
     f"SELECT {avg_expr("days", 2, "duck")} AS avg_reallocation_days FROM {CLOSED} c", ND)
_reg("K3_reallocation_percentiles",
     lambda sp, d: reallocation_percentiles(S.bnk_nodes(sp, d), S.bnk_regions(sp, d)),
     f"""SELECT region_id, region_name, {avg_expr("days", 2, "duck")} AS avg_days,
               ROUND(quantile_cont(days, 0.5), 2) AS median_days,
               ROUND(quantile_cont(days, 0.8), 2) AS p80_days,
               ROUND(quantile_cont(days, 0.95), 2) AS p95_days
        FROM {CLOSED} c JOIN regions USING (region_id) GROUP BY region_id, region_name""",
     [ND, "regions"])
_reg("K4_txn_type_summary", lambda sp, d: txn_type_summary(S.bnk_transactions(sp, d)),
     f"""SELECT txn_type, COUNT(*) AS unique_count,
               CAST(SUM(txn_amount) AS DECIMAL(38,2)) AS total_amount
        FROM {TX} GROUP BY txn_type""", TX)
_reg("K5_mean_deposits", lambda sp, d: mean_deposits(S.bnk_transactions(sp, d)),
     f"""SELECT {avg_expr("n", 2, "duck")} AS avg_deposit_count,
               {avg_expr("amt", 2, "duck")} AS avg_total_amount
        FROM (SELECT customer_id, COUNT(*) AS n, SUM(txn_amount) AS amt
              FROM {TX} WHERE txn_type = 'deposit' GROUP BY customer_id) t""", TX)
_reg("K6_active_customers_per_month",
     lambda sp, d: active_customers_per_month(S.bnk_transactions(sp, d)),
     f"""SELECT month, COUNT(*) AS customers FROM (
          SELECT customer_id, {MONTH} AS month,
                 COUNT(*) FILTER (WHERE txn_type = 'deposit') AS deposit,
                 COUNT(*) FILTER (WHERE txn_type = 'purchase') AS purchase,
                 COUNT(*) FILTER (WHERE txn_type = 'withdrawal') AS withdrawal
          FROM {TX} GROUP BY 1, 2) t
        WHERE deposit > 1 AND (purchase >= 1 OR withdrawal >= 1) GROUP BY month""", TX)
_reg("K7_monthly_net", lambda sp, d: monthly_net(S.bnk_transactions(sp, d)),
     f"""SELECT customer_id, {MONTH} AS month,
               CAST(SUM({SIGNED}) AS DECIMAL(38,2)) AS net_amount
        FROM {TX} GROUP BY 1, 2""", TX)
_reg("K7b_closing_balance", lambda sp, d: closing_balance(S.bnk_transactions(sp, d)),
     f"""SELECT customer_id, month,
               CAST(SUM(net) OVER (PARTITION BY customer_id ORDER BY month) AS DECIMAL(38,2))
                 AS closing_balance
        FROM (SELECT customer_id, {MONTH} AS month, SUM({SIGNED}) AS net
              FROM {TX} GROUP BY 1, 2) m""", TX)
_reg("K8_balance_growth_share", lambda sp, d: balance_growth_share(S.bnk_transactions(sp, d)),
     f"""WITH m AS (SELECT customer_id, {MONTH} AS month, SUM({SIGNED}) AS net
                   FROM {TX} GROUP BY 1, 2),
             c AS (SELECT customer_id, month,
                          CAST(SUM(net) OVER (PARTITION BY customer_id ORDER BY month)
                               AS DECIMAL(38,2)) AS closing FROM m),
             g AS (SELECT *, LAG(closing) OVER (PARTITION BY customer_id ORDER BY month) AS prev
                   FROM c),
             a AS (SELECT COUNT(DISTINCT customer_id) AS customers_with_growth FROM g
                   WHERE prev > 0 AND closing > prev * {GROWTH}),
             b AS (SELECT COUNT(DISTINCT customer_id) AS total_customers FROM {TX})
        SELECT customers_with_growth, total_customers,
               ROUND(100.0 * customers_with_growth / total_customers, 2) AS pct_customers
        FROM a, b""", TX)
_reg("K9_running_balance", lambda sp, d: running_balance(S.bnk_transactions(sp, d)),
     f"""SELECT customer_id, txn_date, txn_type, txn_amount, {SIGNED} AS signed_amount,
               CAST(SUM({SIGNED}) OVER (PARTITION BY customer_id ORDER BY txn_date)
                    AS DECIMAL(38,2)) AS running_balance
        FROM {TX}""", TX)
_reg("K10_running_balance_stats", lambda sp, d: running_balance_stats(S.bnk_transactions(sp, d)),
     f"""SELECT customer_id, MIN(rb) AS min_running_bal,
               {avg_expr("rb", 2, "duck")} AS avg_running_bal, MAX(rb) AS max_running_bal
        FROM (SELECT customer_id,
                     CAST(SUM({SIGNED}) OVER (PARTITION BY customer_id ORDER BY txn_date)
                          AS DECIMAL(38,2)) AS rb FROM {TX}) t
        GROUP BY customer_id""", TX)
_reg("K11_yearly_interest", lambda sp, d: yearly_interest(S.bnk_transactions(sp, d)),
     f"""SELECT customer_id, CAST(year(txn_date) AS INTEGER) AS year,
               CAST(SUM({SIGNED}) AS DECIMAL(38,2)) AS total_amt,
               CAST(CAST(SUM({SIGNED}) AS DECIMAL(38,2)) * {INTEREST_RATE} AS DECIMAL(38,4))
                 AS interest
        FROM {TX} GROUP BY 1, 2""", TX)
_reg("K12_transaction_sequence", lambda sp, d: transaction_sequence(S.bnk_transactions(sp, d)),
     f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id
                                      ORDER BY txn_date, txn_type, txn_amount) AS seq
        FROM {TX}""", TX)
_reg("K10b_running_balance_stats_global",
     lambda sp, d: running_balance_stats_global(S.bnk_transactions(sp, d)),
     f"""SELECT MIN(rb) AS min_running_bal, {avg_expr("rb", 2, "duck")} AS avg_running_bal,
               MAX(rb) AS max_running_bal
        FROM (SELECT CAST(SUM({SIGNED}) OVER (PARTITION BY customer_id ORDER BY txn_date)
                          AS DECIMAL(38,2)) AS rb FROM {TX}) t""", TX)
