"""Payment schedule of a subscription history.

Rules: monthly plans pay on the start day every month, the annual plan every
year; a plan pays until the next plan takes effect or the cap date; churn
stops payments; an annual plan bought during a pro-monthly period takes effect
at the end of that monthly period; the first payment after an upgrade from
the basic plan is reduced by the basic payment made within the month before.
Months are stepped from the effective start (Jan 31 -> Feb 29 -> Mar 31).
Per-customer windows run over a customer's plan rows and payments, bounded
by plan changes and by months to the cap date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from casebook.operators.broadcast import broadcast_if_small

BASIC, PRO_MONTHLY, PRO_ANNUAL = 1, 2, 3


def payment_schedule(subs: DataFrame, plans: DataFrame, cap: str) -> DataFrame:
    w = W.partitionBy("customer_id").orderBy("start_date", "plan_id")
    s = (subs.withColumn("prev_plan", F.lag("plan_id").over(w))
             .withColumn("prev_start", F.lag("start_date").over(w)))
    i0 = ((F.year("start_date") - F.year("prev_start")) * 12
          + F.month("start_date") - F.month("prev_start"))
    cand = F.add_months("prev_start", i0)
    period_end = F.when(cand >= F.col("start_date"), cand).otherwise(F.add_months("prev_start", i0 + 1))
    s = s.withColumn("eff_start", F.when((F.col("plan_id") == PRO_ANNUAL) & (F.col("prev_plan") == PRO_MONTHLY),
                                         period_end).otherwise(F.col("start_date")))
    s = s.withColumn("end_date", F.lead("eff_start").over(w))
    paid = (s.filter(F.col("plan_id").isin(BASIC, PRO_MONTHLY, PRO_ANNUAL))
             .join(broadcast_if_small(plans), "plan_id"))          # plan catalogue: a handful of rows
    capd = F.lit(cap).cast("date")
    step = F.when(F.col("plan_id") == PRO_ANNUAL, 12).otherwise(1)
    n = F.floor(((F.year(capd) - F.year("eff_start")) * 12 + F.month(capd) - F.month("eff_start")) / step)
    # guarded series: sequence(0, n) raises for n < 0, so empty those rows first
    idx = F.explode(F.when(n >= 0, F.sequence(F.lit(0), n.cast("int"))).otherwise(F.array().cast("array<int>")))
    p = paid.select("customer_id", "plan_id", "plan_name", F.col("price").alias("amount"), "eff_start",
                    "end_date", step.alias("step"), idx.alias("i"))
    p = (p.withColumn("payment_date", F.add_months("eff_start", F.col("i") * F.col("step")))
          .filter((F.col("payment_date") <= capd)
                  & (F.col("end_date").isNull() | (F.col("payment_date") < F.col("end_date")))))
    w2 = W.partitionBy("customer_id").orderBy("payment_date", "plan_id")
    reduce = ((F.lag("plan_id").over(w2) == BASIC) & F.col("plan_id").isin(PRO_MONTHLY, PRO_ANNUAL)
              & (F.add_months(F.lag("payment_date").over(w2), 1) > F.col("payment_date")))
    amount = F.when(reduce, F.col("amount") - F.lag("amount").over(w2)).otherwise(F.col("amount"))
    return p.select("customer_id", "plan_id", "plan_name", "payment_date",
                    amount.cast("decimal(10,2)").alias("amount"),
                    F.row_number().over(w2).cast("bigint").alias("payment_order"))


def payment_schedule_sql(cap: str) -> str:
    return f"""
WITH s AS (SELECT *, LAG(plan_id) OVER w AS prev_plan, LAG(start_date) OVER w AS prev_start
           FROM subscriptions WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, plan_id)),
     e AS (SELECT *, CASE WHEN plan_id = 3 AND prev_plan = 2 THEN
                   CASE WHEN CAST(prev_start + to_months(CAST(i0 AS INTEGER)) AS DATE) >= start_date
                        THEN CAST(prev_start + to_months(CAST(i0 AS INTEGER)) AS DATE)
                        ELSE CAST(prev_start + to_months(CAST(i0 + 1 AS INTEGER)) AS DATE) END
                   ELSE start_date END AS eff_start
           FROM (SELECT *, (year(start_date) - year(prev_start)) * 12
                             + month(start_date) - month(prev_start) AS i0 FROM s) x),
     f AS (SELECT *, LEAD(eff_start) OVER (PARTITION BY customer_id ORDER BY start_date, plan_id)
                   AS end_date FROM e),
     g AS (SELECT customer_id, plan_id, plan_name, price AS amount, eff_start, end_date, step,
                  unnest(generate_series(0, CAST(floor(((year(DATE '{cap}') - year(eff_start)) * 12
                         + month(DATE '{cap}') - month(eff_start)) / step) AS BIGINT))) AS i
           FROM (SELECT f.*, p.plan_name, p.price, CASE WHEN f.plan_id = 3 THEN 12 ELSE 1 END AS step
                 FROM f JOIN plans p USING (plan_id) WHERE f.plan_id IN (1, 2, 3)) y),
     h AS (SELECT *, CAST(eff_start + to_months(CAST(i * step AS INTEGER)) AS DATE) AS payment_date FROM g),
     k AS (SELECT * FROM h WHERE payment_date <= DATE '{cap}'
                                AND (end_date IS NULL OR payment_date < end_date))
SELECT customer_id, plan_id, plan_name, payment_date,
       CAST(CASE WHEN LAG(plan_id) OVER w2 = 1 AND plan_id IN (2, 3)
                      AND CAST(LAG(payment_date) OVER w2 + INTERVAL 1 MONTH AS DATE) > payment_date
                 THEN amount - LAG(amount) OVER w2 ELSE amount END AS DECIMAL(10,2)) AS amount,
       ROW_NUMBER() OVER w2 AS payment_order
FROM k WINDOW w2 AS (PARTITION BY customer_id ORDER BY payment_date, plan_id)"""
