"""Subscriptions: journeys, churn, plan transitions, snapshot, payments, growth."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from casebook.operators.broadcast import broadcast_if_small
from casebook.functions.labels import month_name
from casebook.functions.numeric import avg_expr, exact_avg
from casebook.operators.neighbours import over_all
from casebook.operators.sample import bottom_k
from casebook.operators.schedule import payment_schedule, payment_schedule_sql
from casebook.sources import subjects as S
from casebook.sources.subjects_sql import VIEWS, with_views

# Parameters mapped onto the stored data (one month of events): the week is the
# reporting grain, the year of the data is the payment year.
AFTER_DATE = "2024-01-05"        # "start dates after ..." (B3)
SNAPSHOT_DATE = "2024-01-15"     # plan mix as of this day (B7)
YEAR_START, YEAR_END = "2024-01-01", "2025-01-01"
PAYMENT_CAP = "2024-12-31"
BUCKET_DAYS = 30                 # width of the days-to-upgrade buckets
SHORT_BUCKET_DAYS = 7            # the same for the one month of events
BIG_STEP = 30                    # growth above this is a double arrow
TRIAL, BASIC, PRO_MONTHLY, PRO_ANNUAL, CHURN = 0, 1, 2, 3, 4
# Growth labels.
UP2, DOWN2, UP, DOWN, FLAT = "↑↑", "↓↓", "↑", "↓", "-"

QUERIES: dict = {}
ORACLE: dict = {}

ORDER = ["start_date", "plan_id"]


def _w():
    return W.partitionBy("customer_id").orderBy(*ORDER)


def with_next(subs: DataFrame) -> DataFrame:
    """Next plan and its start per customer (a customer has a few plan rows)."""
    w = _w()
    return (subs.withColumn("next_plan", F.lead("plan_id").over(w))
                .withColumn("next_date", F.lead("start_date").over(w)))


def journey(subs, plans):
    return subs.join(broadcast_if_small(plans), "plan_id").select("customer_id", "plan_id", "plan_name", "price",
                                                           "start_date")


def customer_count(subs):
    return subs.agg(F.count_distinct("customer_id").alias("total_customers"))


def period(grain: str) -> F.Column:
    """First day of the start's period (``month`` or ``week``)."""
    return F.to_date(F.date_trunc(grain, "start_date")).alias(f"{grain}_start")


def trial_starts(subs, grain: str = "month"):
    g = subs.filter(F.col("plan_id") == TRIAL).groupBy(period(grain)).agg(F.count(F.lit(1)).alias("trial_starts"))
    return g.withColumn("month_name", month_name("month_start")) if grain == "month" else g


def events_per_year(subs):
    return subs.groupBy(F.year("start_date").alias("year")).agg(F.count(F.lit(1)).alias("events"))


def plans_after(subs, plans, after: str = AFTER_DATE):
    s = subs.filter(F.col("start_date") > F.lit(after).cast("date"))
    return (s.groupBy("plan_id").agg(F.count(F.lit(1)).alias("events"))
             .join(broadcast_if_small(plans.select("plan_id", "plan_name")), "plan_id"))


def _total(subs):
    """All customers, as a scalar subquery."""
    return subs.agg(F.count_distinct("customer_id")).scalar()


def churn_rate(subs):
    c = subs.filter(F.col("plan_id") == CHURN).agg(F.count_distinct("customer_id").alias("churned_customers"))
    return c.select("churned_customers",
                    F.round(F.lit(100.0) * F.col("churned_customers") / _total(subs), 1).alias("churn_pct"))


def _nth(subs):
    return subs.withColumn("rn", F.row_number().over(_w()))


def churn_after_trial(subs):
    n = _nth(subs)
    first = n.filter((F.col("rn") == 1) & (F.col("plan_id") == TRIAL)).select("customer_id")
    second = n.filter((F.col("rn") == 2) & (F.col("plan_id") == CHURN)).select("customer_id")
    c = first.join(second, "customer_id").agg(F.count(F.lit(1)).alias("customers"))
    return c.select("customers", F.round(F.lit(100.0) * F.col("customers") / _total(subs), 0).alias("pct"))


def next_plan_after_trial(subs, plans):
    n = with_next(subs)
    firsts = _nth(subs).filter((F.col("rn") == 1) & (F.col("plan_id") == TRIAL)).select("customer_id")
    t = (n.filter(F.col("plan_id") == TRIAL).join(firsts, "customer_id", "left_semi")
          .filter(F.col("next_plan").isNotNull())
          .groupBy(F.col("next_plan").alias("plan_id")).agg(F.count(F.lit(1)).alias("customers")))
    tot = t.agg(F.sum("customers")).scalar()
    return (t.withColumn("pct", F.round(F.lit(100.0) * F.col("customers") / tot, 1))
             .join(broadcast_if_small(plans.select("plan_id", "plan_name")), "plan_id"))


def plan_mix_at(subs, plans, at: str = SNAPSHOT_DATE):
    """As-of snapshot: the plan in effect on ``at`` for every customer."""
    d = F.lit(at).cast("date")
    n = with_next(subs)
    cur = n.filter((F.col("start_date") <= d) & (F.col("next_date").isNull() | (F.col("next_date") > d)))
    g = cur.groupBy("plan_id").agg(F.count(F.lit(1)).alias("customers"))
    tot = g.agg(F.sum("customers")).scalar()
    return (g.withColumn("pct", F.round(F.lit(100.0) * F.col("customers") / tot, 1))
             .join(broadcast_if_small(plans.select("plan_id", "plan_name")), "plan_id"))


def plan_end_dates(subs):
    p = F.col("plan_id")
    days = F.when(p == TRIAL, 6).when(p.isin(BASIC, PRO_MONTHLY), 30).when(p == PRO_ANNUAL, 365)
    return subs.filter(p < CHURN).select("customer_id", "plan_id", "start_date",
                                         F.date_add("start_date", days).alias("end_date"))


def annual_upgrades(subs):
    s = subs.filter((F.col("plan_id") == PRO_ANNUAL) & (F.col("start_date") >= F.lit(YEAR_START).cast("date"))
                    & (F.col("start_date") < F.lit(YEAR_END).cast("date")))
    return s.agg(F.count_distinct("customer_id").alias("customers"))


def _upgrade_days(subs):
    g = subs.groupBy("customer_id").agg(
        F.min(F.when(F.col("plan_id") == TRIAL, F.col("start_date"))).alias("joined"),
        F.min(F.when(F.col("plan_id") == PRO_ANNUAL, F.col("start_date"))).alias("annual"))
    return g.select("customer_id", F.datediff("annual", "joined").alias("days")).filter(F.col("days") > 0)


def mean_days_to_annual(subs):
    return _upgrade_days(subs).agg(F.count(F.lit(1)).alias("customers"), exact_avg("days").alias("avg_days"))


def days_to_annual_buckets(subs, width: int = BUCKET_DAYS):
    b = _upgrade_days(subs).withColumn("bucket_start", (F.floor(F.col("days") / width) * width).cast("int"))
    return b.groupBy("bucket_start").agg(F.count(F.lit(1)).alias("customers"), exact_avg("days").alias("avg_days")) \
        .withColumn("bucket", F.concat(F.col("bucket_start").cast("string"), F.lit("-"),
                                       (F.col("bucket_start") + width - 1).cast("string"), F.lit(" days")))


def downgrades(subs):
    n = with_next(subs).filter((F.col("plan_id") == PRO_MONTHLY) & (F.col("next_plan") == BASIC)
                               & (F.col("next_date") >= F.lit(YEAR_START).cast("date"))
                               & (F.col("next_date") < F.lit(YEAR_END).cast("date")))
    return n.agg(F.count_distinct("customer_id").alias("customers"))


def payments(subs, plans):
    return payment_schedule(subs, plans, PAYMENT_CAP)


def growth(subs, grain: str = "month"):
    """Customers per period, change to the period before, and its label."""
    g = subs.groupBy(period(grain)).agg(F.count(F.lit(1)).alias("customers"))
    g = over_all(g, f"{grain}_start", {"previous": lambda w: F.lag("customers").over(w)}, back=1, stage="growth_periods")
    g = g.withColumn("growth", F.col("customers") - F.col("previous"))
    gr = F.col("growth")
    label = (F.when(gr >= BIG_STEP, UP2).when(gr <= -BIG_STEP, DOWN2).when(gr > 0, UP).when(gr < 0, DOWN)
              .otherwise(FLAT))
    return g.withColumn("trend", label)


def retained(subs, grain: str = "month"):
    n = with_next(subs).filter((F.col("plan_id") == TRIAL) & (F.col("next_plan") != CHURN))
    return n.groupBy(period(grain)).agg(F.count(F.lit(1)).alias("retained"))


def churned(subs, grain: str = "month"):
    n = with_next(subs).filter(F.col("next_plan") == CHURN)
    return n.groupBy(period(grain)).agg(F.count(F.lit(1)).alias("churned"))


def churn_by_previous_plan(subs):
    return (with_next(subs).filter(F.col("next_plan") == CHURN).groupBy("plan_id")
            .agg(F.count(F.lit(1)).alias("churn_counts")))


def paid_journey(subs, plans):
    n = with_next(subs.filter(F.col("plan_id") > TRIAL))
    return n.join(broadcast_if_small(plans.select("plan_id", "plan_name")), "plan_id").select(
        "customer_id", "plan_id", "plan_name", "start_date", "next_plan")


SAMPLE_ROWS = 50                 # rows of the sampled subset


def sampled_subscriptions(subs):
    """A fixed number of subscription rows; the same ones under any layout of the table."""
    return bottom_k(subs.select("customer_id", "plan_id", "start_date"), ["customer_id", "plan_id", "start_date"], SAMPLE_ROWS).drop("draw")


def churn_rows(subs):
    return subs.filter(F.col("plan_id") == CHURN).agg(F.count(F.lit(1)).alias("churn_rows"))


# ---- registry -----------------------------------------------------------------
def _s(sp, d):
    return S.sub_subscriptions(sp, d)


def _sp(sp, d):
    return _s(sp, d), S.sub_plans(sp)


VIEWS["sub_next"] = """
SELECT *, LEAD(plan_id) OVER w AS next_plan, LEAD(start_date) OVER w AS next_date,
       ROW_NUMBER() OVER w AS rn
FROM subscriptions WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, plan_id)"""
SB = "subscriptions plans"
SN = "subscriptions plans sub_next"
WEEK = "CAST(date_trunc('week', start_date) AS DATE)"


def _reg(name, fn, sql, views=SB):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


_reg("B1_customer_journey", lambda sp, d: journey(*_sp(sp, d)),
     "SELECT customer_id, plan_id, plan_name, price, start_date FROM subscriptions JOIN plans USING (plan_id)")
_reg("B2_customer_count", lambda sp, d: customer_count(_s(sp, d)),
     "SELECT COUNT(DISTINCT customer_id) AS total_customers FROM subscriptions")
_reg("B2b_trial_starts_per_week", lambda sp, d: trial_starts(_s(sp, d), "week"),
     f"SELECT {WEEK} AS week_start, COUNT(*) AS trial_starts FROM subscriptions WHERE plan_id = 0 GROUP BY 1")
_reg("B2c_events_per_year", lambda sp, d: events_per_year(_s(sp, d)),
     "SELECT CAST(year(start_date) AS INTEGER) AS year, COUNT(*) AS events FROM subscriptions GROUP BY 1")
_reg("B3_plans_after_date", lambda sp, d: plans_after(*_sp(sp, d)),
     f"""SELECT plan_id, COUNT(*) AS events, plan_name FROM subscriptions JOIN plans USING (plan_id)
        WHERE start_date > DATE '{AFTER_DATE}' GROUP BY plan_id, plan_name""")
_reg("B4_churn_rate", lambda sp, d: churn_rate(_s(sp, d)),
     """SELECT COUNT(DISTINCT customer_id) AS churned_customers,
               ROUND(100.0 * COUNT(DISTINCT customer_id)
                     / (SELECT COUNT(DISTINCT customer_id) FROM subscriptions), 1) AS churn_pct
        FROM subscriptions WHERE plan_id = 4""")
_reg("B5_churn_after_trial", lambda sp, d: churn_after_trial(_s(sp, d)),
     """SELECT COUNT(*) AS customers,
               ROUND(100.0 * COUNT(*) / (SELECT COUNT(DISTINCT customer_id) FROM subscriptions), 0) AS pct
        FROM sub_next a JOIN sub_next b USING (customer_id)
        WHERE a.rn = 1 AND a.plan_id = 0 AND b.rn = 2 AND b.plan_id = 4""", SN)
_reg("B6_next_plan_after_trial", lambda sp, d: next_plan_after_trial(*_sp(sp, d)),
     """SELECT next_plan AS plan_id, COUNT(*) AS customers,
               ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS pct, plan_name
        FROM sub_next s JOIN plans p ON p.plan_id = s.next_plan
        WHERE s.plan_id = 0 AND s.rn = 1 AND next_plan IS NOT NULL GROUP BY next_plan, plan_name""", SN)
_reg("B7_plan_mix_at_date", lambda sp, d: plan_mix_at(*_sp(sp, d)),
     f"""SELECT plan_id, COUNT(*) AS customers, ROUND(100.0 * COUNT(*) / SUM(COUNT(*)) OVER (), 1) AS pct,
               plan_name
        FROM sub_next JOIN plans USING (plan_id)
        WHERE start_date <= DATE '{SNAPSHOT_DATE}' AND (next_date IS NULL OR next_date > DATE '{SNAPSHOT_DATE}')
        GROUP BY plan_id, plan_name""", SN)
_reg("B8_plan_end_dates", lambda sp, d: plan_end_dates(_s(sp, d)),
     """SELECT customer_id, plan_id, start_date,
               CAST(start_date + CASE plan_id WHEN 0 THEN 6 WHEN 1 THEN 30 WHEN 2 THEN 30 WHEN 3 THEN 365 END
                    AS DATE) AS end_date
        FROM subscriptions WHERE plan_id < 4""")
_reg("B9_annual_upgrades", lambda sp, d: annual_upgrades(_s(sp, d)),
     f"""SELECT COUNT(DISTINCT customer_id) AS customers FROM subscriptions
        WHERE plan_id = 3 AND start_date >= DATE '{YEAR_START}' AND start_date < DATE '{YEAR_END}'""")
_UPD = """(SELECT customer_id, CAST(annual - joined AS INTEGER) AS days FROM (
             SELECT customer_id, MIN(CASE WHEN plan_id = 0 THEN start_date END) AS joined,
                    MIN(CASE WHEN plan_id = 3 THEN start_date END) AS annual
             FROM subscriptions GROUP BY customer_id) g WHERE annual - joined > 0)"""
_reg("B10_mean_days_to_annual", lambda sp, d: mean_days_to_annual(_s(sp, d)),
     f"SELECT COUNT(*) AS customers, {avg_expr('days', 2, 'duck')} AS avg_days FROM {_UPD} u")
_reg("B11_days_to_annual_buckets", lambda sp, d: days_to_annual_buckets(_s(sp, d), SHORT_BUCKET_DAYS),
     f"""SELECT bucket_start, COUNT(*) AS customers, {avg_expr('days', 2, 'duck')} AS avg_days,
               CAST(bucket_start AS VARCHAR) || '-' || CAST(bucket_start + {SHORT_BUCKET_DAYS} - 1 AS VARCHAR)
                 || ' days' AS bucket
        FROM (SELECT days, CAST(floor(days / {SHORT_BUCKET_DAYS}) * {SHORT_BUCKET_DAYS} AS INTEGER) AS bucket_start
              FROM {_UPD} u) b GROUP BY bucket_start""")
_reg("B12_downgrades", lambda sp, d: downgrades(_s(sp, d)),
     f"""SELECT COUNT(DISTINCT customer_id) AS customers FROM sub_next
        WHERE plan_id = 2 AND next_plan = 1 AND next_date >= DATE '{YEAR_START}'
          AND next_date < DATE '{YEAR_END}'""", SN)
_reg("B13_payment_schedule", lambda sp, d: payments(*_sp(sp, d)), payment_schedule_sql(PAYMENT_CAP))
_reg("B14_weekly_growth", lambda sp, d: growth(_s(sp, d), "week"),
     f"""SELECT *, CASE WHEN growth >= {BIG_STEP} THEN '{UP2}' WHEN growth <= -{BIG_STEP} THEN '{DOWN2}'
                        WHEN growth > 0 THEN '{UP}' WHEN growth < 0 THEN '{DOWN}' ELSE '{FLAT}' END AS trend
        FROM (SELECT week_start, customers, LAG(customers) OVER (ORDER BY week_start) AS previous,
                     customers - LAG(customers) OVER (ORDER BY week_start) AS growth
              FROM (SELECT {WEEK} AS week_start, COUNT(*) AS customers FROM subscriptions GROUP BY 1) a) b""")
_reg("B15_retained_per_week", lambda sp, d: retained(_s(sp, d), "week"),
     f"""SELECT {WEEK} AS week_start, COUNT(*) AS retained FROM sub_next
        WHERE plan_id = 0 AND next_plan <> 4 GROUP BY 1""", SN)
_reg("B15b_churned_per_week", lambda sp, d: churned(_s(sp, d), "week"),
     f"SELECT {WEEK} AS week_start, COUNT(*) AS churned FROM sub_next WHERE next_plan = 4 GROUP BY 1", SN)
_reg("B15c_churn_by_previous_plan", lambda sp, d: churn_by_previous_plan(_s(sp, d)),
     "SELECT plan_id, COUNT(*) AS churn_counts FROM sub_next WHERE next_plan = 4 GROUP BY plan_id", SN)
_reg("B16_paid_journey", lambda sp, d: paid_journey(*_sp(sp, d)),
     """SELECT customer_id, plan_id, plan_name, start_date,
               LEAD(plan_id) OVER (PARTITION BY customer_id ORDER BY start_date, plan_id) AS next_plan
        FROM subscriptions JOIN plans USING (plan_id) WHERE plan_id > 0""")
_reg("B16b_churn_rows", lambda sp, d: churn_rows(_s(sp, d)),
     "SELECT COUNT(*) AS churn_rows FROM subscriptions WHERE plan_id = 4")

_reg("B16c_O7_sampled_subset", lambda sp, d: sampled_subscriptions(_s(sp, d)),
     f"""SELECT customer_id, plan_id, start_date FROM subscriptions
        ORDER BY md5(concat_ws('|', '0', customer_id, plan_id, start_date)) LIMIT {SAMPLE_ROWS}""")


# the same by month, over the seven years of orders
def _os(sp, d):
    return S.sub_order_subscriptions(sp, d)


VIEWS["order_sub_next"] = """
SELECT *, LEAD(plan_id) OVER w AS next_plan, LEAD(start_date) OVER w AS next_date
FROM order_subscriptions WINDOW w AS (PARTITION BY customer_id ORDER BY start_date, plan_id)"""
MONTH = "CAST(date_trunc('month', start_date) AS DATE)"
OS = "order_subscriptions"
OSN = "order_subscriptions order_sub_next"
_reg("B2d_trial_starts_per_month", lambda sp, d: trial_starts(_os(sp, d)),
     f"""SELECT month_start, trial_starts, strftime(month_start, '%B') AS month_name FROM (
          SELECT {MONTH} AS month_start, COUNT(*) AS trial_starts FROM order_subscriptions
          WHERE plan_id = 0 GROUP BY 1) t""", OS)
_reg("B11b_days_to_annual_30_day_buckets", lambda sp, d: days_to_annual_buckets(_os(sp, d)),
     f"""SELECT bucket_start, COUNT(*) AS customers,
               CAST(round(CAST(sum(days) AS DOUBLE) / count(*), 2) AS DECIMAL(38,2)) AS avg_days,
               CAST(bucket_start AS VARCHAR) || '-' || CAST(bucket_start + 29 AS VARCHAR) || ' days' AS bucket
        FROM (SELECT days, CAST(days // 30 * 30 AS INTEGER) AS bucket_start FROM (
          SELECT CAST(MIN(CASE WHEN plan_id = 3 THEN start_date END)
                      - MIN(CASE WHEN plan_id = 0 THEN start_date END) AS INTEGER) AS days
          FROM order_subscriptions GROUP BY customer_id) g WHERE days > 0) b GROUP BY bucket_start""", OS)
_reg("B14b_monthly_growth", lambda sp, d: growth(_os(sp, d)),
     f"""SELECT month_start, customers, previous, customers - previous AS growth,
               CASE WHEN customers - previous >= {BIG_STEP} THEN '{UP2}'
                    WHEN customers - previous <= -{BIG_STEP} THEN '{DOWN2}'
                    WHEN customers > previous THEN '{UP}' WHEN customers < previous THEN '{DOWN}'
                    ELSE '{FLAT}' END AS trend
        FROM (SELECT month_start, customers, LAG(customers) OVER (ORDER BY month_start) AS previous
              FROM (SELECT {MONTH} AS month_start, COUNT(*) AS customers FROM order_subscriptions GROUP BY 1) a) b""", OS)
_reg("B15d_retained_per_month", lambda sp, d: retained(_os(sp, d)),
     f"""SELECT {MONTH} AS month_start, COUNT(*) AS retained FROM order_sub_next
        WHERE plan_id = 0 AND next_plan <> 4 GROUP BY 1""", OSN)
_reg("B15e_churned_per_month", lambda sp, d: churned(_os(sp, d)),
     f"SELECT {MONTH} AS month_start, COUNT(*) AS churned FROM order_sub_next WHERE next_plan = 4 GROUP BY 1", OSN)
_reg("B4b_churn_rate_orders", lambda sp, d: churn_rate(_os(sp, d)),
     """SELECT COUNT(DISTINCT customer_id) FILTER (WHERE plan_id = 4) AS churned_customers,
               ROUND(100.0 * COUNT(DISTINCT customer_id) FILTER (WHERE plan_id = 4)
                     / COUNT(DISTINCT customer_id), 1) AS churn_pct
        FROM order_subscriptions""", OS)
