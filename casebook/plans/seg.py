"""Interest segments: month cleaning, coverage, composition rankings, rolling leader."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from casebook.functions.numeric import avg_expr, exact_avg, ratio_expr
from casebook.operators import first_rows, top_n, top_per_group, top_values
from casebook.operators.neighbours import over_all
from casebook.operators.reconcile import keys_missing, reconcile_summary
from casebook.sources import subjects as S
from casebook.sources.io import materialize_once
from casebook.sources.subjects_sql import VIEWS, with_views

MIN_MONTHS = 6                   # interests seen in fewer months are removed
CHECK_INTEREST = "blue bolt"     # the single interest inspected by G4b

QUERIES: dict = {}
ORACLE: dict = {}

# composition / index_value, both 2-decimal measures, rounded half up exactly
_CENTS = "CAST(ROUND({c} * 100) AS BIGINT)"
AVG_COMP_SPARK = ratio_expr(_CENTS.format(c="composition"), _CENTS.format(c="index_value"), 2, "spark")
AVG_COMP_DUCK = ratio_expr(_CENTS.format(c="composition"), _CENTS.format(c="index_value"), 2, "duck")


def clean_metrics(raw: DataFrame) -> DataFrame:
    """Retype text columns (S10/F17) and drop rows without a month."""
    return (raw.select(
        F.col("_month").try_cast("int").alias("_month"), F.col("_year").try_cast("int").alias("_year"),
        F.try_to_date(F.concat(F.lit("01-"), F.col("month_year")), "dd-MM-yyyy").alias("month_year"),
        F.col("interest_id").try_cast("int").alias("interest_id"),
        "composition", "index_value", "ranking", "percentile_ranking"))


def records_per_month(m: DataFrame) -> DataFrame:
    return (m.groupBy("month_year").agg(F.count(F.lit(1)).alias("records"))
             .orderBy(F.col("month_year").asc_nulls_first()))


def without_null_months(m: DataFrame) -> DataFrame:
    return m.filter(F.col("month_year").isNotNull())


def null_month_rows(m: DataFrame) -> DataFrame:
    """Rows without a month, before and after they are removed."""
    left = without_null_months(m).agg(F.count_if(F.col("month_year").isNull())).scalar()
    return m.agg(F.count_if(F.col("month_year").isNull()).alias("null_rows")).withColumn("null_rows_left", left)


def map_count(imap: DataFrame) -> DataFrame:
    return imap.agg(F.count("id").alias("total_ids"))


def one_interest(m: DataFrame, imap: DataFrame, name: str = CHECK_INTEREST) -> DataFrame:
    j = without_null_months(m).join(imap, m.interest_id == imap.id)
    return j.filter(F.col("interest_name") == name).drop("id")


def dated_before_creation(m: DataFrame, imap: DataFrame) -> DataFrame:
    j = without_null_months(m).join(imap, m.interest_id == imap.id, "left")
    return (j.filter(F.col("month_year").cast("timestamp_ntz") < F.col("created_at"))
             .select("interest_id", "interest_name", "month_year", "created_at"))


def month_counts(m: DataFrame) -> DataFrame:
    return without_null_months(m).groupBy("interest_id").agg(
        F.count_distinct("month_year").alias("mon_cnt"))


def present_all_months(m: DataFrame, imap: DataFrame) -> DataFrame:
    """Relational division: interests whose month count equals all months."""
    mm = without_null_months(m)
    total = mm.agg(F.count_distinct("month_year")).scalar()
    c = month_counts(m).filter(F.col("mon_cnt") == total)
    return c.join(imap, c.interest_id == imap.id).select("interest_id", "interest_name")


def cumulative_month_share(m: DataFrame, threshold: float = 90.0) -> DataFrame:
    g = month_counts(m).groupBy("mon_cnt").agg(F.count(F.lit(1)).alias("total_ids"))
    # one row per distinct month count (bounded by the calendar): a global window is fine
    cum = F.sum("total_ids").over(W.orderBy(F.desc("mon_cnt")).rowsBetween(W.unboundedPreceding, 0))
    tot = F.sum("total_ids").over(W.partitionBy())
    r = g.withColumn("cum_pct", F.round(F.lit(100.0) * cum / tot, 2))
    return r.filter(F.col("cum_pct") >= threshold)


def removal_volume(m: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    few = month_counts(m).filter(F.col("mon_cnt") < min_months).select("interest_id")
    rows = without_null_months(m).join(few, "interest_id", "left_semi")
    return few.agg(F.count(F.lit(1)).alias("interests_below")).withColumn(
        "rows_removed", rows.agg(F.count(F.lit(1))).scalar())


def filtered_metrics(m: DataFrame, min_months: int = MIN_MONTHS) -> DataFrame:
    few = month_counts(m).filter(F.col("mon_cnt") < min_months).select("interest_id")
    return without_null_months(m).join(few, "interest_id", "left_anti")


def interests_per_month_before_after(m: DataFrame) -> DataFrame:
    b = without_null_months(m).groupBy("month_year").agg(F.count_distinct("interest_id").alias("before"))
    a = filtered_metrics(m).groupBy("month_year").agg(F.count_distinct("interest_id").alias("after"))
    return b.join(a, "month_year", "left")


def max_composition(m: DataFrame, imap: DataFrame) -> DataFrame:
    f = filtered_metrics(m)
    g = f.groupBy("interest_id").agg(
        F.max("composition").alias("max_comp"),
        F.max_by("month_year", F.struct("composition", "month_year")).alias("month_year"))
    return g.join(imap, g.interest_id == imap.id).select("interest_id", "interest_name", "month_year",
                                                         "max_comp")


def top_max_composition(m, imap, desc=True, n=10):
    o = [F.desc("max_comp") if desc else F.asc("max_comp"), F.asc("interest_id")]
    return top_n(max_composition(m, imap), o, n)


def month_leader(m: DataFrame, imap: DataFrame) -> DataFrame:
    j = without_null_months(m).join(imap, m.interest_id == imap.id)
    return top_per_group(j, "month_year", [F.desc("composition"), F.asc("interest_name")], 1, "row_number") \
        .select("month_year", F.col("interest_name").alias("max_comp_interest"), "composition")


def lowest_mean_rank(m: DataFrame, imap: DataFrame, n: int = 5) -> DataFrame:
    a = filtered_metrics(m).groupBy("interest_id").agg(exact_avg("ranking", 1).alias("avg_rank"))
    r = top_values(a, "avg_rank", n)
    return r.join(imap, r.interest_id == imap.id).select("interest_id", "interest_name", "avg_rank")


def most_variable(m: DataFrame, imap: DataFrame, n: int = 5) -> DataFrame:
    a = filtered_metrics(m).groupBy("interest_id").agg(
        F.round(F.stddev_samp("percentile_ranking"), 2).alias("std_dev"),
        F.min("percentile_ranking").alias("min_per_rnk"), F.max("percentile_ranking").alias("max_per_rnk"))
    r = top_values(a, "std_dev", n, desc=True)
    return r.join(imap, r.interest_id == imap.id).select("interest_id", "interest_name", "std_dev",
                                                         "min_per_rnk", "max_per_rnk")


def avg_comp_table(m: DataFrame, imap: DataFrame) -> DataFrame:
    f = filtered_metrics(m)
    return (f.join(imap, f.interest_id == imap.id)
             .select("_month", "_year", "month_year", "interest_id", "interest_name", "composition",
                     "index_value", "ranking", "percentile_ranking",
                     F.expr(AVG_COMP_SPARK).cast("decimal(10,2)").alias("avg_comp")))


def top10_per_month(m, imap):
    a = avg_comp_table(m, imap)
    return top_per_group(a, "month_year", [F.desc("avg_comp")], 10, "dense_rank", out="rnk") \
        .select("month_year", "interest_id", "interest_name", "avg_comp", F.col("rnk").cast("int"))


def most_frequent_in_top10(m, imap):
    c = top10_per_month(m, imap).groupBy("interest_name").agg(F.count(F.lit(1)).alias("cnt"))
    return first_rows(c, [], "cnt", desc=True)


def top10_monthly_mean(m, imap):
    return top10_per_month(m, imap).groupBy("month_year").agg(exact_avg("avg_comp").alias("avg_of_top10"))


def rolling_leader(m, imap):
    """Monthly leader by avg_comp, its 3-month moving mean, and the two
    previous leaders; months are few (calendar), so a global window is fine."""
    a = avg_comp_table(m, imap)
    lead = a.groupBy("month_year").agg(F.max("avg_comp").alias("max_avg_comp"))
    names = (a.join(lead, "month_year").filter(F.col("avg_comp") == F.col("max_avg_comp"))
              .groupBy("month_year").agg(F.min("interest_name").alias("interest_name")))
    t = lead.join(names, "month_year")
    label = F.concat(F.col("interest_name"), F.lit(": "), F.col("max_avg_comp").cast("string"))
    t = over_all(t.withColumn("_label", label), "month_year", {
        "_s3": lambda w: F.sum("max_avg_comp").over(w.rowsBetween(-2, 0)), "one_month_ago": lambda w: F.lag("_label", 1).over(w),
        "two_months_ago": lambda w: F.lag("_label", 2).over(w)}, back=2, stage="month_leaders")
    return (t.filter(F.col("two_months_ago").isNotNull())
             .select("month_year", "interest_name", "max_avg_comp",
                     F.expr(ratio_expr("_s3", "3")).alias("moving_avg_3m"),
                     "one_month_ago", "two_months_ago"))


# ---- registry -----------------------------------------------------------------
def _m(sp, d):
    """Cleaned monthly metrics (months x interests rows), staged once per input and session."""
    return materialize_once(sp, "interest_metrics_clean", d, lambda: clean_metrics(S.seg_interest_metrics(sp, d)))


def _mi(sp, d):
    return _m(sp, d), materialize_once(sp, "interest_map", d, lambda: S.seg_interest_map(sp, d))


VIEWS["clean_metrics"] = """
SELECT TRY_CAST(_month AS INTEGER) AS _month, TRY_CAST(_year AS INTEGER) AS _year,
       CAST(try_strptime('01-' || month_year, '%d-%m-%Y') AS DATE) AS month_year,
       TRY_CAST(interest_id AS INTEGER) AS interest_id,
       composition, index_value, ranking, percentile_ranking
FROM interest_metrics"""
VIEWS["month_counts"] = """
SELECT interest_id, COUNT(DISTINCT month_year) AS mon_cnt FROM clean_metrics
WHERE month_year IS NOT NULL GROUP BY interest_id"""
VIEWS["filtered_metrics"] = f"""
SELECT * FROM clean_metrics WHERE month_year IS NOT NULL AND interest_id NOT IN
  (SELECT interest_id FROM month_counts WHERE mon_cnt < {MIN_MONTHS})"""
VIEWS["avg_comp_table"] = f"""
SELECT _month, _year, month_year, interest_id, interest_name, composition, index_value, ranking,
       percentile_ranking, CAST({AVG_COMP_DUCK} AS DECIMAL(10,2)) AS avg_comp
FROM filtered_metrics f JOIN interest_map im ON f.interest_id = im.id"""
VIEWS["top10"] = """
SELECT month_year, interest_id, interest_name, avg_comp, rnk FROM (
  SELECT *, CAST(DENSE_RANK() OVER (PARTITION BY month_year ORDER BY avg_comp DESC) AS INTEGER) AS rnk
  FROM avg_comp_table) t WHERE rnk <= 10"""
BASE = "interest_ids interest_map interest_metrics clean_metrics"
FILT = BASE + " month_counts filtered_metrics"
ACT = FILT + " avg_comp_table"


def _reg(name, fn, sql, views=BASE):
    QUERIES[name] = fn
    ORACLE[name] = with_views(sql, views)


_reg("G1_clean_metrics", _m, "SELECT * FROM clean_metrics")
_reg("G2_records_per_month", lambda sp, d: records_per_month(_m(sp, d)),
     "SELECT month_year, COUNT(*) AS records FROM clean_metrics GROUP BY month_year")
_reg("G2b_null_months_removed", lambda sp, d: null_month_rows(_m(sp, d)),
     "SELECT COUNT(*) FILTER (WHERE month_year IS NULL) AS null_rows, "
     "(SELECT COUNT(*) FROM clean_metrics WHERE month_year IS NULL AND month_year IS NOT NULL) AS null_rows_left "
     "FROM clean_metrics")
_reg("G3_ids_not_in_map",
     lambda sp, d: keys_missing(_m(sp, d).select("interest_id"), S.seg_interest_map(sp, d).select(
         F.col("id").alias("interest_id")), "interest_id"),
     "SELECT interest_id FROM clean_metrics EXCEPT SELECT id FROM interest_map")
_reg("G3b_ids_not_in_metrics",
     lambda sp, d: keys_missing(S.seg_interest_map(sp, d).select("id"), _m(sp, d).select(
         F.col("interest_id").alias("id")), "id"),
     "SELECT id FROM interest_map EXCEPT SELECT interest_id FROM clean_metrics")
_reg("G3c_reconcile_summary",
     lambda sp, d: reconcile_summary(_m(sp, d).select(F.col("interest_id").alias("k")),
                                     S.seg_interest_map(sp, d).select(F.col("id").alias("k")), "k",
                                     "total_not_in_map", "total_not_in_metric"),
     """SELECT CAST(COALESCE(SUM(CASE WHEN id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS total_not_in_map,
               CAST(COALESCE(SUM(CASE WHEN interest_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT)
                 AS total_not_in_metric
        FROM (SELECT DISTINCT id, interest_id FROM interest_map a
              FULL JOIN clean_metrics b ON b.interest_id = a.id
              WHERE b.interest_id IS NULL OR a.id IS NULL) t""")
_reg("G4_map_count", lambda sp, d: map_count(S.seg_interest_map(sp, d)),
     "SELECT COUNT(id) AS total_ids FROM interest_map", "interest_ids interest_map")
_reg("G4b_one_interest_joined", lambda sp, d: one_interest(*_mi(sp, d)),
     f"""SELECT a.*, interest_name, interest_summary, created_at, last_modified
        FROM clean_metrics a JOIN interest_map b ON a.interest_id = b.id
        WHERE a.month_year IS NOT NULL AND interest_name = '{CHECK_INTEREST}'""")
_reg("G5_dated_before_creation", lambda sp, d: dated_before_creation(*_mi(sp, d)),
     """SELECT interest_id, interest_name, month_year, created_at
        FROM clean_metrics a LEFT JOIN interest_map b ON a.interest_id = b.id
        WHERE a.month_year IS NOT NULL AND CAST(month_year AS TIMESTAMP) < created_at""")
_reg("G6_present_all_months", lambda sp, d: present_all_months(*_mi(sp, d)),
     """SELECT interest_id, interest_name FROM month_counts c JOIN interest_map im ON c.interest_id = im.id
        WHERE mon_cnt = (SELECT COUNT(DISTINCT month_year) FROM clean_metrics
                         WHERE month_year IS NOT NULL)""", BASE + " month_counts")
_reg("G7_cumulative_month_share", lambda sp, d: cumulative_month_share(_m(sp, d)),
     """SELECT * FROM (SELECT mon_cnt, COUNT(*) AS total_ids,
                   ROUND(100.0 * SUM(COUNT(*)) OVER (ORDER BY mon_cnt DESC
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                         / SUM(COUNT(*)) OVER (), 2) AS cum_pct
                   FROM month_counts GROUP BY mon_cnt) t WHERE cum_pct >= 90""", BASE + " month_counts")
_reg("G8_removal_volume", lambda sp, d: removal_volume(_m(sp, d)),
     f"""SELECT (SELECT COUNT(*) FROM month_counts WHERE mon_cnt < {MIN_MONTHS}) AS interests_below,
               (SELECT COUNT(*) FROM clean_metrics WHERE month_year IS NOT NULL AND interest_id IN
                  (SELECT interest_id FROM month_counts WHERE mon_cnt < {MIN_MONTHS})) AS rows_removed""",
     BASE + " month_counts")
_reg("G9_filtered_metrics", lambda sp, d: filtered_metrics(_m(sp, d)), "SELECT * FROM filtered_metrics", FILT)
_reg("G9b_interests_per_month_before_after", lambda sp, d: interests_per_month_before_after(_m(sp, d)),
     """SELECT b.month_year, b.before, a.after FROM
          (SELECT month_year, COUNT(DISTINCT interest_id) AS before FROM clean_metrics
           WHERE month_year IS NOT NULL GROUP BY 1) b
        LEFT JOIN (SELECT month_year, COUNT(DISTINCT interest_id) AS after FROM filtered_metrics
                   GROUP BY 1) a ON a.month_year = b.month_year""", FILT)
_MAXC = """(SELECT interest_id, interest_name, month_year, max_comp FROM (
             SELECT interest_id, month_year, composition AS max_comp,
                    ROW_NUMBER() OVER (PARTITION BY interest_id
                                       ORDER BY composition DESC, month_year DESC) AS rn
             FROM filtered_metrics) t JOIN interest_map im ON t.interest_id = im.id WHERE rn = 1)"""
_reg("G10_max_composition", lambda sp, d: max_composition(*_mi(sp, d)), f"SELECT * FROM {_MAXC} x", FILT)
_reg("G10b_top10_max_composition", lambda sp, d: top_max_composition(*_mi(sp, d), desc=True),
     f"SELECT * FROM {_MAXC} x ORDER BY max_comp DESC, interest_id LIMIT 10", FILT)
_reg("G10c_bottom10_max_composition", lambda sp, d: top_max_composition(*_mi(sp, d), desc=False),
     f"SELECT * FROM {_MAXC} x ORDER BY max_comp, interest_id LIMIT 10", FILT)
_reg("G11_month_leader", lambda sp, d: month_leader(*_mi(sp, d)),
     """SELECT month_year, interest_name AS max_comp_interest, composition FROM (
          SELECT month_year, interest_name, composition,
                 ROW_NUMBER() OVER (PARTITION BY month_year ORDER BY composition DESC, interest_name) AS rn
          FROM clean_metrics a JOIN interest_map b ON a.interest_id = b.id
          WHERE month_year IS NOT NULL) t WHERE rn = 1""")
_reg("G12_lowest_mean_rank", lambda sp, d: lowest_mean_rank(*_mi(sp, d)),
     f"""SELECT interest_id, interest_name, avg_rank FROM (
          SELECT interest_id, avg_rank, DENSE_RANK() OVER (ORDER BY avg_rank) AS rnk FROM (
            SELECT interest_id, {avg_expr('ranking', 1, 'duck')} AS avg_rank FROM filtered_metrics
            GROUP BY interest_id) a) r JOIN interest_map im ON r.interest_id = im.id WHERE rnk <= 5""", FILT)
_reg("G13_most_variable", lambda sp, d: most_variable(*_mi(sp, d)),
     """SELECT interest_id, interest_name, std_dev, min_per_rnk, max_per_rnk FROM (
          SELECT *, DENSE_RANK() OVER (ORDER BY std_dev DESC) AS rnk FROM (
            SELECT interest_id, ROUND(STDDEV_SAMP(percentile_ranking), 2) AS std_dev,
                   MIN(percentile_ranking) AS min_per_rnk, MAX(percentile_ranking) AS max_per_rnk
            FROM filtered_metrics GROUP BY interest_id) a) r
        JOIN interest_map im ON r.interest_id = im.id WHERE rnk <= 5""", FILT)
_reg("G14_avg_comp_table", lambda sp, d: avg_comp_table(*_mi(sp, d)), "SELECT * FROM avg_comp_table", ACT)
_reg("G15_top10_per_month", lambda sp, d: top10_per_month(*_mi(sp, d)), "SELECT * FROM top10", ACT + " top10")
_reg("G15b_most_frequent_in_top10", lambda sp, d: most_frequent_in_top10(*_mi(sp, d)),
     """WITH c AS (SELECT interest_name, COUNT(*) AS cnt FROM top10 GROUP BY interest_name)
        SELECT * FROM c WHERE cnt = (SELECT MAX(cnt) FROM c)""", ACT + " top10")
_reg("G15c_top10_monthly_mean", lambda sp, d: top10_monthly_mean(*_mi(sp, d)),
     f"SELECT month_year, {avg_expr('avg_comp', 2, 'duck')} AS avg_of_top10 FROM top10 GROUP BY month_year",
     ACT + " top10")
_reg("G16_rolling_leader", lambda sp, d: rolling_leader(*_mi(sp, d)),
     f"""WITH l AS (SELECT month_year, MAX(avg_comp) AS max_avg_comp FROM avg_comp_table GROUP BY 1),
             n AS (SELECT a.month_year, MIN(interest_name) AS interest_name FROM avg_comp_table a
                   JOIN l ON a.month_year = l.month_year AND a.avg_comp = l.max_avg_comp GROUP BY 1),
             t AS (SELECT l.month_year, interest_name, max_avg_comp,
                          SUM(max_avg_comp) OVER (ORDER BY l.month_year ROWS BETWEEN 2 PRECEDING
                                                  AND CURRENT ROW) AS _s3,
                          LAG(interest_name || ': ' || CAST(max_avg_comp AS VARCHAR), 1)
                            OVER (ORDER BY l.month_year) AS one_month_ago,
                          LAG(interest_name || ': ' || CAST(max_avg_comp AS VARCHAR), 2)
                            OVER (ORDER BY l.month_year) AS two_months_ago
                   FROM l JOIN n ON l.month_year = n.month_year)
        SELECT month_year, interest_name, max_avg_comp,
               {ratio_expr('_s3', '3', 2, 'duck')} AS moving_avg_3m, one_month_ago, two_months_ago
        FROM t WHERE two_months_ago IS NOT NULL""", ACT)
