"""Reference-style SQL over the registered subject views gives the DataFrame results."""

import __spark_entry__ as E
from casebook.sources.views import register_subject_views
from tests.conftest import SMALL, rows


def test_views_cover_every_area(spark):
    names = register_subject_views(spark, SMALL)
    assert {n.split("_", 1)[0] for n in names} == {"ret", "dlv", "sub", "bnk", "wks", "clk", "clo", "seg"}


def test_reference_style_sql_matches(spark):
    register_subject_views(spark, SMALL, areas={"ret", "bnk", "sub"})
    spend = spark.sql("""SELECT customer_id, CAST(SUM(price) AS DECIMAL(38,2)) AS total_spent
                         FROM ret_sales JOIN ret_menu USING (product_id) GROUP BY customer_id""")
    assert rows(spend) == rows(E.queries()["R1_spend_per_customer"](spark, SMALL))
    mix = spark.sql("""SELECT txn_type, COUNT(*) AS unique_count,
                              CAST(SUM(txn_amount) AS DECIMAL(38,2)) AS total_amount
                       FROM bnk_customer_transactions GROUP BY txn_type""")
    assert rows(mix) == rows(E.queries()["K4_txn_type_summary"](spark, SMALL))
    churn = spark.sql("SELECT COUNT(*) FROM sub_subscriptions WHERE plan_id = 4").first()[0]
    assert churn == E.queries()["B16b_churn_rows"](spark, SMALL).first()[0]
