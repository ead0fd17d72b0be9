"""SQL access: the subject tables as temp views named after the reference's tables.

``register_subject_views(spark, sf_dir)`` registers, per area, views with the
table names the case studies use, prefixed by the area (``ret_sales``,
``dlv_runner_orders``, ``bnk_customer_transactions`` ...), so existing SQL
runs through ``spark.sql`` after the dialect notes of SURVEY section 1.3
(e.g. ``datediff`` for date - date, ``div`` for integer division). Views are
lazy: nothing is read until a query runs.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from casebook.sources import subjects as S


def _builders(spark: SparkSession, d: str) -> dict:
    from casebook.plans.dlv import clean_customer_orders, clean_runner_orders
    from casebook.plans.seg import clean_metrics
    from casebook.plans.wks import clean_weekly_sales
    return {
        "ret_sales": lambda: S.ret_sales(spark, d), "ret_menu": lambda: S.ret_menu(spark, d),
        "ret_members": lambda: S.ret_members(spark, d),
        "dlv_runners": lambda: S.dlv_runners(spark, d),
        "dlv_customer_orders_raw": lambda: S.dlv_customer_orders_raw(spark, d),
        "dlv_runner_orders_raw": lambda: S.dlv_runner_orders_raw(spark, d),
        "dlv_customer_orders": lambda: clean_customer_orders(S.dlv_customer_orders_raw(spark, d)),
        "dlv_runner_orders": lambda: clean_runner_orders(S.dlv_runner_orders_raw(spark, d)),
        "dlv_pizza_names": lambda: S.dlv_pizza_names(spark, d), "dlv_pizza_recipes": lambda: S.dlv_recipes(spark, d),
        "dlv_pizza_toppings": lambda: S.dlv_toppings(spark, d),
        "sub_plans": lambda: S.sub_plans(spark), "sub_subscriptions": lambda: S.sub_subscriptions(spark, d),
        "bnk_regions": lambda: S.bnk_regions(spark, d), "bnk_customer_nodes": lambda: S.bnk_nodes(spark, d),
        "bnk_customer_transactions": lambda: S.bnk_transactions(spark, d),
        "wks_weekly_sales": lambda: S.wks_weekly_sales(spark, d),
        "wks_clean_weekly_sales": lambda: clean_weekly_sales(S.wks_weekly_sales(spark, d)),
        "clk_events": lambda: S.clk_events(spark, d), "clk_users": lambda: S.clk_users(spark, d),
        "clk_event_identifier": lambda: S.clk_event_identifier(spark),
        "clk_page_hierarchy": lambda: S.clk_page_hierarchy(spark),
        "clk_campaign_identifier": lambda: S.clk_campaigns(spark),
        "clo_sales": lambda: S.clo_sales(spark, d), "clo_product_details": lambda: S.clo_products(spark, d),
        "clo_product_hierarchy": lambda: S.clo_hierarchy(spark, d),
        "clo_product_prices": lambda: S.clo_prices(spark, d),
        "seg_interest_metrics": lambda: S.seg_interest_metrics(spark, d),
        "seg_interest_map": lambda: S.seg_interest_map(spark, d),
        "seg_clean_interest_metrics": lambda: clean_metrics(S.seg_interest_metrics(spark, d)),
    }


def register_subject_views(spark: SparkSession, sf_dir: str, areas=None) -> list[str]:
    """Register the subject tables as temp views; returns the view names."""
    names = []
    for name, build in _builders(spark, sf_dir).items():
        if areas and name.split("_", 1)[0] not in areas:
            continue
        build().createOrReplaceTempView(name)
        names.append(name)
    return names
