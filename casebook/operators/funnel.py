"""Visit funnels: views, cart adds, abandoned and purchased cart adds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casebook.operators.broadcast import broadcast_if_small

VIEW, CART, PURCHASE, IMPRESSION, CLICK = 1, 2, 3, 4, 5


def last_event(events: DataFrame) -> DataFrame:
    """Last event code per visit by (time, id): an aggregate, combined map-side."""
    return events.groupBy("visit_id").agg(
        F.max_by("event_type", F.struct("event_time", "event_id")).alias("last_event"))


def funnel(events: DataFrame, pages: DataFrame, by) -> DataFrame:
    """Per ``by`` (product or category columns, or a visit attribute):
    viewed, added_to_cart, abandoned (cart add in a visit not ending in a
    purchase), purchased (cart add in a visit ending in a purchase). Counts
    with no matching event are NULL, as SUM(CASE ... ELSE NULL) gives.
    ``pages`` is the page dimension (a fixed, small table) and is broadcast.
    """
    by = [by] if isinstance(by, str) else list(by)
    e = (events.join(last_event(events), "visit_id")
               .join(broadcast_if_small(pages), "page_id")
               .filter(F.col("product_category").isNotNull()))
    t, last = F.col("event_type"), F.col("last_event")
    one = F.lit(1).cast("bigint")
    return e.groupBy(*by).agg(
        F.sum(F.when(t == VIEW, one)).alias("viewed"),
        F.sum(F.when(t == CART, one)).alias("added_to_cart"),
        F.sum(F.when((t == CART) & (last != PURCHASE), one)).alias("abandoned"),
        F.sum(F.when((t == CART) & (last == PURCHASE), one)).alias("purchased"))


def funnel_sql(events: str, by) -> str:
    by = [by] if isinstance(by, str) else list(by)
    b = ", ".join(by)
    return f"""SELECT {b},
       CAST(SUM(CASE WHEN event_type = 1 THEN 1 END) AS BIGINT) AS viewed,
       CAST(SUM(CASE WHEN event_type = 2 THEN 1 END) AS BIGINT) AS added_to_cart,
       CAST(SUM(CASE WHEN event_type = 2 AND last_event <> 3 THEN 1 END) AS BIGINT) AS abandoned,
       CAST(SUM(CASE WHEN event_type = 2 AND last_event = 3 THEN 1 END) AS BIGINT) AS purchased
FROM (SELECT e.*, p.page_name, p.product_id, p.product_category,
             FIRST_VALUE(e.event_type) OVER (PARTITION BY e.visit_id
                                             ORDER BY e.sequence_number DESC) AS last_event
      FROM {events} e JOIN page_hierarchy p USING (page_id)) x
WHERE product_category IS NOT NULL
GROUP BY {b}"""
