"""SQL twins of ``casebook.sources.subjects`` for the DuckDB oracle.

Plain ANSI SQL over the stored tables; each entry is one derived view.
``with_views(body, names)`` prefixes a query with the views it needs.
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

# ---- retail loyalty ---------------------------------------------------------
VIEWS["sales"] = """
SELECT o.o_custkey AS customer_id, CAST(o.o_orderdate AS DATE) AS order_date,
       l.l_partkey AS product_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
VIEWS["menu"] = """
SELECT p_partkey AS product_id, p_name AS product_name,
       CAST(p_retailprice AS DECIMAL(18,2)) AS price
FROM part"""
VIEWS["members"] = """
SELECT c_custkey AS customer_id,
       CAST(DATE '1997-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS join_date
FROM customer WHERE c_custkey % 2 = 0"""


def with_views(body: str, names) -> str:
    names = names.split() if isinstance(names, str) else list(names)
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]}\n)" for n in names)
    b = body.strip()
    if b[:15].upper() == "WITH RECURSIVE ":
        return f"WITH RECURSIVE {ctes},\n{b[15:]}"
    if b[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{b[5:]}"
    return f"WITH {ctes}\n{b}"

# ---- bank -------------------------------------------------------------------
VIEWS["regions"] = "SELECT r_regionkey AS region_id, r_name AS region_name FROM region"
VIEWS["customer_transactions"] = """
SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS txn_date,
       CASE o_orderstatus WHEN 'F' THEN 'deposit' WHEN 'O' THEN 'purchase'
                          WHEN 'P' THEN 'withdrawal' END AS txn_type,
       CAST(o_totalprice AS DECIMAL(18,2)) AS txn_amount
FROM orders"""
VIEWS["customer_nodes"] = """
SELECT d.customer_id, n.n_regionkey AS region_id, CAST(d.k % 5 + 1 AS INTEGER) AS node_id,
       d.start_date,
       COALESCE(LEAD(d.start_date) OVER (PARTITION BY d.customer_id ORDER BY d.start_date),
                DATE '9999-12-31') AS end_date
FROM (SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS start_date,
             MIN(o_orderkey) AS k
      FROM orders GROUP BY 1, 2) d
JOIN customer c ON c.c_custkey = d.customer_id
JOIN nation n ON n.n_nationkey = c.c_nationkey"""

# ---- clothing sales -----------------------------------------------------------
VIEWS["clo_sales"] = """
SELECT l.l_partkey AS prod_id, CAST(l.l_quantity AS INTEGER) AS qty,
       CAST(p.p_retailprice AS DECIMAL(18,2)) AS price,
       CAST(ROUND(l.l_discount * 100) AS INTEGER) AS discount,
       (o.o_custkey % 2 = 0) AS member, l.l_orderkey AS txn_id,
       CAST(o.o_orderdate AS DATE) AS txn_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey"""
VIEWS["product_details"] = """
SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS category_name,
       p_type AS segment_name, CAST(p_retailprice AS DECIMAL(18,2)) AS price
FROM part"""
VIEWS["product_hierarchy"] = """
SELECT CAST(r_regionkey AS BIGINT) * 3 AS id, CAST(NULL AS BIGINT) AS parent_id,
       r_name AS level_text, 'Category' AS level_name FROM region
UNION ALL
SELECT CAST(n_nationkey AS BIGINT) * 3 + 1, CAST(n_regionkey AS BIGINT) * 3, n_name, 'Segment'
FROM nation
UNION ALL
SELECT CAST(c_custkey AS BIGINT) * 3 + 2, CAST(c_nationkey AS BIGINT) * 3 + 1, c_name, 'Style'
FROM customer"""
VIEWS["product_prices"] = """
SELECT c_custkey * 3 + 2 AS id, 'P' || CAST(c_custkey AS VARCHAR) AS product_id,
       CAST(c_acctbal AS DECIMAL(18,2)) AS price
FROM customer"""

# ---- weekly sales -------------------------------------------------------------
VIEWS["weekly_sales"] = """
SELECT strftime(CAST(date_trunc('week', o.o_orderdate) AS DATE), '%-d/%-m/%Y') AS week_date,
       r.r_name AS region,
       CASE WHEN o.o_orderstatus = 'P' THEN 'Shopify' ELSE 'Retail' END AS platform,
       CASE substring(o.o_orderpriority, 1, 1) WHEN '1' THEN 'C1' WHEN '2' THEN 'F2'
            WHEN '3' THEN 'C3' WHEN '4' THEN 'F4' WHEN '5' THEN 'null' END AS segment,
       CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'New' WHEN 'BUILDING' THEN 'New'
            WHEN 'HOUSEHOLD' THEN 'Existing' WHEN 'MACHINERY' THEN 'Existing'
            WHEN 'FURNITURE' THEN 'Guest' END AS customer_type,
       COUNT(*) AS transactions,
       CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sales
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
GROUP BY 1, 2, 3, 4, 5"""

# ---- clickstream --------------------------------------------------------------
VIEWS["clk_events"] = """
SELECT CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS visit_id,
       CAST(user_id AS VARCHAR) || '-' || CAST(weekofyear(ts) AS VARCHAR) AS cookie_id,
       user_id, CAST(event_id % 13 + 1 AS INTEGER) AS page_id,
       CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
                       WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS event_type,
       ts AS event_time, event_id,
       ROW_NUMBER() OVER (PARTITION BY CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d')
                          ORDER BY ts, event_id) AS sequence_number
FROM events"""
VIEWS["clk_users"] = "SELECT DISTINCT user_id, cookie_id FROM clk_events"
VIEWS["event_identifier"] = """
SELECT * FROM (VALUES (1, 'Page View'), (2, 'Add to Cart'), (3, 'Purchase'),
                      (4, 'Ad Impression'), (5, 'Ad Click')) t(event_type, event_name)"""
VIEWS["page_hierarchy"] = """
SELECT CAST(range AS INTEGER) AS page_id,
       CASE range WHEN 1 THEN 'Home Page' WHEN 2 THEN 'All Products' WHEN 12 THEN 'Checkout'
                  WHEN 13 THEN 'Confirmation' ELSE 'Product ' || CAST(range - 2 AS VARCHAR) END AS page_name,
       CASE WHEN range BETWEEN 3 AND 11
            THEN 'Category ' || CAST(CAST(floor((range - 3) / 3) + 1 AS BIGINT) AS VARCHAR) END
         AS product_category,
       CASE WHEN range BETWEEN 3 AND 11 THEN CAST(range - 2 AS INTEGER) END AS product_id
FROM range(1, 14)"""
VIEWS["campaign_identifier"] = """
SELECT * FROM (VALUES
  ('Campaign A', TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-09 23:59:59'),
  ('Campaign B', TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-19 23:59:59'),
  ('Campaign C', TIMESTAMP '2024-01-20 00:00:00', TIMESTAMP '2024-01-27 23:59:59'))
  t(campaign_name, start_date, end_date)"""

# ---- interest segments ------------------------------------------------------------
VIEWS["interest_ids"] = """
SELECT CAST(MIN(p_partkey) AS INTEGER) AS id, p_name AS interest_name FROM part GROUP BY p_name"""
VIEWS["interest_map"] = """
SELECT id, interest_name, 'Parts named ' || interest_name AS interest_summary,
       CAST(DATE '1996-01-01' + CAST(id % 1500 AS INTEGER) AS TIMESTAMP) AS created_at,
       CAST(DATE '1996-01-01' + CAST(id % 1500 AS INTEGER) + 30 AS TIMESTAMP) AS last_modified
FROM (SELECT id, interest_name FROM interest_ids WHERE id % 97 <> 0
      UNION ALL
      SELECT CAST(id + 1000000 AS INTEGER), interest_name || ' (retired)' FROM interest_ids WHERE id % 89 = 0) t"""
VIEWS["interest_metrics"] = """
SELECT CASE WHEN lost THEN 'NULL' ELSE CAST(month(m) AS VARCHAR) END AS _month,
       CASE WHEN lost THEN 'NULL' ELSE CAST(year(m) AS VARCHAR) END AS _year,
       CASE WHEN lost THEN 'NULL' ELSE strftime(m, '%m-%Y') END AS month_year, CAST(id AS VARCHAR) AS interest_id,
       composition, index_value, ranking, percentile_ranking
FROM (SELECT e.*, im.id, (im.id + month(m)) % 50 = 0 AS lost FROM (
      SELECT *, CAST(ROUND(100.0 * (n - ranking + 1) / n, 2) AS DOUBLE) AS percentile_ranking
      FROM (SELECT *, CAST(RANK() OVER (PARTITION BY m ORDER BY index_value DESC) AS INTEGER) AS ranking
            FROM (SELECT m, p_name, composition, COUNT(*) OVER (PARTITION BY m) AS n,
                         ROUND(CAST(CAST(composition AS DECIMAL(10,2)) * COUNT(*) OVER (PARTITION BY m)
                                    AS DOUBLE)
                               / CAST(SUM(CAST(composition AS DECIMAL(10,2))) OVER (PARTITION BY m)
                                      AS DOUBLE), 2) AS index_value
                  FROM (SELECT m, p_name,
                               ROUND(100.0 * qty / SUM(qty) OVER (PARTITION BY m), 2) AS composition
                        FROM (SELECT CAST(date_trunc('month', l.l_shipdate) AS DATE) AS m, p.p_name,
                                     SUM(l.l_quantity) AS qty
                              FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
                              GROUP BY 1, 2) a) b) c) d) e
      JOIN interest_ids im ON im.interest_name = e.p_name
      WHERE NOT (im.id % 23 = 5 AND m >= DATE '1992-06-01')) f"""

# ---- subscriptions ------------------------------------------------------------
VIEWS["plans"] = """
SELECT * FROM (VALUES (0, 'trial', CAST(0.00 AS DECIMAL(5,2))), (1, 'basic monthly', 9.90),
                      (2, 'pro monthly', 19.90), (3, 'pro annual', 199.00),
                      (4, 'churn', NULL)) t(plan_id, plan_name, price)"""
VIEWS["subscriptions"] = """
SELECT user_id AS customer_id,
       CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 WHEN 'signup' THEN 2
                       WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS plan_id,
       CAST(MIN(ts) AS DATE) AS start_date
FROM events GROUP BY 1, 2"""

VIEWS["order_subscriptions"] = """
SELECT o_custkey AS customer_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS plan_id,
       CAST(MIN(o_orderdate) AS DATE) AS start_date
FROM orders GROUP BY 1, 2"""

# ---- food delivery ----------------------------------------------------------------
VIEWS["runners"] = """
SELECT s_suppkey AS runner_id,
       CAST(DATE '1995-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS DATE) AS registration_date
FROM supplier"""
VIEWS["pizza_toppings"] = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY topping_name) AS INTEGER) AS topping_id, topping_name
FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS topping_name FROM part) w"""
VIEWS["pizza_names"] = "SELECT p_partkey AS pizza_id, p_name AS pizza_name FROM part"
VIEWS["pizza_recipes"] = """
SELECT pizza_id, string_agg(CAST(topping_id AS VARCHAR), ', ' ORDER BY topping_id) AS toppings
FROM (SELECT p_partkey AS pizza_id, unnest(string_split(p_name, ' ')) AS topping_name FROM part) w
JOIN pizza_toppings USING (topping_name) GROUP BY pizza_id"""
VIEWS["customer_orders_raw"] = """
SELECT l.l_orderkey AS order_id, o.o_custkey AS customer_id, l.l_partkey AS pizza_id,
       CASE l.l_linenumber % 4 WHEN 0 THEN '' WHEN 1 THEN 'null'
            WHEN 2 THEN CAST(l.l_partkey % 16 + 1 AS VARCHAR) END AS exclusions,
       CASE WHEN l.l_linenumber % 3 = 0
              THEN CAST(l.l_suppkey % 16 + 1 AS VARCHAR) || ', ' || CAST((l.l_suppkey + 5) % 16 + 1 AS VARCHAR)
            WHEN l.l_linenumber % 3 = 1 THEN CAST(l.l_suppkey % 16 + 1 AS VARCHAR)
            WHEN l.l_orderkey % 2 = 0 THEN '' END AS extras,
       o.o_orderdate + to_minutes(CAST((o.o_orderkey % 24) * 60 + o.o_orderkey % 60 AS BIGINT)) AS order_time
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""
VIEWS["runner_orders_raw"] = """
SELECT o.o_orderkey AS order_id, r.runner_id,
       CASE WHEN o.o_orderstatus = 'P' THEN 'null'
            WHEN o.o_orderkey % 227 = 0 THEN 'late'
            ELSE strftime(o.o_orderdate + to_minutes(CAST((o.o_orderkey % 24) * 60 + o.o_orderkey % 60
                                                           + 10 + o.o_orderkey % 20 AS BIGINT))
                          + to_seconds(o.o_orderkey * 7 % 60),
                          '%Y-%m-%d %H:%M:%S') END AS pickup_time,
       CASE WHEN o.o_orderstatus = 'P' THEN 'null'
            WHEN o.o_orderkey % 211 = 0 THEN 'unknown'
            WHEN o.o_orderkey % 4 = 0 THEN CAST(o.o_orderkey % 25 + 1 AS VARCHAR) || 'km'
            WHEN o.o_orderkey % 4 = 1 THEN CAST(o.o_orderkey % 25 + 1 AS VARCHAR) || '.4 km'
            WHEN o.o_orderkey % 4 = 2 THEN CAST(o.o_orderkey % 25 + 1 AS VARCHAR)
            ELSE CAST(o.o_orderkey % 25 + 1 AS VARCHAR) || ' km' END AS distance,
       CASE WHEN o.o_orderstatus = 'P' THEN 'null'
            WHEN o.o_orderkey % 223 = 0 THEN 'soon'
            WHEN o.o_orderkey % 3 = 0 THEN CAST(o.o_orderkey % 30 + 10 AS VARCHAR) || 'mins'
            WHEN o.o_orderkey % 3 = 1 THEN CAST(o.o_orderkey % 30 + 10 AS VARCHAR) || ' minute'
            ELSE CAST(o.o_orderkey % 30 + 10 AS VARCHAR) || ' minutes' END AS duration,
       CASE WHEN o.o_orderstatus = 'P' THEN
              CASE WHEN o.o_orderkey % 2 = 0 THEN 'Restaurant Cancellation' ELSE 'Customer Cancellation' END
            WHEN o.o_orderkey % 3 = 0 THEN '' WHEN o.o_orderkey % 3 = 1 THEN 'null' END AS cancellation
FROM orders o JOIN (SELECT l_orderkey, MIN(l_suppkey) AS runner_id FROM lineitem GROUP BY 1) r
  ON o.o_orderkey = r.l_orderkey"""
VIEWS["customer_orders"] = """
SELECT order_id, customer_id, pizza_id,
       CAST(string_split(NULLIF(NULLIF(trim(exclusions), ''), 'null'), ',') AS INTEGER[]) AS exclusions,
       CAST(string_split(NULLIF(NULLIF(trim(extras), ''), 'null'), ',') AS INTEGER[]) AS extras,
       order_time
FROM customer_orders_raw"""
VIEWS["runner_orders"] = """
SELECT order_id, runner_id,
       TRY_CAST(NULLIF(NULLIF(pickup_time, ''), 'null') AS TIMESTAMP) AS pickup_time,
       TRY_CAST(NULLIF(regexp_extract(distance, '[0-9]+(\\.[0-9]+)?', 0), '') AS DECIMAL(6,2)) AS distance,
       TRY_CAST(NULLIF(regexp_extract(duration, '[0-9]+', 0), '') AS INTEGER) AS duration,
       NULLIF(NULLIF(cancellation, ''), 'null') AS cancellation
FROM runner_orders_raw"""
