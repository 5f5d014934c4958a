"""Oracles of the legacy query shapes."""

CUSTOMERS = """
c AS (
  SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 4 = 0 THEN c_name || '   ' ELSE c_name END AS name,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE n_name END AS region,
         TIMESTAMP '2020-01-15 08:00:00' + to_days(CAST(c_custkey % 900 AS INTEGER)) AS created_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
ORDERS = """
o AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'shipped'
              WHEN o_orderstatus = 'P' THEN 'paid' WHEN o_orderkey % 10 = 0 THEN 'cancelled' ELSE 'placed' END AS status,
         CAST(o_orderdate AS DATE) AS order_date, o_orderdate + to_seconds(o_orderkey % 86400) AS updated_at FROM orders)"""
LINES = """
l AS (
  SELECT l_orderkey AS order_id, l_partkey * 10 + l_linenumber AS line_no, CAST(floor(l_quantity) AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price FROM lineitem)"""
PAYMENTS = """
p AS (
  SELECT o_orderkey AS payment_id, CASE WHEN o_orderkey % 59 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS order_id,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
         CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INTEGER) END
           AS settled_date FROM orders WHERE o_totalprice >= 20000)"""


def over(*parts: str) -> str:
    return "WITH" + ",".join(parts) + "\n"


ORACLES = {
    "sql_isnull": over(ORDERS) + "SELECT order_id, coalesce(status, 'unknown') AS status FROM o",
    "sql_top_ordered": over(ORDERS) + "SELECT order_id, order_date FROM o ORDER BY order_date DESC, order_id DESC LIMIT 3",
    "sql_convert_date": over(ORDERS) + "SELECT CAST(updated_at AS DATE) AS update_day, count(*) AS n FROM o GROUP BY 1",
    "sql_dateadd": over(ORDERS) + "SELECT order_id, CAST(order_date + INTERVAL 30 DAY AS DATE) AS due_date FROM o",
    "sql_datediff_day": over(ORDERS, PAYMENTS) + """
SELECT o.order_id, payment_id, date_diff('day', order_date, settled_date) AS days_to_pay
FROM o JOIN p ON p.order_id = o.order_id""",
    "sql_datediff_month": over(CUSTOMERS) + """
SELECT customer_id, date_diff('month', created_at, TIMESTAMP '2026-11-01') AS months FROM c""",
    "sql_iif": over(PAYMENTS) + """
SELECT payment_id, CASE WHEN amount >= 200000 THEN 'large' ELSE 'small' END AS size FROM p""",
    "sql_string_plus": over(ORDERS) + "SELECT order_id, 'ORD-' || CAST(order_id AS VARCHAR) AS order_code FROM o",
    "sql_len": over(CUSTOMERS) + "SELECT customer_id, length(rtrim(name)) AS name_len FROM c",
    "sql_latest_order_window": over(ORDERS) + """
SELECT customer_id, order_id FROM o
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY order_date DESC, order_id DESC) = 1""",
    "sql_running_total": over(PAYMENTS) + """
SELECT payment_id, CAST(sum(amount) OVER (ORDER BY settled_date, payment_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS running FROM p WHERE settled_date IS NOT NULL""",
    "sql_revenue_having": over(ORDERS, LINES) + """
SELECT customer_id, CAST(sum(quantity * unit_price) AS DOUBLE) AS revenue FROM o JOIN l USING (order_id)
WHERE status IN ('paid', 'shipped') GROUP BY 1 HAVING sum(quantity * unit_price) > 30000000""",
    "sql_unpaid_antijoin": over(ORDERS, PAYMENTS) + """
SELECT order_id FROM o WHERE status IN ('paid', 'shipped')
  AND NOT EXISTS (SELECT 1 FROM p WHERE p.order_id = o.order_id)""",
    "sql_integer_division": over(LINES) + "SELECT order_id, line_no, quantity // 2 AS half_qty FROM l",
    "sql_cte_daily": over(ORDERS, LINES) + """
SELECT order_date, CAST(sum(quantity * unit_price) AS DOUBLE) AS revenue FROM o JOIN l USING (order_id)
WHERE status <> 'cancelled' GROUP BY 1""",
    "sql_nolock": over(ORDERS) + "SELECT order_id, status FROM o WHERE customer_id = 2",
    "sql_count_distinct_case": over(ORDERS) + """
SELECT order_date, count(DISTINCT customer_id) AS customers, count(CASE WHEN status = 'paid' THEN 1 END) AS paid_orders
FROM o GROUP BY 1""",
    "sql_concat_null": over(CUSTOMERS) + "SELECT customer_id, region || '-' || name AS label FROM c",
}
