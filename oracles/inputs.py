"""SQL twins of the derived inputs, as common table expressions for the oracles."""

FIRST_DAY = "TIMESTAMP '1999-12-31 00:00:00'"
SECOND_DAY = "TIMESTAMP '2002-01-01 00:00:00'"

CAMPAIGNS = """
campaigns AS (
  SELECT c_custkey AS campaign_id,
         CASE WHEN c_custkey % 89 = 0 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS client_id,
         c_mktsegment AS channel, CAST(c_acctbal AS DECIMAL(18,2)) AS budget,
         CASE WHEN c_custkey % 3 = 0 THEN 'paused' ELSE 'active' END AS status
  FROM customer),
campaigns_clean AS (SELECT * FROM campaigns WHERE client_id IS NOT NULL AND budget >= 0)"""

LEADS = """
leads AS (
  SELECT event_id AS lead_id, CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS campaign_id,
         CASE event_type WHEN 'signup' THEN 'new' WHEN 'click' THEN 'qualified'
              WHEN 'purchase' THEN 'won' WHEN 'view' THEN 'lost'
              ELSE CASE WHEN event_id % 7 = 0 THEN 'stale' WHEN event_id % 11 = 0 THEN NULL
                        ELSE 'new' END END AS stage,
         ts AS created_ts, event_id + later AS _row_id
  FROM events CROSS JOIN (VALUES (0::BIGINT), (1000000000000::BIGINT)) v(later)
  WHERE later = 0 OR event_id % 40 = 0),
leads_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lead_id ORDER BY _row_id) AS dup_rank FROM leads),
leads_flagged AS (
  SELECT l.*,
         campaign_id IS NULL AS r1,
         campaign_id IS NOT NULL AND NOT EXISTS (
           SELECT 1 FROM campaigns_clean c WHERE c.campaign_id = l.campaign_id) AS r2,
         stage IS NULL OR stage NOT IN ('new', 'qualified', 'won', 'lost') AS r3,
         dup_rank > 1 AS r4
  FROM leads_ranked l),
leads_coded AS (
  SELECT *, concat_ws(',', CASE WHEN r1 THEN 'null_campaign_id' END, CASE WHEN r2 THEN 'unknown_campaign_id' END,
                      CASE WHEN r3 THEN 'invalid_stage' END, CASE WHEN r4 THEN 'duplicate_lead_id' END) AS reasons
  FROM leads_flagged),
leads_clean AS (SELECT * FROM leads_coded WHERE reasons = '')"""

WEB_EVENTS = """
web AS (
  SELECT event_id, CASE WHEN event_id % 59 = 0 THEN NULL ELSE user_id END AS campaign_id,
         CASE WHEN event_id % 47 = 0 THEN -1 WHEN event_id % 53 = 0 THEN NULL
              ELSE CAST(floor(value) AS BIGINT) END AS session_duration_seconds,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS page_views, ts AS event_ts, event_id AS _row_id
  FROM events),
web_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY _row_id) AS dup_rank FROM web),
web_coded AS (
  SELECT w.*, concat_ws(',',
         CASE WHEN campaign_id IS NULL THEN 'null_campaign_id' END,
         CASE WHEN campaign_id IS NOT NULL AND NOT EXISTS (
           SELECT 1 FROM campaigns_clean c WHERE c.campaign_id = w.campaign_id) THEN 'unknown_campaign_id' END,
         CASE WHEN session_duration_seconds IS NULL OR session_duration_seconds < 0 THEN 'invalid_duration' END,
         CASE WHEN dup_rank > 1 THEN 'duplicate_event_id' END) AS reasons
  FROM web_ranked w)"""

OPS_EVENTS = """
ops AS (
  SELECT event_id AS ops_event_id,
         CASE WHEN event_id % 2 = 0 THEN 'telegram_message' ELSE 'daily_plan_run' END AS event_type,
         event_type <> 'error' AS success,
         CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(value AS DECIMAL(18,2)) END AS latency_seconds,
         ts AS event_ts, event_id + later AS _row_id
  FROM events CROSS JOIN (VALUES (0::BIGINT), (1000000000000::BIGINT)) v(later)
  WHERE later = 0 OR event_id % 67 = 0),
ops_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY ops_event_id ORDER BY _row_id) AS dup_rank FROM ops),
ops_coded AS (
  SELECT *, concat_ws(',',
         CASE WHEN latency_seconds IS NULL OR latency_seconds < 0 THEN 'invalid_latency' END,
         CASE WHEN dup_rank > 1 THEN 'duplicate_ops_event_id' END) AS reasons
  FROM ops_ranked),
ops_clean AS (SELECT * FROM ops_coded WHERE reasons = '')"""

GAMING = """
players_raw AS (
  SELECT CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE c_custkey END AS player_id,
         lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com' AS email,
         CAST(DATE '1950-01-01' + CAST(c_custkey % 15000 AS INTEGER) AS VARCHAR) AS date_of_birth,
         n_name AS region,
         CAST(DATE '2020-01-01' + CAST(c_custkey % 700 AS INTEGER) AS VARCHAR) AS signup_date,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 5 = 0 END AS self_excluded
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
players AS (SELECT * FROM players_raw WHERE player_id IS NOT NULL),
wagers_raw AS (
  SELECT event_id AS wager_id, CASE WHEN event_id % 83 = 0 THEN NULL ELSE user_id END AS player_id,
         CASE WHEN event_id % 71 = 0 THEN 0 ELSE CAST(value AS DECIMAL(18,2)) END AS stake,
         event_id % 3 AS factor, ts AS wager_ts
  FROM events WHERE event_type = 'purchase'),
wagers AS (
  SELECT wager_id, player_id, CAST(stake AS DECIMAL(18,2)) AS stake,
         CAST(stake * factor AS DECIMAL(18,2)) AS payout, wager_ts
  FROM wagers_raw WHERE player_id IS NOT NULL AND stake > 0),
deposits AS (
  SELECT * FROM (
    SELECT event_id AS deposit_id, user_id AS player_id,
           CASE WHEN event_id % 89 = 0 THEN -1 ELSE CAST(value AS DECIMAL(18,2)) END AS amount, ts AS deposit_ts
    FROM events WHERE event_type IN ('signup', 'click')) d
  WHERE player_id IS NOT NULL AND amount > 0),
sessions AS (
  SELECT * FROM (
    SELECT event_id AS session_id, user_id AS player_id, ts AS start_ts,
           CASE WHEN event_id % 73 = 0 THEN -5 ELSE CAST(floor(value) AS BIGINT) END AS duration_minutes
    FROM events WHERE event_type IN ('view', 'error')) s
  WHERE player_id IS NOT NULL AND duration_minutes >= 0)"""

RETAIL = """
licensees AS (
  SELECT c_custkey AS licensee_id, n_name AS region,
         CASE WHEN c_custkey % 83 = 0 THEN 'tobacco' WHEN c_custkey % 2 = 0 THEN 'liquor' ELSE 'cannabis' END AS domain
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
retail_orders AS (
  SELECT l_orderkey AS order_id, CASE WHEN o_custkey % 73 = 0 THEN NULL ELSE o_custkey END AS licensee_id,
         CASE WHEN l_returnflag = 'A' THEN 'cannabis' ELSE 'liquor' END AS domain,
         o_orderpriority AS product_category, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN l_partkey % 67 = 0 THEN 0 ELSE CAST(floor(l_quantity) AS BIGINT) END AS quantity,
         CASE WHEN l_suppkey % 79 = 0 THEN -1 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
retail_report AS (
  SELECT o.domain, l.region, o.product_category, o.order_date, count(*) AS order_count,
         sum(o.quantity) AS units, sum(o.amount) AS revenue
  FROM retail_orders o JOIN licensees l ON o.licensee_id = l.licensee_id
  WHERE o.amount >= 0 AND o.quantity > 0 AND l.domain IN ('liquor', 'cannabis')
  GROUP BY o.domain, l.region, o.product_category, o.order_date)"""


def order_extract(through: str, name: str = "order_extract") -> str:
    return f"""
{name}_versions AS (
  SELECT *, o_orderdate + to_seconds(o_orderkey % 86400) AS placed_at,
         o_orderdate + to_seconds(o_orderkey % 86400) + INTERVAL 2 DAY AS closed_at,
         o_orderstatus <> 'O'
           AND o_orderdate + to_seconds(o_orderkey % 86400) + INTERVAL 2 DAY <= {through} AS closed
  FROM orders WHERE o_orderdate + to_seconds(o_orderkey % 86400) <= {through}),
{name} AS (
  SELECT CASE WHEN copy = 1 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS order_id,
         CAST(o_custkey + CASE WHEN copy = 2 THEN 1 ELSE 0 END AS VARCHAR) AS customer_id,
         CASE WHEN o_orderkey % 401 = 0 THEN 'refunded' WHEN NOT closed THEN 'placed'
              WHEN o_orderstatus = 'F' THEN 'shipped' WHEN o_orderstatus = 'P' THEN 'paid'
              WHEN o_orderkey % 10 = 0 THEN 'cancelled' ELSE 'placed' END AS status,
         CASE WHEN o_orderkey % 409 = 0 THEN 'N/A' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS order_date,
         CAST(CASE WHEN closed THEN closed_at ELSE placed_at END AS VARCHAR) AS updated_at,
         CASE WHEN closed AND o_orderkey % 97 = 0 THEN 'true' ELSE 'false' END AS is_deleted
  FROM {name}_versions CROSS JOIN (VALUES (0), (1), (2), (3)) v(copy)
  WHERE copy = 0 OR (copy = 1 AND o_orderkey % 419 = 0) OR (copy = 2 AND o_orderkey % 431 = 0)
     OR (copy = 3 AND o_orderkey % 433 = 0))"""


def line_extract(through: str, name: str = "line_extract") -> str:
    return f"""
{name} AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey * 10 + l_linenumber AS VARCHAR) AS line_no,
         CAST(l_partkey AS VARCHAR) AS product_id, CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS quantity,
         CASE WHEN (l_partkey * 10 + l_linenumber) % 503 = 0 THEN 'N/A'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS unit_price,
         CAST(l_shipdate + to_seconds(l_orderkey % 86400) AS VARCHAR) AS updated_at,
         CASE WHEN (l_partkey * 10 + l_linenumber) % 211 = 0 THEN 'true' END AS is_deleted
  FROM lineitem WHERE l_shipdate + to_seconds(l_orderkey % 86400) <= {through})"""


def payment_extract(through: str, name: str = "payment_extract") -> str:
    first_only = "AND NOT o_totalprice BETWEEN 20000 AND 30000" if through == FIRST_DAY else ""
    return f"""
{name}_totals AS (
  SELECT l_orderkey, sum(CAST(floor(l_quantity) AS BIGINT) * CAST(l_extendedprice AS DECIMAL(18,2))) AS total
  FROM lineitem GROUP BY l_orderkey),
{name} AS (
  SELECT CAST(o_orderkey + copy * 1000000000000 AS VARCHAR) AS payment_id,
         CAST(CASE WHEN copy = 2 THEN -o_orderkey - 1 ELSE o_orderkey END AS VARCHAR) AS order_id,
         CASE WHEN o_orderkey % 509 = 0 THEN 'N/A' ELSE CAST(CAST(
           CASE WHEN o_orderkey % 43 = 0 THEN total - 1 ELSE total END AS DECIMAL(18,2)) AS VARCHAR) END AS amount,
         CAST(CAST(o_orderdate + INTERVAL 3 DAY AS DATE) AS VARCHAR) AS settled_date,
         CAST(o_orderdate + to_seconds(o_orderkey % 86400) + INTERVAL 3 DAY AS VARCHAR) AS updated_at,
         CASE WHEN o_orderkey % 307 = 0 THEN 'true' ELSE 'false' END AS is_deleted
  FROM orders JOIN {name}_totals ON o_orderkey = l_orderkey
  CROSS JOIN (VALUES (0::BIGINT), (1::BIGINT), (2::BIGINT)) v(copy)
  WHERE o_orderstatus IN ('F', 'P')
    AND o_orderdate + to_seconds(o_orderkey % 86400) + INTERVAL 3 DAY <= {through} {first_only}
    AND ((copy = 0 AND o_totalprice >= 20000) OR (copy = 1 AND o_orderkey % 41 = 0)
      OR (copy = 2 AND o_orderkey % 59 = 0)))"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n"
