"""Oracles of the gold tables and the report questions."""

from oracles.inputs import CAMPAIGNS, GAMING, LEADS, OPS_EVENTS, RETAIL, with_ctes

REVENUE = "CAST(l_extendedprice AS DECIMAL(18,6)) * (1 - CAST(coalesce(l_discount, 0) AS DECIMAL(9,8)))"
LINES = """
lines AS (
  SELECT *, {revenue} AS revenue FROM lineitem
  WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity > 0
    AND l_discount BETWEEN 0 AND 1 AND l_extendedprice >= 0 AND l_tax >= 0)""".format(revenue=REVENUE)
MONTHLY = """
monthly AS (
  SELECT r_name AS region_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_date, sum(revenue) AS revenue
  FROM lines JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2)"""
CUSTOMERS = """
metrics AS (
  SELECT c_custkey AS customer_key, c_name AS customer_name, count(DISTINCT o_orderkey) AS total_orders,
         sum(revenue) AS total_revenue, min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date
  FROM customer JOIN orders ON c_custkey = o_custkey JOIN lines ON o_orderkey = l_orderkey GROUP BY 1, 2),
clv AS (
  SELECT *, CASE ntile(5) OVER (ORDER BY total_revenue, customer_key)
              WHEN 1 THEN 'Low' WHEN 5 THEN 'High' ELSE 'Medium' END AS value_segment FROM metrics)"""
PRODUCTS = """
products AS (
  SELECT p_partkey AS product_key, p_name AS product_name, sum(revenue) AS total_revenue,
         sum(CAST(l_quantity AS DECIMAL(18,6))) AS total_quantity, count(DISTINCT l_orderkey) AS order_count
  FROM part JOIN lines ON p_partkey = l_partkey WHERE p_retailprice >= 0 GROUP BY 1, 2),
ranked AS (SELECT *, rank() OVER (ORDER BY total_revenue DESC) AS revenue_rank FROM products)"""
PERFORMANCE = """
performance AS (
  SELECT c.campaign_id, c.client_id, c.channel, c.budget, c.status,
         count(l.lead_id) AS lead_count, count(CASE WHEN l.stage = 'won' THEN 1 END) AS won_count
  FROM campaigns_clean c LEFT JOIN leads_clean l ON c.campaign_id = l.campaign_id GROUP BY ALL)"""
FUNNEL = """
funnel AS (
  SELECT client_id, CAST(date_trunc('month', created_ts) AS DATE) AS month_date,
         count(CASE WHEN stage = 'new' THEN 1 END) AS new_count,
         count(CASE WHEN stage = 'qualified' THEN 1 END) AS qualified_count,
         count(CASE WHEN stage = 'won' THEN 1 END) AS won_count,
         count(CASE WHEN stage = 'lost' THEN 1 END) AS lost_count, count(*) AS total_leads
  FROM leads_clean JOIN campaigns_clean USING (campaign_id) GROUP BY 1, 2)"""
HEALTH = """
health AS (
  SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS total_events,
         count(CASE WHEN success THEN 1 END) AS success_count,
         CAST(sum(latency_seconds) AS DOUBLE) / count(latency_seconds) AS avg_latency_seconds,
         count(CASE WHEN event_type = 'telegram_message' THEN 1 END) AS telegram_messages,
         count(CASE WHEN event_type = 'daily_plan_run' THEN 1 END) AS daily_plan_runs
  FROM ops_clean GROUP BY 1)"""
PLAYER_DAILY = """
facts AS (
  SELECT player_id, CAST(wager_ts AS DATE) AS activity_date, stake, payout, NULL AS amount, NULL AS minutes FROM wagers
  UNION ALL SELECT player_id, CAST(deposit_ts AS DATE), NULL, NULL, amount, NULL FROM deposits
  UNION ALL SELECT player_id, CAST(start_ts AS DATE), NULL, NULL, NULL, duration_minutes FROM sessions),
daily AS (
  SELECT player_id, activity_date, coalesce(sum(stake), 0) AS total_stake, coalesce(sum(payout), 0) AS total_payout,
         coalesce(sum(stake), 0) - coalesce(sum(payout), 0) AS net_loss, coalesce(sum(amount), 0) AS deposit_total,
         count(amount) AS deposit_count, coalesce(sum(minutes), 0) AS session_minutes
  FROM facts GROUP BY 1, 2)"""
FLAGS = """
per_player AS (
  SELECT player_id, count(CASE WHEN net_loss > 0 AND deposit_count >= 2 THEN 1 END) >= 3 AS f1,
         count(CASE WHEN deposit_count > 0 THEN 1 END) >= 5
           AND max(CASE WHEN deposit_count > 0 THEN CAST(deposit_total AS DOUBLE) END)
               > 3 * quantile_cont(CASE WHEN deposit_count > 0 THEN CAST(deposit_total AS DOUBLE) END, 0.5) AS f2
  FROM daily GROUP BY 1),
flags AS (
  SELECT p.player_id, coalesce(d.f1, false) AS f1, coalesce(d.f2, false) AS f2,
         EXISTS (SELECT 1 FROM sessions s WHERE s.player_id = p.player_id AND s.duration_minutes >= 240) AS f3,
         coalesce(p.self_excluded, false)
           AND EXISTS (SELECT 1 FROM wagers w WHERE w.player_id = p.player_id) AS f4
  FROM players p LEFT JOIN per_player d ON p.player_id = d.player_id)"""

ORACLES = {
    "gold_monthly_revenue_by_region": with_ctes(LINES, MONTHLY) + """
SELECT region_name, month_date, CAST(revenue AS DOUBLE) AS revenue FROM monthly""",
    "gold_customer_lifetime_value": with_ctes(LINES, CUSTOMERS) + """
SELECT customer_key, customer_name, total_orders, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(total_revenue AS DOUBLE) / total_orders AS avg_order_value,
       first_order_date, last_order_date, value_segment FROM clv""",
    "gold_top_products": with_ctes(LINES, PRODUCTS) + """
SELECT product_key, product_name, CAST(total_revenue AS DOUBLE) AS total_revenue,
       CAST(total_quantity AS DOUBLE) AS total_quantity, order_count, revenue_rank FROM ranked""",
    "gold_campaign_performance": with_ctes(CAMPAIGNS, LEADS, PERFORMANCE) + """
SELECT campaign_id, client_id, channel, CAST(budget AS DOUBLE) AS budget, status, lead_count, won_count,
       CASE WHEN lead_count > 0 THEN CAST(won_count AS DOUBLE) / lead_count ELSE 0 END AS conversion_rate,
       CASE WHEN lead_count > 0 THEN CAST(budget AS DOUBLE) / lead_count END AS cost_per_lead FROM performance""",
    "gold_client_funnel": with_ctes(CAMPAIGNS, LEADS, FUNNEL) + "SELECT * FROM funnel",
    "gold_ops_health": with_ctes(OPS_EVENTS, HEALTH) + """
SELECT event_date, total_events, success_count, CAST(success_count AS DOUBLE) / total_events AS success_rate,
       avg_latency_seconds, telegram_messages, daily_plan_runs FROM health""",
    "gold_player_daily": with_ctes(GAMING, PLAYER_DAILY) + """
SELECT player_id, activity_date, CAST(total_stake AS DOUBLE) AS total_stake,
       CAST(total_payout AS DOUBLE) AS total_payout, CAST(net_loss AS DOUBLE) AS net_loss,
       CAST(deposit_total AS DOUBLE) AS deposit_total, deposit_count,
       CAST(session_minutes AS BIGINT) AS session_minutes FROM daily""",
    "rg_player_flags": with_ctes(GAMING, PLAYER_DAILY, FLAGS) + """
SELECT player_id, f1 AS flag_chasing_losses, f2 AS flag_deposit_spike, f3 AS flag_long_session,
       f4 AS flag_self_exclusion_breach,
       CASE WHEN f4 OR CAST(f1 AS INT) + CAST(f2 AS INT) + CAST(f3 AS INT) >= 2 THEN 'high'
            WHEN f1 OR f2 OR f3 THEN 'medium' ELSE 'low' END AS risk_level,
       CASE WHEN NOT (f1 OR f2 OR f3 OR f4) THEN 'no rule triggered' ELSE
         concat_ws('; ', CASE WHEN f1 THEN '3+ losing days with repeated deposits' END,
                   CASE WHEN f2 THEN 'a deposit day over 3x the player''s usual' END,
                   CASE WHEN f3 THEN 'a session of 240+ minutes' END,
                   CASE WHEN f4 THEN 'wagered while self-excluded' END) END AS explanation FROM flags""",
    "gold_retail_sales_daily": with_ctes(RETAIL) + """
SELECT domain, region, product_category, order_date, order_count, CAST(units AS BIGINT) AS units,
       CAST(revenue AS DOUBLE) AS revenue FROM retail_report""",
    "bi_top_customers": with_ctes(LINES, CUSTOMERS) + """
SELECT customer_key, customer_name, CAST(total_revenue AS DOUBLE) AS total_revenue FROM metrics
ORDER BY metrics.total_revenue DESC, customer_key LIMIT 10""",
    "bi_top_products": with_ctes(LINES, PRODUCTS) + """
SELECT product_key, product_name, CAST(total_revenue AS DOUBLE) AS total_revenue, revenue_rank FROM ranked
WHERE revenue_rank <= 10""",
    "bi_segment_counts": with_ctes(LINES, CUSTOMERS) + """
SELECT value_segment, count(*) AS customers FROM clv GROUP BY 1""",
    "bi_revenue_by_region_year": with_ctes(LINES, MONTHLY) + """
SELECT region_name, CAST(sum(revenue) AS DOUBLE) AS revenue FROM monthly WHERE year(month_date) = 1997 GROUP BY 1""",
    "bi_best_cost_per_lead": with_ctes(CAMPAIGNS, LEADS, PERFORMANCE) + """
SELECT campaign_id, CAST(budget AS DOUBLE) / lead_count AS cost_per_lead FROM performance WHERE lead_count > 0
ORDER BY cost_per_lead, campaign_id LIMIT 1""",
    "bi_conversion_by_channel": with_ctes(CAMPAIGNS, LEADS, PERFORMANCE) + """
SELECT channel, CAST(sum(won_count) AS BIGINT) AS won, CAST(sum(lead_count) AS BIGINT) AS leads,
       CASE WHEN sum(lead_count) > 0 THEN CAST(sum(won_count) AS DOUBLE) / sum(lead_count) ELSE 0 END AS conversion_rate
FROM performance GROUP BY 1""",
    "bi_funnel_last3m": with_ctes(CAMPAIGNS, LEADS, FUNNEL) + """
SELECT month_date, CAST(sum(new_count) AS BIGINT) AS new_count, CAST(sum(qualified_count) AS BIGINT) AS qualified_count,
       CAST(sum(won_count) AS BIGINT) AS won_count, CAST(sum(lost_count) AS BIGINT) AS lost_count,
       CAST(sum(total_leads) AS BIGINT) AS total_leads
FROM funnel WHERE month_date >= (SELECT max(month_date) - INTERVAL 2 MONTH FROM funnel) GROUP BY 1""",
    "bi_ops_success_month": with_ctes(OPS_EVENTS) + """
SELECT CAST(date_trunc('month', event_ts) AS DATE) AS month_date, count(*) AS runs,
       count(CASE WHEN success THEN 1 END) AS successes,
       CAST(count(CASE WHEN success THEN 1 END) AS DOUBLE) / count(*) AS success_rate
FROM ops_clean WHERE event_type = 'daily_plan_run' GROUP BY 1""",
    "bi_busiest_day": with_ctes(OPS_EVENTS, HEALTH) + """
SELECT event_date, telegram_messages FROM health ORDER BY telegram_messages DESC, event_date LIMIT 1""",
}
