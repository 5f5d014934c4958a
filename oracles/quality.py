"""Oracles of the landing, silver, expectation, streaming, quarantine and gate queries."""

from oracles.gold import PERFORMANCE
from oracles.inputs import CAMPAIGNS, GAMING, LEADS, OPS_EVENTS, WEB_EVENTS, with_ctes

FAULTY = """
faulty AS (
  SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_tax,
         CASE WHEN l_partkey % 97 = 0 THEN 0.0 ELSE l_quantity END AS l_quantity,
         CASE WHEN l_suppkey % 89 = 0 THEN 1.5 WHEN l_partkey % 101 = 0 THEN NULL ELSE l_discount END AS l_discount,
         CASE WHEN l_orderkey % 103 = 0 THEN -l_extendedprice - 1 ELSE l_extendedprice END AS l_extendedprice
  FROM lineitem)"""
RULES = (
    ("valid_orderkey", "l_orderkey IS NOT NULL"), ("valid_linenumber", "l_linenumber IS NOT NULL"), ("valid_quantity", "l_quantity > 0"),
    ("valid_discount", "l_discount >= 0 AND l_discount <= 1"), ("valid_extendedprice", "l_extendedprice >= 0"), ("valid_tax", "l_tax >= 0"))
KEPT_LINES = with_ctes(FAULTY) + """
SELECT l_suppkey, count(*) AS kept, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,6))) AS DOUBLE) AS price
FROM faulty WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL AND l_quantity > 0
  AND l_discount BETWEEN 0 AND 1 AND l_extendedprice >= 0 AND l_tax >= 0 GROUP BY 1"""
STATUS = """
counted AS (
  SELECT 'leads' AS source, reasons FROM leads_coded
  UNION ALL SELECT 'web_events', reasons FROM web_coded
  UNION ALL SELECT 'ops_events', reasons FROM ops_coded),
status AS (
  SELECT source, count(*) AS total, count(CASE WHEN reasons <> '' THEN 1 END) AS quarantined,
         count(CASE WHEN reasons = '' THEN 1 END) AS accepted_rows FROM counted GROUP BY 1)"""
ALL_SOURCES = (CAMPAIGNS, LEADS, WEB_EVENTS, OPS_EVENTS, STATUS)

ORACLES = {
    "bronze_stream_land": " UNION ALL ".join(
        f"SELECT '{t}' AS _source_table, count(*) AS landed_rows, count(*) AS stamped_rows FROM {t}"
        for t in ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")),
    "bronze_row_id": "SELECT o_orderkey, row_number() OVER () - 1 AS row FROM orders",
    "silver_trim": """SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "silver_typed": """
SELECT event_id, CASE WHEN event_id % 31 <> 0 THEN ts END AS event_ts,
       CASE WHEN event_id % 31 <> 0 THEN CAST(ts AS DATE) END AS event_date FROM events""",
    "expect_drop": KEPT_LINES,
    "expect_stream": KEPT_LINES,
    "expect_all": with_ctes(GAMING) + """
SELECT wager_id, player_id, CAST(stake AS DOUBLE) AS stake, CAST(payout AS DOUBLE) AS payout, wager_ts FROM wagers""",
    "expect_fail": """
SELECT l_suppkey, count(*) AS kept, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,6))) AS DOUBLE) AS price
FROM lineitem GROUP BY 1""",
    "expect_metrics": with_ctes(FAULTY) + " UNION ALL ".join(f"""
SELECT '{name}' AS rule, count(*) - count(CASE WHEN {predicate} THEN NULL ELSE 1 END) AS passed,
       count(CASE WHEN {predicate} THEN NULL ELSE 1 END) AS failed FROM faulty""" for name, predicate in (
        ("valid_orderkey", "l_orderkey IS NOT NULL"), ("valid_linenumber", "l_linenumber IS NOT NULL"),
        ("valid_quantity", "l_quantity > 0"), ("valid_discount", "l_discount >= 0 AND l_discount <= 1"),
        ("valid_extendedprice", "l_extendedprice >= 0"), ("valid_tax", "l_tax >= 0"))),
    "latest_per_key": with_ctes(CAMPAIGNS) + """
SELECT campaign_id, client_id, channel, CAST(budget AS DOUBLE) AS budget, status FROM campaigns""",
    "dedup_by_key": with_ctes(OPS_EVENTS) + """
SELECT ops_event_id, _row_id, CASE WHEN dup_rank = 1 THEN 'kept' ELSE 'duplicate' END AS outcome FROM ops_ranked""",
    "scd1_stream": """
SELECT c_custkey, c_name,
       CAST(CAST(c_acctbal AS DECIMAL(18,2)) + CASE WHEN c_mktsegment = 'BUILDING' THEN 3 ELSE 2 END AS DOUBLE) AS c_acctbal,
       CAST(CASE WHEN c_mktsegment = 'BUILDING' THEN 3 ELSE 2 END AS BIGINT) AS seq FROM customer""",
    "scd1_orders_stream": """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN 'shipped' WHEN o_orderkey % 3 = 0 THEN 'paid' ELSE 'placed' END AS status,
       o_orderdate, o_orderdate + CASE WHEN o_orderstatus = 'F' THEN INTERVAL 3 DAY WHEN o_orderkey % 3 = 0 THEN INTERVAL 2 DAY
                                       ELSE INTERVAL 1 DAY END AS changed_at FROM orders""",
    "dq_leads": with_ctes(CAMPAIGNS, LEADS) + "SELECT lead_id, campaign_id, stage, _row_id, reasons FROM leads_coded",
    "dq_web_events": with_ctes(CAMPAIGNS, WEB_EVENTS) + """
SELECT event_id, campaign_id, session_duration_seconds, page_views, reasons FROM web_coded""",
    "dq_ops_events": with_ctes(OPS_EVENTS) + """
SELECT ops_event_id, event_type, success, CAST(latency_seconds AS DOUBLE) AS latency_seconds, _row_id, reasons
FROM ops_coded""",
    "quarantine_leads": with_ctes(CAMPAIGNS, LEADS) + """
SELECT lead_id, campaign_id, stage, _row_id, reasons, true AS stamped FROM leads_coded WHERE reasons <> ''""",
    "quarantine_web_events": with_ctes(CAMPAIGNS, WEB_EVENTS) + """
SELECT event_id, campaign_id, session_duration_seconds, page_views, reasons, true AS stamped FROM web_coded WHERE reasons <> ''""",
    "quarantine_ops_events": with_ctes(OPS_EVENTS) + """
SELECT ops_event_id, event_type, success, CAST(latency_seconds AS DOUBLE) AS latency_seconds, _row_id, reasons, true AS stamped
FROM ops_coded WHERE reasons <> ''""",
    "expect_stream_metrics": with_ctes(FAULTY) + " UNION ALL ".join(f"""
SELECT l_orderkey % 3 AS batch_id, '{name}' AS rule, count(*) - count(CASE WHEN {predicate} THEN NULL ELSE 1 END) AS passed,
       count(CASE WHEN {predicate} THEN NULL ELSE 1 END) AS failed FROM faulty GROUP BY 1""" for name, predicate in RULES),
    "first_case_per_defect": with_ctes(CAMPAIGNS, WEB_EVENTS) + """
SELECT reasons, _row_id, event_id, campaign_id FROM web_coded WHERE reasons <> ''
QUALIFY row_number() OVER (PARTITION BY reasons ORDER BY _row_id) = 1""",
    "dq_rate": with_ctes(OPS_EVENTS) + """
SELECT CAST(rate AS DOUBLE) AS rate, (SELECT count(*) FROM ops_clean) AS rows, true AS all_found, true AS near_rate
FROM (VALUES (0.0), (0.25), (1.0)) v(rate)""",
    "sources_lookup": with_ctes(*ALL_SOURCES) + """,
held AS (
  SELECT 'leads' AS source, _row_id AS number, reasons FROM leads_coded WHERE reasons <> ''
  UNION ALL SELECT 'web_events', _row_id, reasons FROM web_coded WHERE reasons <> '')
SELECT source, 'status' AS kind, quarantined AS number, '' AS reasons FROM status WHERE source IN ('leads', 'ops_events')
UNION ALL SELECT source, 'quarantine', number, reasons FROM held WHERE source = 'leads'
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY number DESC) <= 3""",
    "dq_conservation": with_ctes(*ALL_SOURCES) + """
SELECT source, total, accepted_rows, quarantined AS quarantined_rows, accepted_rows + quarantined = total AS conserved
FROM status""",
    "quality_metrics": with_ctes(*ALL_SOURCES) + """
SELECT source, reason, count(*) AS row_count FROM (
  SELECT source, unnest(string_split(CASE WHEN reasons = '' THEN 'accepted' ELSE reasons END, ',')) AS reason
  FROM counted) GROUP BY 1, 2""",
    "gate_status": with_ctes(*ALL_SOURCES) + """
SELECT source, total, quarantined, accepted_rows, quarantined AS quarantined_rows,
       CAST(quarantined AS DOUBLE) / total AS quarantine_rate,
       CAST(quarantined AS DOUBLE) / total <= 0.1 AS gate_passed, true AS conserved FROM status""",
    "gate_verdict": with_ctes(*ALL_SOURCES) + """
SELECT source, CASE WHEN CAST(quarantined AS DOUBLE) / total <= 0.1 THEN ''
       ELSE 'gate_passed: false at rate ' || CAST(CAST(round(CAST(quarantined AS DOUBLE) / total, 4) AS DECIMAL(6,4)) AS VARCHAR)
       END AS problems FROM status""",
    "gated_publish": with_ctes(CAMPAIGNS, LEADS, PERFORMANCE) + """
SELECT campaign_id, CAST(budget AS DOUBLE) AS budget, lead_count, won_count, CAST(1 AS BIGINT) AS version,
       true AS second_withheld FROM performance""",
    "evidence_refused": with_ctes(*ALL_SOURCES) + """
SELECT v.passed, CASE WHEN v.passed THEN '' ELSE 'canary marker after redaction' END AS problems, (SELECT count(*) FROM status) AS sources
FROM (VALUES (true), (false)) v(passed)""",
    "silver_clients": """
SELECT CAST(n_nationkey AS BIGINT) AS client_id, n_name AS client_name, CASE WHEN n_regionkey < 2 THEN 'gold' ELSE 'standard' END AS tier
FROM nation""",
    "evidence_log": with_ctes(*ALL_SOURCES) + """
SELECT bool_and(CAST(quarantined AS DOUBLE) / total <= 0.1) OVER () AS passed,
       count(CASE WHEN CAST(quarantined AS DOUBLE) / total > 0.1 THEN 1 END) OVER () AS problem_count,
       source, CAST(quarantined AS DOUBLE) / total <= 0.1 AS gate_passed, true AS conserved, total, quarantined,
       accepted_rows, quarantined AS quarantined_rows, CAST(quarantined AS DOUBLE) / total AS quarantine_rate
FROM status""",
}
