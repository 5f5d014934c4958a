"""Oracles of the ledger, reconciliation, parity, digest and recall queries."""

from oracles.ingest import DATASETS, PAYMENT_RUNS, runs, typed
from oracles.inputs import RETAIL, SECOND_DAY, line_extract, order_extract, payment_extract, with_ctes


def latest(dataset: str, make, through: str, short: str) -> str:
    _, keys, columns = DATASETS[dataset]
    names = ", ".join(f"t_{c} AS {c}" for c in columns)
    by = ", ".join(f"t_{c}" for c in keys)
    return f"""{make(through, f'{short}_ext')},{typed(f'{short}_ext', f'{short}_typed', keys, columns)},
{short} AS (SELECT {names} FROM {short}_typed WHERE problems = ''
  QUALIFY row_number() OVER (PARTITION BY {by} ORDER BY t_updated_at DESC) = 1)"""


LEDGER = with_ctes(latest("sales.orders", order_extract, SECOND_DAY, "ord"),
                   latest("sales.order_lines", line_extract, SECOND_DAY, "lin"),
                   latest("sales.payments", payment_extract, SECOND_DAY, "pay")) + """,
totals AS (
  SELECT o.order_id, o.order_date, o.status, coalesce(sum(l.unit_price * l.quantity), 0) AS total
  FROM ord o LEFT JOIN lin l ON l.order_id = o.order_id AND NOT coalesce(l.is_deleted, false)
  WHERE NOT coalesce(o.is_deleted, false) GROUP BY 1, 2, 3),
livepay AS (SELECT * FROM pay WHERE NOT coalesce(is_deleted, false)),
positions AS (
  SELECT t.*, (SELECT coalesce(sum(amount), 0) FROM livepay p WHERE p.order_id = t.order_id) AS paid,
         (SELECT count(*) FROM livepay p WHERE p.order_id = t.order_id) AS payments FROM totals t),
found AS (
  SELECT *, CASE WHEN status IS NULL OR status NOT IN ('paid', 'shipped') THEN 'not_judged' WHEN paid = 0 THEN 'unpaid'
    WHEN paid > total THEN 'overpaid' WHEN paid < total THEN 'underpaid' ELSE 'settled' END AS finding FROM positions),
orphans AS (SELECT * FROM livepay p WHERE NOT EXISTS (SELECT 1 FROM totals t WHERE t.order_id = p.order_id))"""

CHANGED = with_ctes(RETAIL) + """,
changed AS (
  SELECT domain, CASE WHEN day(order_date) = 9 THEN region || '_X' ELSE region END AS region, product_category,
         order_date, order_count, units + CASE WHEN day(order_date) = 11 THEN 1 ELSE 0 END AS units,
         revenue + CASE WHEN day(order_date) = 13 THEN 0.02 WHEN day(order_date) = 15 THEN 0.01 ELSE 0 END AS revenue
  FROM retail_report WHERE day(order_date) <> 7),
both_sides AS (
  SELECT coalesce(n.domain, c.domain) AS domain, coalesce(n.region, c.region) AS region,
         coalesce(n.product_category, c.product_category) AS product_category,
         coalesce(n.order_date, c.order_date) AS order_date, n.domain IS NOT NULL AS has_new,
         c.domain IS NOT NULL AS has_legacy, n.units AS nu, c.units AS cu, n.revenue AS nr, c.revenue AS cr
  FROM retail_report n FULL OUTER JOIN changed c ON n.domain = c.domain AND n.region = c.region
    AND n.product_category = c.product_category AND n.order_date = c.order_date)"""


def _passing(rows: str) -> str:
    return f"""SELECT {rows} AS new_rows, {rows} AS legacy_rows, CAST(0 AS BIGINT) AS only_in_new,
       CAST(0 AS BIGINT) AS only_in_legacy, CAST(0 AS BIGINT) AS value_mismatches, true AS passed"""


def _day_incident(dataset: str) -> str:
    keys = DATASETS[dataset][1]
    tops = {"cast_failed": "SCHEMA_TYPE_CHANGE", "duplicate_key": "DUPLICATE_SOURCE_KEY",
            "invalid_enum": "INVALID_DOMAIN_VALUE", "null_primary_key": "NULL_PRIMARY_KEY"}
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in tops.items())
    return f"""SELECT * FROM (WITH {runs(dataset)},
by_reason AS (SELECT split_part(reason, ':', 2) AS r, sum(n) AS n, min(reason) AS f FROM reasons2 GROUP BY 1)
SELECT 'day2:{dataset}:rows_quarantined' AS incident_key, 'rows_quarantined' AS trigger, '{dataset}' AS dataset_id,
       '{dataset}:day2:2' AS run_id, 'succeeded_with_quarantine' AS status, CASE r {cases} END AS root_cause
FROM (SELECT r FROM by_reason ORDER BY n DESC, f LIMIT 1))"""


DAY_INCIDENTS = " UNION ALL ".join(_day_incident(d) for d in DATASETS) + """
UNION ALL SELECT 'day2:sales.payments:source_to_target', 'source_to_target_mismatch', 'sales.payments', NULL,
  'check_failed', 'LATE_ARRIVAL_BEYOND_LOOKBACK'
UNION ALL SELECT 'day2:sales.payments:payments_vs_orders', 'payments_vs_orders_mismatch', 'sales.payments', NULL,
  'check_failed', 'MISSING_PAYMENT'"""

ORACLES = {
    "payment_recall": LEDGER + """
SELECT defect, count(*) AS injected, count(*) AS detected, CAST(1 AS DOUBLE) AS recall
FROM found CROSS JOIN (VALUES ('missing_payment'), ('duplicate_charge')) v(defect)
WHERE finding = 'settled' AND order_id % 7 = 0 GROUP BY 1""",
    "reconcile_runs": with_ctes(RETAIL) + """
SELECT run_id, 'retail' AS check_name, passed, (SELECT count(*) FROM retail_report) AS new_rows, true AS second_blocked
FROM (VALUES ('1', true), ('2', false)) v(run_id, passed)""",
    "restore_target": LEDGER + """
SELECT order_id, max(customer_id) AS customer_id, status, order_date, updated_at, is_deleted FROM (
  SELECT t_order_id AS order_id, t_customer_id AS customer_id, t_status AS status, t_order_date AS order_date,
         t_updated_at AS updated_at, t_is_deleted AS is_deleted FROM ord_typed WHERE problems = '')
GROUP BY order_id, status, order_date, updated_at, is_deleted""",
    "day_incidents": DAY_INCIDENTS,
    "order_totals": LEDGER + """
SELECT order_id, order_date, status, CAST(total AS DOUBLE) AS total FROM totals""",
    "gold_daily_revenue": LEDGER + """
SELECT order_date AS business_date, count(*) AS order_count, CAST(sum(total) AS DOUBLE) AS revenue
FROM totals WHERE status IN ('paid', 'shipped') GROUP BY 1""",
    "daily_payments": LEDGER + """
SELECT settled_date AS business_date, count(*) AS payment_count, CAST(sum(amount) AS DOUBLE) AS amount
FROM livepay GROUP BY 1""",
    "reconcile_retail": with_ctes(RETAIL) + _passing("(SELECT count(*) FROM retail_report)"),
    "reconcile_keyed": CHANGED + """
SELECT count(CASE WHEN has_new THEN 1 END) AS new_rows, count(CASE WHEN has_legacy THEN 1 END) AS legacy_rows,
       count(CASE WHEN NOT has_legacy THEN 1 END) AS only_in_new, count(CASE WHEN NOT has_new THEN 1 END) AS only_in_legacy,
       count(CASE WHEN nu <> cu THEN 1 END) + count(CASE WHEN abs(nr - cr) > 0.01 THEN 1 END) AS value_mismatches,
       false AS passed FROM both_sides""",
    "recon_samples": CHANGED + """
SELECT * FROM (
  SELECT domain, region, product_category, order_date, 'units' AS "column", CAST(nu AS VARCHAR) AS new,
         CAST(cu AS VARCHAR) AS legacy FROM both_sides WHERE nu <> cu
  UNION ALL
  SELECT domain, region, product_category, order_date, 'revenue', CAST(CAST(nr AS DECIMAL(18,2)) AS VARCHAR),
         CAST(CAST(cr AS DECIMAL(18,2)) AS VARCHAR) FROM both_sides WHERE abs(nr - cr) > 0.01
  ORDER BY 1, 2, 3, 4, 5 DESC LIMIT 10)
UNION ALL
SELECT * FROM (
  SELECT domain, region, product_category, order_date, CASE WHEN has_new THEN 'only_in_new' ELSE 'only_in_legacy' END,
         CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM both_sides WHERE NOT (has_new AND has_legacy)
  ORDER BY 5 DESC, 1, 2, 3, 4 LIMIT 10)""",
    "reconcile_injected": """
SELECT * FROM (VALUES ('none', 0::BIGINT, 0::BIGINT, 0::BIGINT, true), ('revenue', 0::BIGINT, 0::BIGINT, 1::BIGINT, false),
  ('missing_row', 1::BIGINT, 0::BIGINT, 0::BIGINT, false))
  v(mode, only_in_new, only_in_legacy, value_mismatches, passed)""",
    "source_to_target": "WITH " + PAYMENT_RUNS + """,
src AS (SELECT t_settled_date AS d, count(*) AS n, sum(t_amount) AS a FROM (
    SELECT * FROM typed2 WHERE problems = ''
    QUALIFY row_number() OVER (PARTITION BY t_payment_id ORDER BY t_updated_at DESC) = 1)
  WHERE NOT coalesce(t_is_deleted, false) GROUP BY 1),
dst AS (SELECT t_settled_date AS d, count(*) AS n, sum(t_amount) AS a FROM tgt2
  WHERE NOT coalesce(t_is_deleted, false) GROUP BY 1),
j AS (SELECT s.d AS sd, t.d AS td, s.n AS sn, t.n AS tn, s.a AS sa, t.a AS ta FROM dst t FULL OUTER JOIN src s ON s.d = t.d)
SELECT count(td) AS new_rows, count(sd) AS legacy_rows, count(CASE WHEN sd IS NULL THEN 1 END) AS only_in_new,
       count(CASE WHEN td IS NULL THEN 1 END) AS only_in_legacy,
       count(CASE WHEN sn <> tn THEN 1 END) + count(CASE WHEN sa <> ta THEN 1 END) AS value_mismatches,
       count(CASE WHEN sd IS NULL OR td IS NULL OR sn <> tn OR sa <> ta THEN 1 END) = 0 AS passed FROM j""",
    "payments_vs_orders": LEDGER + """
SELECT CAST(sum(CASE WHEN finding <> 'not_judged' THEN total ELSE 0 END) AS DOUBLE) AS expected_revenue,
       CAST(sum(CASE WHEN finding <> 'not_judged' THEN paid ELSE 0 END) AS DOUBLE) AS payments_received,
       CAST(sum(CASE WHEN finding <> 'not_judged' THEN paid - total ELSE 0 END) AS DOUBLE) AS difference,
       count(CASE WHEN finding = 'unpaid' THEN 1 END) AS unpaid_orders,
       count(CASE WHEN finding = 'overpaid' THEN 1 END) AS overpaid_orders,
       count(CASE WHEN finding = 'underpaid' THEN 1 END) AS underpaid_orders,
       (SELECT count(*) FROM orphans) AS orphan_payments,
       count(CASE WHEN finding IN ('unpaid', 'overpaid', 'underpaid') THEN 1 END) = 0
         AND (SELECT count(*) FROM orphans) = 0 AS passed FROM found""",
    "payment_findings": LEDGER + """
SELECT order_id, order_date, status, CAST(total AS DOUBLE) AS total, CAST(paid AS DOUBLE) AS paid, payments, finding
FROM found
UNION ALL SELECT order_id, NULL, NULL, NULL, CAST(sum(amount) AS DOUBLE), count(*), 'orphan' FROM orphans GROUP BY 1""",
    "orphan_payments": LEDGER + """
SELECT payment_id, order_id, CAST(amount AS DOUBLE) AS amount FROM orphans""",
    "parity_match": """
SELECT 'validated' AS status, count(DISTINCT o_custkey) AS rows_compared, CAST(0 AS BIGINT) AS expected_not_produced,
       CAST(0 AS BIGINT) AS produced_not_expected FROM orders""",
    "parity_mismatch": """
WITH c AS (SELECT o_custkey, sum(CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS lost
           FROM orders GROUP BY 1)
SELECT 'mismatch' AS status, count(*) AS rows_compared, count(CASE WHEN lost <> 0 THEN 1 END) AS expected_not_produced,
       count(CASE WHEN lost <> 0 THEN 1 END) AS produced_not_expected FROM c""",
    "parity_ordered": """
WITH n AS (SELECT count(*) AS n, count(CASE WHEN o_orderkey % 50 = 0 AND CAST(o_totalprice AS DECIMAL(18,2)) <> 0 THEN 1 END) AS k
           FROM orders WHERE o_orderkey % 3 = 0)
SELECT "case", CASE WHEN "case" IN ('same_order', 'by_price', 'no_order') THEN 'validated' ELSE 'mismatch' END AS status, n AS rows_compared,
       CASE WHEN "case" = 'other_rows' THEN k ELSE 0 END AS expected_not_produced,
       CASE WHEN "case" = 'other_rows' THEN k ELSE 0 END AS produced_not_expected, "case" = 'reversed' AS order_only
FROM n CROSS JOIN (VALUES ('same_order'), ('reversed'), ('by_price'), ('other_rows'), ('no_order')) v("case")""",
    "parity_samples": """
WITH c AS (SELECT o_custkey, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total,
                  sum(CASE WHEN o_orderkey % 50 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE 0 END) AS lost FROM orders GROUP BY 1),
t AS (SELECT CAST(CAST(o_custkey AS DECIMAL(38,2)) AS VARCHAR) AS customer, CAST(CAST(total AS DECIMAL(38,2)) AS VARCHAR) AS wanted,
             CAST(CAST(total - lost AS DECIMAL(38,2)) AS VARCHAR) AS made FROM c WHERE lost <> 0)
SELECT * FROM (SELECT 'expected_not_produced' AS direction, customer, wanted AS total, CAST(1 AS BIGINT) AS copies FROM t ORDER BY customer, wanted LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'produced_not_expected', customer, made, CAST(1 AS BIGINT) FROM t ORDER BY customer, made LIMIT 5)""",
    "parity_error": """
SELECT "case", 'execution_error' AS status, (SELECT count(DISTINCT o_custkey) FROM orders) AS rows_compared
FROM (VALUES ('unreadable'), ('unknown_column'), ('division'), ('cast'), ('fewer_columns')) v("case")""",
    "check_lookup": CHANGED + """
SELECT check_name, CAST(2 AS BIGINT) AS runs, CAST(1 AS BIGINT) AS failed, '2' AS run_id, check_name = 'monthly' AS passed,
       CASE WHEN check_name = 'monthly' THEN 0 ELSE (
         SELECT count(CASE WHEN nu <> cu THEN 1 END) + count(CASE WHEN abs(nr - cr) > 0.01 THEN 1 END) FROM both_sides) END AS value_mismatches
FROM (VALUES ('retail'), ('monthly')) v(check_name)""",
    "defect_incidents": """
SELECT 'day2:' || dataset_id || ':' || trigger AS incident_key, trigger, dataset_id, status, failure_code, root_cause FROM (VALUES
  ('sales.orders', 'no_new_data', 'succeeded', NULL, 'STALE_SOURCE'),
  ('sales.order_lines', 'ingestion_failed', 'failed', 'schema_required_column_missing', 'SCHEMA_COLUMN_REMOVED'),
  ('sales.payments', 'schema_drift_additive', 'succeeded', NULL, 'SCHEMA_COLUMN_ADDED')) v(dataset_id, trigger, status, failure_code, root_cause)""",
    "late_arrival_recall": with_ctes(payment_extract(SECOND_DAY, "ext")) + """
SELECT 'late_arrival' AS defect, count(*) AS injected, count(*) AS detected, CAST(1 AS DOUBLE) AS recall FROM (
  SELECT DISTINCT payment_id FROM ext WHERE updated_at > '1999-12-31 00:00:00' AND CAST(payment_id AS BIGINT) % 11 = 0)""",
    "table_digest": """
WITH v AS (SELECT CAST(o_orderkey AS VARCHAR) AS v0,
       CAST(o_custkey AS VARCHAR) AS v1,
       o_orderstatus AS v2,
       CAST(o_totalprice AS VARCHAR) AS v3,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS v4,
       o_orderpriority AS v5 FROM orders),
h AS (SELECT md5(concat_ws(',', coalesce(length(v0) || ':' || v0, 'null'),
         coalesce(length(v1) || ':' || v1, 'null'),
         coalesce(length(v2) || ':' || v2, 'null'),
         coalesce(length(v3) || ':' || v3, 'null'),
         coalesce(length(v4) || ':' || v4, 'null'),
         coalesce(length(v5) || ':' || v5, 'null'))) AS h FROM v),
d AS (SELECT count(*) AS row_count, concat_ws('-', CAST(sum(CAST('0x' || substr(h, 1, 16) AS UBIGINT)) AS VARCHAR),
        CAST(sum(CAST('0x' || substr(h, 17, 16) AS UBIGINT)) AS VARCHAR)) AS digest FROM h)
SELECT *, 'as_read' AS copy FROM d UNION ALL SELECT *, 'shuffled' FROM d""",
    "duplicate_key_check": """
SELECT count(*) AS row_count, count(DISTINCT (l_orderkey, l_linenumber)) AS key_count,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS excess_rows FROM lineitem""",
    "detection_recall": with_ctes(order_extract(SECOND_DAY, "ext"), line_extract(SECOND_DAY, "lext")) + f"""
SELECT defect, n AS injected, n AS detected, CAST(1 AS DOUBLE) AS recall FROM (
  SELECT 'bad_unit_price' AS defect, count(DISTINCT (order_id, line_no)) AS n FROM lext
    WHERE CAST(line_no AS BIGINT) % 131 = 0
  UNION ALL SELECT 'invalid_status', count(DISTINCT order_id) FROM ext WHERE TRY_CAST(order_id AS BIGINT) % 137 = 0
  UNION ALL SELECT 'null_key', count(DISTINCT (customer_id, updated_at)) FROM ext WHERE TRY_CAST(order_id AS BIGINT) % 139 = 0
  UNION ALL SELECT 'duplicate_key', count(DISTINCT order_id) FROM ext WHERE TRY_CAST(order_id AS BIGINT) % 149 = 0
    AND status <> 'refunded' AND order_date <> 'N/A')""",
}
