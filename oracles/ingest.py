"""Oracles of the ingestion queries: each run as plain SQL over the text extracts."""

from oracles.inputs import (CAMPAIGNS, FIRST_DAY, LEADS, SECOND_DAY, line_extract, order_extract, payment_extract,
                            with_ctes)

DATASETS = {
    "sales.orders": (order_extract, ["order_id"], {
        "order_id": "int", "customer_id": "int", "status": "enum", "order_date": "date", "updated_at": "timestamp",
        "is_deleted": "bool"}),
    "sales.order_lines": (line_extract, ["order_id", "line_no"], {
        "order_id": "int", "line_no": "int", "product_id": "int", "quantity": "int", "unit_price": "decimal",
        "updated_at": "timestamp", "is_deleted": "bool"}),
    "sales.payments": (payment_extract, ["payment_id"], {
        "payment_id": "int", "order_id": "int", "amount": "decimal", "settled_date": "date",
        "updated_at": "timestamp", "is_deleted": "bool"}),
}
VERSIONS = {"sales.orders": "orders_v1", "sales.order_lines": "order_lines_v1", "sales.payments": "payments_v1"}
TYPES = {"int": "BIGINT", "decimal": "DECIMAL(18,2)", "date": "DATE", "timestamp": "TIMESTAMP", "bool": "BOOLEAN"}
STATUSES = "('placed', 'paid', 'shipped', 'cancelled')"


def typed(source: str, name: str, keys: list[str], columns: dict[str, str]) -> str:
    """Typed values t_*, and the problems of each row as `column:reason` text."""
    values, checks = [], []
    for c, kind in columns.items():
        value = f"trim({c})" if kind == "enum" else f"TRY_CAST(trim({c}) AS {TYPES[kind]})"
        values.append(f"CASE WHEN trim(coalesce({c}, '')) <> '' THEN {value} END AS t_{c}")
        blank = f"trim(coalesce({c}, '')) = ''"
        cases = []
        if c != "is_deleted":
            cases.append(f"WHEN {blank} THEN '{c}:{'null_primary_key' if c in keys else 'missing_required'}'")
        if kind == "enum":
            cases.append(f"WHEN {value} NOT IN {STATUSES} THEN '{c}:invalid_enum'")
        else:
            cases.append(f"WHEN NOT ({blank}) AND {value} IS NULL THEN '{c}:cast_failed'")
        checks.append(f"CASE {' '.join(cases)} END")
    return f"""
{name} AS (SELECT {', '.join(values)}, concat_ws(',', {', '.join(checks)}) AS problems FROM {source})"""


def run(dataset: str, day: int, through: str, columns: dict[str, str], keys: list[str], before: int | None) -> str:
    """CTEs of one run: ext<day>, typed<day>, win<day>, grp<day>, acc<day>, ver<day>, tgt<day>, wm<day>."""
    make, _, _ = DATASETS[dataset]
    d = str(day)
    payload = [c for c in columns if c not in keys and c != "updated_at"]
    k = ", ".join(f"t_{c}" for c in keys)
    floor = "" if before is None else f"""
  WHERE (problems = '' AND t_updated_at >= (SELECT t_updated_at FROM wm{before}) - INTERVAL 24 HOUR)
     OR (problems <> '' AND (t_updated_at IS NULL
         OR t_updated_at >= (SELECT t_updated_at FROM wm{before}) - INTERVAL 24 HOUR))"""
    prior = "(SELECT * FROM acc{0} WHERE false)".format(d) if before is None else f"tgt{before}"
    same = " AND ".join(f"a.t_{c} = p.t_{c}" for c in keys)
    order = ", ".join(["t_updated_at", *[f"t_{c}" for c in keys]])
    newer = "true" if before is None else f"""(a.t_updated_at, {', '.join(f'a.t_{c}' for c in keys)}) >
         (SELECT row(t_updated_at, {k}) FROM wm{before})"""
    last = "" if before is None else f"UNION ALL SELECT * FROM wm{before}"
    cols = ", ".join(f"t_{c}" for c in columns)
    return "".join((make(through, f"ext{d}"), ",", typed(f"ext{d}", f"typed{d}", keys, columns), f""",
win{d} AS (SELECT * FROM typed{d}{floor}),
grp{d} AS (
  SELECT {k}, t_updated_at, count(*) AS copies, count(DISTINCT row({', '.join(f't_{c}' for c in payload)})) AS kinds,
         {', '.join(f'any_value(t_{c}) AS t_{c}' for c in payload)}
  FROM win{d} WHERE problems = '' GROUP BY {k}, t_updated_at),
acc{d} AS (SELECT {cols} FROM grp{d} WHERE kinds = 1),
ver{d} AS (
  SELECT a.*, p.t_updated_at AS stored, {newer} AS fresh,
         p.t_updated_at IS NULL OR a.t_updated_at > p.t_updated_at AS changed, coalesce(a.t_is_deleted, false) AS gone
  FROM acc{d} a LEFT JOIN {prior} p ON {same}),
seq{d} AS (SELECT *, row_number() OVER (PARTITION BY {k}, changed ORDER BY t_updated_at) AS rn FROM ver{d}),
tgt{d} AS (
  SELECT {cols} FROM (SELECT {cols}, 1 AS old FROM {prior} UNION ALL SELECT {cols}, 0 AS old FROM acc{d})
  QUALIFY row_number() OVER (PARTITION BY {k} ORDER BY t_updated_at DESC, old DESC) = 1),
wm{d} AS (
  SELECT * FROM (SELECT t_updated_at, {k} FROM acc{d} {last}) ORDER BY {', '.join(f'{c} DESC' for c in order.split(', '))}
  LIMIT 1),
reasons{d} AS (
  SELECT reason, count(*) AS n FROM (
    SELECT unnest(string_split(problems, ',')) AS reason FROM win{d} WHERE problems <> '')
  GROUP BY 1
  UNION ALL SELECT '{','.join(keys)}:duplicate_key', sum(copies) FROM grp{d} WHERE kinds > 1 HAVING sum(copies) > 0)"""))


def runs(dataset: str, days: int = 2) -> str:
    _, keys, columns = DATASETS[dataset]
    parts = [run(dataset, 1, FIRST_DAY, columns, keys, None)]
    if days > 1:
        parts.append(run(dataset, 2, SECOND_DAY, columns, keys, 1))
    if days > 2:
        parts.append(run(dataset, 3, SECOND_DAY, columns, keys, 2))
    return ",".join(p.strip("\n") for p in parts)


def mark(day: int | None, keys: list[str]) -> str:
    if day is None:
        return "CAST(NULL AS VARCHAR)"
    parts = " || '|' || ".join(["CAST(t_updated_at AS VARCHAR)", *[f"CAST(t_{c} AS VARCHAR)" for c in keys]])
    return f"(SELECT {parts} FROM wm{day})"


def counts(day: int) -> str:
    bad = f"""(SELECT count(*) FROM win{day} WHERE problems <> '') +
       CAST((SELECT coalesce(sum(copies), 0) FROM grp{day} WHERE kinds > 1) AS BIGINT)"""
    return f"""
       (SELECT count(*) FROM ext{day}) AS rows_in_source,
       (SELECT count(*) FROM acc{day}) + {bad} AS rows_in_window,
       (SELECT count(*) FROM ver{day} WHERE fresh) AS rows_new,
       (SELECT count(*) FROM seq{day} WHERE changed AND NOT gone AND stored IS NULL AND rn = 1) AS inserted,
       (SELECT count(*) FROM seq{day} WHERE changed AND NOT gone AND NOT (stored IS NULL AND rn = 1)) AS updated,
       (SELECT count(*) FROM ver{day} WHERE NOT changed) AS unchanged,
       (SELECT count(*) FROM ver{day} WHERE changed AND gone) AS deleted,
       {bad} AS quarantined"""


def state(day: int) -> str:
    return f"""CASE WHEN EXISTS (SELECT 1 FROM reasons{day}) THEN 'succeeded_with_quarantine'
       ELSE 'succeeded' END AS status"""


def reason_text(day: int) -> str:
    return f"""coalesce((SELECT string_agg(reason || '=' || CAST(n AS VARCHAR), ',' ORDER BY reason)
       FROM reasons{day}), '') AS reasons"""


_, O_KEYS, O_COLUMNS = DATASETS["sales.orders"]
_, L_KEYS, L_COLUMNS = DATASETS["sales.order_lines"]
_, P_KEYS, P_COLUMNS = DATASETS["sales.payments"]
ORDERS_TYPED = order_extract(SECOND_DAY, "ext") + "," + typed("ext", "typed", O_KEYS, O_COLUMNS)
ORDER_RUNS, PAYMENT_RUNS = runs("sales.orders"), runs("sales.payments")
ORDER_GROUPS = """
grp AS (
  SELECT t_order_id, t_updated_at, count(*) AS copies,
         count(DISTINCT row(t_customer_id, t_status, t_order_date, t_is_deleted)) AS kinds
  FROM typed WHERE problems = '' GROUP BY 1, 2)"""


def order_runs_with_raw() -> str:
    """Both order runs, and every rejected row of each as JSON with its problems."""
    raw = "CAST(json_object(" + ", ".join(f"'{c}', {c}" for c in sorted(O_COLUMNS)) + ") AS VARCHAR) AS raw"
    parts = [ORDER_RUNS]
    for d in (1, 2):
        window = "" if d == 1 else """ AND (t_updated_at IS NULL OR t_updated_at >= (SELECT t_updated_at FROM wm1) - INTERVAL 24 HOUR)"""
        both = typed(f"ext{d}", f"both{d}", O_KEYS, O_COLUMNS).replace("SELECT ", f"SELECT {raw}, ", 1)
        parts.append(f"""{both.strip()},
raw{d} AS (
  SELECT raw, problems FROM both{d} WHERE problems <> ''{window}
  UNION ALL SELECT raw, 'order_id:duplicate_key' FROM both{d} b WHERE problems = '' AND EXISTS (
    SELECT 1 FROM grp{d} g WHERE g.kinds > 1 AND g.t_order_id = b.t_order_id AND g.t_updated_at = b.t_updated_at))""")
    return ",".join(parts)


def _audit(dataset: str, day: int, keys: list[str]) -> str:
    label = f"day{day}"
    return f"""
SELECT '{dataset}:{label}:{day}' AS run_id, '{dataset}' AS dataset_id, '{label}' AS label,
       '{VERSIONS[dataset]}' AS contract_version, {state(day)}, CAST(NULL AS VARCHAR) AS failure_code, {counts(day)},
       {reason_text(day)}, '' AS added, '' AS removed, '' AS removed_required,
       {mark(day - 1 or None, keys)} AS watermark_before, {mark(day, keys)} AS watermark_after"""


def _both_days(dataset: str, keys: list[str], make) -> str:
    return "WITH " + runs(dataset) + make(dataset, 1, keys) + " UNION ALL " + make(dataset, 2, keys)


def _day_row(dataset: str, day: int, keys: list[str]) -> str:
    return f"""
SELECT '{dataset}:day{day}:{day}' AS run_id, {state(day)}, {counts(day)}, {reason_text(day)}"""


ORACLES = {
    "contract_validate": with_ctes(ORDERS_TYPED) + """
SELECT t_order_id AS order_id, t_customer_id AS customer_id, t_status AS status, t_order_date AS order_date,
       t_updated_at AS updated_at, t_is_deleted AS is_deleted, problems FROM typed""",
    "schema_drift": with_ctes(ORDERS_TYPED, ORDER_GROUPS) + """
SELECT 'added' AS label, 'succeeded_with_quarantine' AS status, CAST(NULL AS VARCHAR) AS failure_code,
       (SELECT count(*) FROM ext) AS rows_in_source,
       (SELECT count(*) FROM typed WHERE problems <> '') + CAST((SELECT sum(CASE WHEN kinds > 1 THEN copies ELSE 1 END)
          FROM grp) AS BIGINT) AS rows_in_window,
       (SELECT count(*) FROM typed WHERE false) + (SELECT count(DISTINCT t_order_id) FROM grp g WHERE kinds = 1
          AND NOT EXISTS (SELECT 1 FROM typed t WHERE t.t_order_id = g.t_order_id AND t.t_is_deleted)) AS inserted,
       'currency' AS added, '' AS removed, '' AS removed_required
UNION ALL
SELECT 'removed', 'failed', 'schema_required_column_missing', (SELECT count(*) FROM ext), 0, 0, '',
       'customer_id', 'customer_id'""",
    "ingest_window": "WITH " + ORDER_RUNS + """
SELECT t_order_id AS order_id, t_customer_id AS customer_id, t_updated_at AS updated_at, problems = '' AS valid
FROM win2""",
    "ingest_conflicts": with_ctes(ORDERS_TYPED, ORDER_GROUPS) + """
SELECT t_order_id AS order_id, t_updated_at AS updated_at, copies FROM grp WHERE kinds > 1""",
    "ingest_reasons": with_ctes(ORDERS_TYPED, ORDER_GROUPS) + """
SELECT reason, count(*) AS rows FROM (SELECT unnest(string_split(problems, ',')) AS reason FROM typed
  WHERE problems <> '') GROUP BY 1
UNION ALL SELECT 'order_id:duplicate_key', CAST(sum(copies) AS BIGINT) FROM grp WHERE kinds > 1""",
    "ingest_breaker": "WITH " + ORDER_RUNS + f""",
c1 AS (SELECT {counts(1)}), c2 AS (SELECT {counts(2)})
SELECT 'sales.orders:day1:1' AS run_id, 'succeeded_with_quarantine' AS status, CAST(NULL AS VARCHAR) AS failure_code,
       rows_in_window, quarantined, inserted, quarantined AS quarantine_rows, {mark(1, O_KEYS)} AS watermark_after,
       (SELECT count(*) FROM tgt1) AS target_rows FROM c1
UNION ALL
SELECT 'sales.orders:day2:2', 'failed', 'quarantine_ratio_exceeded', rows_in_window, quarantined, 0,
       quarantined, {mark(1, O_KEYS)}, (SELECT count(*) FROM tgt1) FROM c2""",
    "ingest_merge": "WITH " + ORDER_RUNS + """
SELECT t_order_id AS order_id, t_customer_id AS customer_id, t_status AS status, t_order_date AS order_date,
       t_updated_at AS updated_at, t_is_deleted AS is_deleted FROM tgt2""",
    "ingest_counts": "WITH " + ORDER_RUNS + f"""
SELECT 'day1' AS label, {state(1)}, {counts(1)} UNION ALL SELECT 'day2', {state(2)}, {counts(2)}""",
    "row_accounting": "WITH " + PAYMENT_RUNS + """,
raws AS (SELECT e.payment_id, e.amount, e.updated_at, e.order_id, e.settled_date, e.is_deleted, count(*) AS copies FROM ext2 e GROUP BY ALL),
judged AS (
  SELECT *, TRY_CAST(amount AS DECIMAL(18,2)) IS NULL AS bad, TRY_CAST(updated_at AS TIMESTAMP) AS moment FROM raws),
stored AS (SELECT t_payment_id, t_updated_at FROM tgt2)
SELECT j.payment_id, j.amount, j.updated_at, CAST(j.copies AS BIGINT) AS copies, CASE
  WHEN bad AND (EXISTS (SELECT 1 FROM ext1 e WHERE e.payment_id = j.payment_id AND e.updated_at = j.updated_at)
                OR moment >= (SELECT t_updated_at FROM wm1) - INTERVAL 24 HOUR) THEN 'quarantined'
  WHEN bad THEN 'never_read' WHEN s.t_updated_at = moment THEN 'accepted' WHEN s.t_updated_at > moment THEN 'superseded' ELSE 'never_read' END AS outcome
FROM judged j LEFT JOIN stored s ON s.t_payment_id = CAST(j.payment_id AS BIGINT)""",
    "contract_results": "WITH " + order_runs_with_raw() + f""",
reject AS (
  SELECT 1 AS day, raw, problems FROM raw1 UNION ALL SELECT 2, raw, problems FROM raw2),
placed AS (SELECT day, row_number() OVER (PARTITION BY day ORDER BY raw, problems) AS place, raw, problems FROM reject)
SELECT 'sales.orders:day' || CAST(day AS VARCHAR) || ':' || CAST(day AS VARCHAR) AS run_id, rows_in_window, quarantined, place, raw, problems
FROM placed JOIN (SELECT 1 AS day, * FROM (SELECT {counts(1)}) UNION ALL SELECT 2, * FROM (SELECT {counts(2)})) c USING (day)
WHERE place <= 5""",
    "land_inferred": """
WITH first AS (
  SELECT o_orderkey AS id, o_custkey AS customer, CAST(floor(o_totalprice) AS DECIMAL(18,2)) AS total, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS placed,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_orderstatus = 'O' END AS open, lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS code,
         CAST(o_custkey AS VARCHAR) AS mixed, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ' ' END AS nothing, CAST(NULL AS VARCHAR) AS priority
  FROM orders WHERE o_orderkey % 2 = 0),
second AS (
  SELECT o_orderkey, -o_custkey, CAST(o_totalprice AS DECIMAL(18,2)), CASE WHEN o_orderkey % 3 = 0
           THEN o_orderdate + to_seconds(o_orderkey % 86400) ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END,
         o_orderstatus = 'O', lpad(CAST(o_orderkey AS VARCHAR), 9, '0'),
         CASE WHEN o_orderkey % 5 = 0 THEN 'N/A' ELSE CAST(o_custkey AS VARCHAR) END, NULL, o_orderpriority
  FROM orders WHERE o_orderkey % 2 = 1),
landed AS (SELECT * FROM first UNION ALL SELECT * FROM second),
digits AS (SELECT max(length(CAST(CAST(floor(abs(total)) AS BIGINT) AS VARCHAR))) AS whole FROM landed)""" + " UNION ALL ".join(f"""
SELECT '{c}' AS column, {kind} AS type, count({c}) AS filled, count(DISTINCT {c}) AS kinds, CAST(min({c}) AS VARCHAR) AS least,
       CAST(max({c}) AS VARCHAR) AS greatest FROM landed""" for c, kind in (
        ("id", "'bigint'"), ("customer", "'bigint'"),
        ("total", "(SELECT 'decimal(' || CAST(whole + 2 AS VARCHAR) || ',2)' FROM digits)"), ("placed", "'timestamp_ntz'"),
        ("open", "'boolean'"), ("code", "'string'"), ("mixed", "'string'"), ("nothing", "'string'"), ("priority", "'string'"))),
    "ingest_watermark": "WITH " + PAYMENT_RUNS + f"""
SELECT 'day1' AS label, CAST(NULL AS VARCHAR) AS watermark_before, {mark(1, P_KEYS)} AS watermark_after
UNION ALL SELECT 'day2', {mark(1, P_KEYS)}, {mark(2, P_KEYS)}""",
    "ingest_audit": _both_days("sales.order_lines", L_KEYS, _audit),
    "ingest_replay": "WITH " + runs("sales.payments", 3) + f"""
SELECT {state(3)}, {counts(3)}, true AS watermark_kept, (SELECT count(*) FROM tgt2) AS target_rows""",
    "ingest_day": " UNION ALL ".join(
        "SELECT * FROM (" + _both_days(d, DATASETS[d][1], _day_row) + ")" for d in DATASETS),
    "live_rows": "WITH " + PAYMENT_RUNS + """
SELECT t_payment_id AS payment_id, t_order_id AS order_id, CAST(t_amount AS DOUBLE) AS amount,
       t_settled_date AS settled_date FROM tgt2 WHERE NOT coalesce(t_is_deleted, false)""",
    "replay_merge": with_ctes(CAMPAIGNS, LEADS) + """,
stored AS (SELECT lead_id, CASE WHEN lead_id % 5 = 0 THEN 'new' ELSE stage END AS stage FROM leads_clean
           WHERE created_ts < TIMESTAMP '2024-01-20 00:00:00'),
batch AS (SELECT lead_id, stage FROM leads_clean WHERE stage <> 'lost'),
measured AS (SELECT (SELECT count(*) FROM batch b WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.lead_id = b.lead_id)) AS inserted,
       (SELECT count(*) FROM batch b JOIN stored s USING (lead_id) WHERE s.stage <> b.stage) AS updated,
       (SELECT count(*) FROM batch b JOIN stored s USING (lead_id) WHERE s.stage = b.stage) AS unchanged,
       (SELECT count(*) FROM stored s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE s.lead_id = b.lead_id)) AS stale,
       CAST(1 AS BIGINT) AS max_copies,
       (SELECT count(*) FROM (SELECT lead_id FROM stored UNION SELECT lead_id FROM batch)) AS merged_rows)
SELECT 'inserted' AS measure, inserted AS value FROM measured UNION ALL SELECT 'updated', updated FROM measured
UNION ALL SELECT 'unchanged', unchanged FROM measured UNION ALL SELECT 'stale', stale FROM measured
UNION ALL SELECT 'max_copies', max_copies FROM measured UNION ALL SELECT 'merged_rows', merged_rows FROM measured""",
}
