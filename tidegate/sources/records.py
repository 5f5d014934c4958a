"""Operational records derived from the given tables: audit logs, event logs, evidence, scripts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.operators import evidence, monitor
from tidegate.sources.tables import table

AUDIT_EPOCH = "1995-01-01"


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per order priority and day, with planted faults counted per run."""
    o = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", "concat('sales.', lower(substring_index(o_orderpriority, '-', -1))) AS dataset_id",
        f"cast(datediff(cast(o_orderdate AS date), date'{AUDIT_EPOCH}') AS bigint) AS day")
    runs = o.groupBy("dataset_id", "day").agg(
        F.count("*").alias("rows_in_source"),
        F.expr("count_if(k % 7 = 0)").alias("n_cast"), F.expr("count_if(k % 11 = 0)").alias("n_enum"),
        F.expr("count_if(k % 13 = 0)").alias("n_dup"), F.expr("count_if(k % 17 = 0)").alias("n_null"),
        F.expr("count_if(k % 7 = 0 OR k % 11 = 0 OR k % 13 = 0 OR k % 17 = 0)").alias("quarantined"))
    return runs.selectExpr(
        "day", "dataset_id", "concat(dataset_id, ':day', day, ':1') AS run_id", "day AS run_seq",
        """CASE WHEN day % 29 = 0 THEN 'failed' WHEN quarantined * 2 > rows_in_source THEN 'failed'
                WHEN quarantined > 0 THEN 'succeeded_with_quarantine' ELSE 'succeeded' END AS status""",
        """CASE WHEN day % 29 = 0 THEN 'schema_required_column_missing'
                WHEN quarantined * 2 > rows_in_source THEN 'quarantine_ratio_exceeded' END AS failure_code""",
        "rows_in_source", "quarantined",
        "CASE WHEN day % 5 = 0 THEN 0 ELSE rows_in_source - quarantined END AS rows_new",
        """map_filter(map('amount:cast_failed', n_cast, 'order_id:duplicate_key', n_dup,
                          'order_id:null_primary_key', n_null, 'status:invalid_enum', n_enum),
                      (reason, n) -> n > 0) AS quarantine_reasons""",
        "if(day % 3 = 0, array('currency'), cast(array() AS array<string>)) AS added",
        # Drift that lasts: a column comes with the day's first large order and goes on the days a required one is missing.
        """array_sort(concat(array('amount', 'order_id'), if(day % 29 = 0, array(), array('customer_id')),
                             if(rows_in_source >= 2, array('note'), array()))) AS columns""")


def daily_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unpaid, overpaid and late counts of each order day."""
    o = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS k", f"cast(datediff(cast(o_orderdate AS date), date'{AUDIT_EPOCH}') AS bigint) AS day")
    return o.groupBy("day").agg(
        F.expr("count_if(k % 37 = 0)").alias("unpaid_orders"), F.expr("count_if(k % 41 = 0)").alias("overpaid_orders"),
        F.expr("count_if(k % 61 = 0)").alias("late_payments"))


def daily_checks(findings: DataFrame) -> DataFrame:
    """The two reconciliation checks of each day."""
    return findings.selectExpr("day", """inline(array(
        struct('payments_vs_orders' AS check_name, unpaid_orders + overpaid_orders = 0 AS passed),
        struct('source_to_target' AS check_name, late_payments = 0 AS passed)))""")


#: Defects that are evaluated, also where no incident has one.
DEFECTS = ("DUPLICATE_CHARGE", "DUPLICATE_SOURCE_KEY", "INVALID_DOMAIN_VALUE", "LATE_ARRIVAL_BEYOND_LOOKBACK", "MISSING_PAYMENT",
           "NULL_PRIMARY_KEY", "SCHEMA_COLUMN_ADDED", "SCHEMA_COLUMN_REMOVED", "SCHEMA_TYPE_CHANGE", "STALE_SOURCE")


def evaluated_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incidents with the label of a person beside that of the rules, whether one was reported and cited, and faults found.

    The person names the reason of the earliest column where two reasons are equally common, and does not know late arrivals.
    """
    audit, findings = audit_log(spark, sf_dir), daily_findings(spark, sf_dir)
    labelled = monitor.root_causes(monitor.incidents(audit, daily_checks(findings)), audit, findings)
    counts = audit.selectExpr("run_id AS _run", "rows_in_source", "quarantined", "quarantine_reasons AS q")
    rows = labelled.join(counts, F.col("run_id") == F.col("_run"), "left")
    return rows.selectExpr(
        "day", "root_cause AS rule",
        """CASE WHEN trigger = 'source_to_target_mismatch' THEN 'MISSING_PAYMENT'
                WHEN root_cause = 'DUPLICATE_SOURCE_KEY' AND q['order_id:null_primary_key'] = q['order_id:duplicate_key']
                THEN 'NULL_PRIMARY_KEY' ELSE coalesce(root_cause, 'STALE_SOURCE') END AS defect""",
        "coalesce(rows_in_source % 3 <> 0, true) AS reported", "coalesce(rows_in_source % 2 = 0, false) AS cited",
        "coalesce(rows_in_source, 1) AS injected", "coalesce(quarantined, 0) AS detected")


def incident_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incident log: each conversation is an incident, each turn an event."""
    c = table(spark, sf_dir, "conversations")
    return c.selectExpr(
        """CASE WHEN turn = 0 THEN 'incident_opened' WHEN role = 'assistant' THEN 'incident_outcome'
                ELSE 'tool_call' END AS event""",
        "concat('i', conv_id) AS incident_id", "turn AS seq", "role", "text", "conv_id").selectExpr(
        "event", "incident_id", "seq",
        """CASE event WHEN 'incident_opened' THEN if(conv_id % 9 = 0, NULL, text)
                      WHEN 'tool_call' THEN if(seq % 4 = 0, NULL, text) END AS evidence_payload""",
        """CASE event WHEN 'incident_outcome' THEN
                CASE length(text) % 3 WHEN 0 THEN 'reported' WHEN 1 THEN 'no_citations' ELSE 'malformed_response' END
              WHEN 'tool_call' THEN 'ran' END AS status""",
        """if(event = 'incident_outcome' AND length(text) % 3 = 1, array('no_citations'),
              cast(array() AS array<string>)) AS reason_codes""",
        "if(event = 'tool_call', if(seq % 3 = 0, 'read_gate_status', 'read_quarantine_sample'), NULL) AS tool")


def recovery_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incident and recovery events on one timeline, told by what the users of `events` did.

    A signup opens the user's incident and a view is a tool call, both with `props` as payload. Purchases approve, errors start
    and end a recovery, clicks request one. Approvals hold the hash of the payload at their moment, or an old one.
    """
    e = table(spark, sf_dir, "events").selectExpr(
        "event_id AS seq", "event_type", "user_id", "props", "cast(floor(value) AS bigint) AS v", "cast(floor(value * 100) AS bigint) AS c")
    timeline = e.selectExpr(
        "seq", "c",
        """CASE event_type WHEN 'signup' THEN 'incident_opened' WHEN 'view' THEN 'tool_call' WHEN 'purchase' THEN 'recovery_approved'
                WHEN 'error' THEN if(v % 2 = 0, 'recovery_started', 'recovery_result') ELSE 'recovery_requested' END AS event""",
        "if(event_type = 'click' AND c % 13 = 0, NULL, concat('a', user_id)) AS approval_id",
        "concat('i', user_id + if(event_type = 'click' AND c % 17 = 0, 1, 0)) AS incident_id",
        """CASE WHEN event_type = 'click' AND c % 19 = 0 THEN 'exportRows' WHEN event_type = 'click' AND c % 19 = 1 THEN 'purge_rows'
                WHEN event_type = 'click' AND c % 19 = 2 THEN 'restore_lead_invalid_rate' WHEN event_type IN ('click', 'purchase')
                THEN if(user_id % 2 = 0, 'replay_batch', 'restore_lead_invalid_rate') END AS action""",
        "if(event_type IN ('signup', 'view') AND c % 5 <> 0, props, NULL) AS evidence_payload")
    hashed = "if(event = 'recovery_approved', if(c % 7 = 0, 'stale', sha2(payload_now, 256)), NULL) AS payload_sha256"
    return monitor.with_payload(timeline).selectExpr(
        "seq", "event", "approval_id", "incident_id", "action", "evidence_payload", hashed)


def evidence_packets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested packet per document, with secrets, some of them copied, and some markers."""
    d = table(spark, sf_dir, "documents").selectExpr(
        "doc_id", "text", "lang", "source", "concat('sk_', md5(cast(doc_id AS string))) AS api_key",
        "lpad(cast(doc_id AS string), 9, '0') AS ssn",
        "if(doc_id % 19 = 0, concat('pw-', md5(cast(doc_id + 1 AS string))), 'short') AS password")
    return d.selectExpr("doc_id", f"""named_struct(
        'source', source, 'api_key', api_key,
        'rows', array(
          named_struct('doc_id', doc_id, 'stage', if(doc_id % 3 = 0, NULL, 'new'), 'ssn', ssn,
                       'notes', if(doc_id % 13 = 0, concat(text, ' ref ', api_key), text)),
          named_struct('doc_id', doc_id + 1, 'stage', 'won', 'ssn', cast(NULL AS string),
                       'notes', concat(if(doc_id % 17 = 0, concat('see ', ssn), 'none'),
                                       if(doc_id % 21 = 0, concat(' pw ', password), '')))),
        'labels', map('password', password, 'lang', lang),
        'tags', array(lang, if(doc_id % 23 = 0, 'ref {evidence.CANARY_MARKER}', NULL)),
        'hidden', named_struct('phone_number', '555-0100-7777'), 'none', cast(array() AS array<string>)) AS packet""")


CITATIONS = ("source", "api_key", "rows[0]", "rows[0].stage", "rows[0].ssn", "rows[1].notes", "rows[2]", "labels",
             "labels.password", "labels.lang", "hidden", "none", "missing.path", "rows..notes", "rows[0].doc_id")


def cited_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redacted packets as JSON, each with the same list of citations."""
    packets = evidence.redact_column(evidence_packets(spark, sf_dir), "packet")
    cited = F.array(*[F.lit(c) for c in CITATIONS])
    return packets.select("doc_id", F.to_json("packet", {"ignoreNullFields": "false"}).alias("payload"),
                          cited.alias("citations"))


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON replies in twelve shapes, good and bad, around the text of each turn."""
    c = table(spark, sf_dir, "conversations").selectExpr("conv_id", "turn", "text", "(conv_id * 10 + turn) % 12 AS v")
    report = ("to_json(named_struct('summary', {0}, 'uncertainty', 'low', 'proposed_recovery', 'replay',"
              " 'citations', {1}))")
    tool = "to_json(named_struct('tool_request', named_struct('tool', 'read_gate_status', 'args', {0})))"
    return c.selectExpr("conv_id", "turn", f"""CASE v
        WHEN 0 THEN {report.format('text', "array('rows[0]', 'source')")}
        WHEN 1 THEN {report.format("' \\n '", "array('rows[0]')")}
        WHEN 2 THEN {report.format('text', 'cast(array() AS array<string>)')}
        WHEN 3 THEN {report.format('text', 'cast(NULL AS array<string>)')}
        WHEN 4 THEN {report.format('text', "'rows[0]'")}
        WHEN 5 THEN {report.format('text', 'array(1, 2)')}
        WHEN 6 THEN concat('{{"summary": "', substring(text, 1, 0))
        WHEN 7 THEN to_json(array(text))
        WHEN 8 THEN to_json(named_struct('label', 'healthy', 'confidence', 0.9, 'why', text))
        WHEN 9 THEN to_json(named_struct('label', 'healthy', 'confidence', true, 'why', text))
        WHEN 10 THEN {tool.format("named_struct('source', text, 'limit', 5)")}
        ELSE {tool.format("named_struct('source', array(text))")} END AS reply""")


SCRIPT_TAILS = {
    1: "DECLARE @id INT; DECLARE c CURSOR FOR SELECT 1; FETCH NEXT FROM c",
    2: "WHILE 1 = 1 BREAK",
    3: "BEGIN TRY SELECT 1 END TRY",
    4: "BEGIN TRANSACTION; COMMIT",
    5: "SELECT a INTO #paid FROM t",
    6: "EXEC sp_executesql N''SELECT 1''",
    7: "IF @@ROWCOUNT > 1 SELECT 1",
    8: "SELECT DATEDIFF(day, a, GETDATE()) FROM t",
    9: "SELECT DATEDIFF( Month , a, b) FROM t",
    10: "-- WHILE in a comment\nSELECT 1 /* COMMIT\nGETDATE() */",
}


def scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL scripts: a document's text followed by a statement."""
    cases = " ".join(f"WHEN {n} THEN '{tail}'" for n, tail in SCRIPT_TAILS.items())
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id", f"concat(text, '\n', CASE doc_id % 11 {cases} ELSE 'SELECT 1' END) AS script")
