"""Incidents, root causes, event-log folds, approval audits and routing, as table jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.functions.codes import codes_where
from tidegate.functions.runbooks import REASON_CAUSES
from tidegate.operators.evidence import is_prohibited
from tidegate.operators.ordering import carried_forward
from tidegate.operators.skew import sliced_join

# -- incidents and root causes -----------------------------------------------------


def incidents(audit: DataFrame, checks: DataFrame) -> DataFrame:
    """One incident per audit record that needs one, plus one per failed check.

    `audit`: day, run_id, dataset_id, status, failure_code, rows_new, added (array).
    `checks`: day, check_name, passed. Precedence of the triggers: failed, quarantined, no new
    data, additive drift.
    """
    trigger = (
        F.when(F.col("status") == "failed", "ingestion_failed")
        .when(F.col("status") == "succeeded_with_quarantine", "rows_quarantined")
        .when(F.col("rows_new") == 0, "no_new_data").when(F.size("added") > 0, "schema_drift_additive"))
    from_runs = audit.withColumn("trigger", trigger).filter("trigger IS NOT NULL").select(
        F.concat_ws(":", F.concat(F.lit("day"), F.col("day").cast("string")), "dataset_id", "trigger")
        .alias("incident_key"), "day", "trigger", "dataset_id", "run_id", "status", "failure_code")
    from_checks = checks.filter("NOT passed").select(
        F.concat_ws(":", F.concat(F.lit("day"), F.col("day").cast("string")), F.lit("sales.payments"), "check_name")
        .alias("incident_key"), "day", F.concat("check_name", F.lit("_mismatch")).alias("trigger"),
        F.lit("sales.payments").alias("dataset_id"), F.lit(None).cast("string").alias("run_id"),
        F.lit("check_failed").alias("status"), F.lit(None).cast("string").alias("failure_code"))
    return from_runs.unionByName(from_checks)


def top_reason(reasons: Column) -> Column:
    """The reason with the most rows in a `column:reason` map; ties go to the first key.

    A record's map holds at most columns x codes entries, so this stays inside the row.
    """
    entries = F.array_sort(F.map_entries(reasons))
    coded = F.transform(entries, lambda e, i: F.struct(
        F.element_at(F.split(e["key"], ":"), -1).alias("reason"), e["value"].alias("n"), i.alias("at")))
    totals = F.transform(coded, lambda c: F.struct(
        F.aggregate(F.filter(coded, lambda o: o["reason"] == c["reason"]), F.lit(0).cast("bigint"),
                    lambda acc, o: acc + o["n"]).alias("n"), (-c["at"]).alias("first"), c["reason"].alias("reason")))
    return F.array_max(totals)["reason"]


def root_causes(found: DataFrame, audit: DataFrame, findings: DataFrame) -> DataFrame:
    """Rule-based label of each incident.

    `audit` adds quarantine_reasons by run_id, `findings` the overpaid and unpaid order
    counts of each day.
    """
    # An incident of a check has no run; a second column spreads these instead of sending them to the task of NULL.
    runs = audit.select(F.col("run_id").alias("_run"), F.lit(0).cast("bigint").alias("_spread"), "quarantine_reasons")
    spread = found.withColumn("_at", F.when(F.col("run_id").isNull(), F.xxhash64("incident_key")).otherwise(F.lit(0)))
    with_run = spread.join(runs, (F.col("run_id") == F.col("_run")) & (F.col("_at") == F.col("_spread")), "left").drop(
        "_run", "_spread", "_at")
    joined = with_run.join(findings.select("day", "overpaid_orders", "unpaid_orders"),
                                                     "day", "left")
    by_reason = F.create_map(*[F.lit(v) for pair in REASON_CAUSES.items() for v in pair])
    label = (
        F.when(F.col("trigger") == "no_new_data", "STALE_SOURCE")
        .when(F.col("trigger") == "schema_drift_additive", "SCHEMA_COLUMN_ADDED")
        .when(F.col("trigger") == "payments_vs_orders_mismatch",
              F.when(F.col("overpaid_orders") > F.col("unpaid_orders"), "DUPLICATE_CHARGE").otherwise("MISSING_PAYMENT"))
        .when(F.col("trigger") == "source_to_target_mismatch", "LATE_ARRIVAL_BEYOND_LOOKBACK")
        .when(F.col("failure_code") == "schema_required_column_missing", "SCHEMA_COLUMN_REMOVED")
        .otherwise(F.try_element_at(by_reason, top_reason(F.col("quarantine_reasons")))))
    return joined.withColumn("root_cause", label).drop("quarantine_reasons", "overpaid_orders", "unpaid_orders")


def with_runbook(labelled: DataFrame, books: DataFrame, **missing: str) -> DataFrame:
    """Attach the caller's runbook table (root_cause, ...); `missing` fills its columns for other labels.

    The table is small by nature, one row per label; Spark sends it to all tasks while it is.
    """
    return labelled.join(books, "root_cause", "left").fillna(missing)


# -- audit lookups -----------------------------------------------------------------

def runs_by_id(audit: DataFrame, asked: DataFrame) -> DataFrame:
    """The audit record of each asked run (run_id); `found` is false for a run that is not in the log."""
    wanted = asked.select("run_id").distinct()
    return wanted.join(audit.withColumn("found", F.lit(True)), "run_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))


def contract_results(audit: DataFrame, quarantine: DataFrame, first: int = 5) -> DataFrame:
    """Per run: its counts and reasons, and the first rejected rows by their raw text with all of their problems.

    Spark limits the rank ahead of the shuffle, so a run with most of the rejected rows sends `first` rows per task.
    """
    by_raw = Window.partitionBy("run_id").orderBy("raw", F.to_json("problems"))
    sample = quarantine.withColumn("place", F.row_number().over(by_raw)).filter(F.col("place") <= first)
    return audit.select("run_id", "rows_in_window", "quarantined", "quarantine_reasons").join(
        sample.select("run_id", "place", "raw", "problems"), "run_id", "left")


def schema_history(audit: DataFrame) -> DataFrame:
    """One row per stretch of runs of a dataset that delivered the same columns, and what changed at its start.

    `audit`: dataset_id, run_seq, columns (sorted array; NULL, a run that delivered nothing, changes nothing). A dataset has one
    row per run here, so its runs fit one task.
    """
    in_order = Window.partitionBy("dataset_id").orderBy("run_seq")
    runs = audit.filter("columns IS NOT NULL").select("dataset_id", "run_seq", "columns").withColumn("_before", F.lag("columns").over(in_order))
    changed = ~F.col("columns").eqNullSafe(F.col("_before"))
    numbered = runs.withColumn("_new", changed).withColumn("stretch", F.sum(F.col("_new").cast("bigint")).over(in_order))
    none = F.array().cast("array<string>")
    return numbered.groupBy("dataset_id", "stretch").agg(
        F.min("run_seq").alias("first_run"), F.max("run_seq").alias("last_run"), F.count("*").alias("runs"),
        F.any_value("columns").alias("columns"), F.min_by("_before", "run_seq").alias("_before")).select(
        "dataset_id", "stretch", "first_run", "last_run", "runs", "columns",
        F.coalesce(F.array_except("columns", "_before"), none).alias("added"),
        F.coalesce(F.array_except("_before", "columns"), none).alias("removed"))


def newest_reports(runs: DataFrame) -> DataFrame:
    """The newest run of each reconciliation check, from a run log (run_id, check_name, passed, report, saved_ts)."""
    newest = runs.groupBy("check_name").agg(F.max_by(F.struct("run_id", "passed", "report"), F.struct("saved_ts", "run_id")).alias("_r"),
                                            F.count("*").alias("runs"), F.count_if(~F.col("passed")).alias("failed"))
    return newest.select("check_name", "runs", "failed", "_r.*")


def of_sources(df: DataFrame, asked: DataFrame, order: str, newest: int | None = None) -> DataFrame:
    """The status, quarantine or log rows of the asked sources (source), or the newest of each."""
    rows = df.join(asked.select("source").distinct(), "source", "left_semi")
    if newest is None:
        return rows
    rank = F.row_number().over(Window.partitionBy("source").orderBy(F.desc(order)))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") <= newest).drop("_rank")


def tool_calls(events: DataFrame) -> DataFrame:
    """The calls that belong to the current opening of each incident, as fold_events counts them."""
    opened = events.filter(F.col("event") == OPENED).groupBy("incident_id").agg(F.max("seq").alias("opened_seq"))
    calls = events.filter(F.col("event") == TOOL_CALL).select("incident_id", "seq", "tool")
    return calls.join(opened, "incident_id").filter("seq > opened_seq").drop("opened_seq")


def recent_success(audit: DataFrame) -> DataFrame:
    """The latest run of each dataset that did not fail."""
    kept = audit.filter("status <> 'failed'")
    columns = [c for c in kept.columns if c not in ("dataset_id", "run_seq") and "map" not in kept.schema[c].dataType.simpleString()]
    newest = kept.groupBy("dataset_id").agg(F.max_by(F.struct("run_seq", *columns), "run_seq").alias("_r"))
    return newest.select("dataset_id", "_r.*")


def last_runs(audit: DataFrame, n: int = 3) -> DataFrame:
    """The last n runs of each dataset.

    Spark turns the rank limit into one per task ahead of the shuffle, so a dataset with a
    third of all records sends n rows per task.
    """
    newest_first = Window.partitionBy("dataset_id").orderBy(F.desc("run_seq"))
    return audit.withColumn("_rank", F.row_number().over(newest_first)).filter(F.col("_rank") <= n).drop("_rank")


# -- incident event log ------------------------------------------------------------

OPENED, OUTCOME, TOOL_CALL, PENDING = "incident_opened", "incident_outcome", "tool_call", "pending"  # fixed values
EVENT_DDL = ("event string, incident_id string, seq bigint, evidence_payload string, status string,"
             " reason_codes array<string>, tool string")


def fold_events(events: DataFrame) -> DataFrame:
    """Current state per incident from an append-only log.

    Only events after the latest opening of their incident count. Every aggregate combines
    before the shuffle and the join spreads hot incidents, so an incident with a third of the
    log is no special case.
    """
    opened = events.filter(F.col("event") == OPENED).groupBy("incident_id").agg(
        F.max("seq").alias("opened_seq"), F.max_by("evidence_payload", "seq").alias("opened_payload"))
    later = sliced_join(events.filter(F.col("event").isin(OUTCOME, TOOL_CALL)),
                        opened.select("incident_id", "opened_seq"), ["incident_id"], ["seq"], how="inner")
    outcome = (F.col("event") == OUTCOME) & (F.col("seq") > F.col("opened_seq"))
    call = (F.col("event") == TOOL_CALL) & (F.col("seq") > F.col("opened_seq"))
    carried = call & F.col("evidence_payload").isNotNull()
    state = later.groupBy("incident_id").agg(
        F.max_by(F.when(outcome, F.struct("status", "reason_codes")), F.when(outcome, F.col("seq"))).alias("outcome"),
        F.count_if(call).alias("tool_calls"),
        F.max_by(F.when(call, F.col("tool")), F.when(call, F.col("seq"))).alias("last_tool"),
        F.max_by(F.when(carried, F.col("evidence_payload")), F.when(carried, F.col("seq"))).alias("carried_payload"))
    return opened.join(state, "incident_id", "left").select(
        "incident_id", "opened_seq", F.coalesce("outcome.status", F.lit(PENDING)).alias("status"),
        F.coalesce("outcome.reason_codes", F.array().cast("array<string>")).alias("reason_codes"),
        F.coalesce("tool_calls", F.lit(0)).alias("tool_calls"), "last_tool",
        F.coalesce("carried_payload", "opened_payload").alias("current_payload"))


def payload_sha256(payload: Column) -> Column:
    return F.sha2(payload, 256)


# -- recovery approvals ------------------------------------------------------------

RECOVERY_ACTIONS = ("restore_lead_invalid_rate", "replay_batch")  # fixed values


def with_payload(timeline: DataFrame) -> DataFrame:
    """Every event with `payload_now`: the payload of its incident at that moment.

    That is the last payload a tool call brought since the latest opening, or else the opening's own, which may be none.
    `timeline`: seq, event, incident_id, evidence_payload and any other columns.
    """
    brought = F.when(F.col("event") == OPENED, F.struct("evidence_payload")).when(
        (F.col("event") == TOOL_CALL) & F.col("evidence_payload").isNotNull(), F.struct("evidence_payload"))
    carried = carried_forward(timeline, "incident_id", [F.asc("seq")], {"_brought": brought})
    return carried.withColumn("payload_now", F.col("_brought.evidence_payload")).drop("_brought")


def audit_approvals(timeline: DataFrame) -> DataFrame:
    """Decide every recovery request as of its moment: `approved`, or the first reason to refuse it.

    `timeline`: seq (unique), event, approval_id, incident_id, action, payload_sha256 of incident events and recovery events
    (recovery_approved / requested / started / result) together. The last approval before a request counts, and the
    payload its incident had at the request.
    """
    def of(event: str) -> Column:
        return F.col("event") == event

    recovery = with_payload(timeline).filter(F.col("event").startswith("recovery_"))
    state = carried_forward(recovery, "approval_id", [F.asc("seq")], {
        "approval": F.when(of("recovery_approved"), F.struct("incident_id", "action", "payload_sha256")),
        "started": F.when(of("recovery_started"), F.lit(True)), "ended": F.when(of("recovery_result"), F.lit(True))})
    requests = state.filter(of("recovery_requested"))
    same_payload = F.coalesce(payload_sha256(F.col("payload_now")) == F.col("approval.payload_sha256"), F.lit(False))
    code = (
        F.when(F.coalesce(is_prohibited(F.col("action")), F.lit(False)), "prohibited_action")
        .when(~F.coalesce(F.col("action").isin(*RECOVERY_ACTIONS), F.lit(False)), "unknown_recovery_action")
        .when(F.col("approval_id").isNull() | F.col("approval").isNull(), "no_approval")
        .when(~F.col("approval.incident_id").eqNullSafe(F.col("incident_id")), "approval_incident_mismatch")
        .when(~F.col("approval.action").eqNullSafe(F.col("action")), "approval_action_mismatch")
        .when(~same_payload, "approval_payload_mismatch")
        .when(F.col("started") & F.col("ended").isNull(), "recovery_outcome_unknown")
        .when(F.col("started"), "approval_already_used").otherwise("approved"))
    return requests.select("seq", "approval_id", "incident_id", "action", code.alias("decision"))


# -- routing -----------------------------------------------------------------------

LABELS = ("data_quality", "sensitive_data", "suspicious_instruction", "healthy")  # fixed values
UNKNOWN = "unknown"
DISMISS, RUNBOOK, HUMAN = "dismiss", "runbook", "human"
CONFIDENCE_THRESHOLD = 0.8
COST_UNITS = {"classifier": 1, "reasoning": 20}
STRATEGIES = ("rules_only", "rules_plus_reasoning", "rules_plus_classifier")


def _some(array: str, test) -> Column:
    return F.coalesce(F.exists(array, test), F.lit(False))


def rule_signals() -> Column:
    """Severe codes of a record with gate_passed, conserved, passed and sources columns.

    Only an explicit false is a signal; NULL is not.
    """
    def false(column: str) -> Column:
        return F.col(column).eqNullSafe(F.lit(False))

    return codes_where(
        ("gate_failed", false("gate_passed")), ("not_conserved", false("conserved")), ("run_failed", false("passed")),
        ("source_gate_failed", _some("sources", lambda s: s["gate_passed"] == F.lit(False))),
        ("source_not_conserved", _some("sources", lambda s: s["conserved"] == F.lit(False))))


def recognized() -> Column:
    """True when the rules know the shape: a boolean at the top or inside a source."""
    top = F.col("gate_passed").isNotNull() | F.col("conserved").isNotNull() | F.col("passed").isNotNull()
    return top | _some("sources", lambda s: s["gate_passed"].isNotNull() | s["conserved"].isNotNull())


def _rules_label() -> Column:
    def true(column: str) -> Column:
        return F.col(column).eqNullSafe(F.lit(True))

    all_sources = F.coalesce((F.size("sources") > 0) & F.forall(
        "sources", lambda s: s["gate_passed"].eqNullSafe(F.lit(True)) & s["conserved"].eqNullSafe(F.lit(True))), F.lit(False))
    return (
        F.when(F.col("severe_codes") == F.array(F.lit("instruction_in_evidence")), "suspicious_instruction")
        .when(F.size("severe_codes") > 0, "data_quality")
        .when(true("gate_passed") & true("conserved"), "healthy")
        .when(true("passed") & all_sources, "healthy").otherwise(UNKNOWN))


def _score_code(label: str, error: str) -> Column:
    """Why a score cannot be used, or NULL."""
    return (F.when(F.col(error).isNotNull(), F.col(error)).when(F.col(label).isNull(), "malformed_response")
            .when(F.col(label) == UNKNOWN, "classified_unknown")
            .when(~F.col(label).isin(*LABELS), "invalid_label"))


def route(records: DataFrame, strategy: str, instruction_rule: bool = True) -> DataFrame:
    """Label, action and reason codes of every record under one strategy.

    Besides the rule columns a record has `instruction` (boolean), `refusals` (codes of the
    evidence gate), and the scores as data: label1, confidence1, error1, label2, error2. A
    severe signal is never dismissed, whatever the scores say.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}")
    none = F.array().cast("array<string>")
    extra = codes_where(("instruction_in_evidence", F.col("instruction"))) if instruction_rule else none
    rows = records.withColumn("severe_codes", F.concat(rule_signals(), extra)).withColumn("known_shape", recognized())
    rows = rows.withColumn("_code1", _score_code("label1", "error1")).withColumn("_code2", _score_code("label2", "error2"))
    refused = F.size("refusals") > 0
    first_used = F.lit(False)
    if strategy == "rules_plus_classifier":
        first_used = F.col("_code1").isNull() & (F.col("confidence1") >= CONFIDENCE_THRESHOLD)
        first_used = F.coalesce(first_used, F.lit(False))
    if strategy == "rules_only":
        label, calls, asked, shape = _rules_label(), none, none, F.lit(True)
    else:
        second = F.when(F.col("_code2").isNull(), F.col("label2")).otherwise(UNKNOWN)
        label = F.when(first_used, F.col("label1")).otherwise(second)
        both = ["classifier", "reasoning"] if strategy == "rules_plus_classifier" else ["reasoning"]
        calls = F.when(first_used, F.array(F.lit("classifier"))).otherwise(F.array(*[F.lit(c) for c in both]))
        skipped = F.array(F.coalesce("_code1", F.lit("low_confidence"))) if len(both) == 2 else none
        asked = F.when(first_used, none).otherwise(
            F.concat(skipped, F.when(F.col("_code2").isNotNull(), F.array("_code2")).otherwise(none)))
        shape = F.col("known_shape")
    rows = rows.withColumns({"_label": label, "_calls": calls, "_asked": asked, "_shape": shape})
    severe, healthy = F.size("severe_codes") > 0, F.col("_label") == "healthy"
    action = (
        F.when(severe & (healthy | (F.col("_label") == UNKNOWN)), HUMAN).when(severe, RUNBOOK)
        .when(healthy & F.col("_shape"), DISMISS).when(healthy | (F.col("_label") == UNKNOWN), HUMAN).otherwise(RUNBOOK))
    codes = F.concat("severe_codes", "_asked", codes_where(
        ("severe_signal_not_dismissable", severe & healthy),
        ("unrecognized_evidence", ~severe & healthy & ~F.col("_shape"))))
    decided = rows.withColumns({
        "strategy": F.lit(strategy), "label": F.when(refused, "sensitive_data").otherwise(F.col("_label")),
        "action": F.when(refused, HUMAN).otherwise(action),
        "reason_codes": F.when(refused, F.concat(F.array(F.lit("evidence_gate_refused")), "refusals")).otherwise(codes),
        "calls": F.when(refused, none).otherwise(F.col("_calls")), "is_severe": refused | severe})
    return decided.drop("_label", "_calls", "_asked", "_shape", "_code1", "_code2", "severe_codes", "known_shape")


def explain() -> Column:
    """The decision of a routed row as text: what was decided, how severe, who was asked, and why."""
    def listed(array: str) -> Column:
        return F.when(F.size(array) == 0, "none").otherwise(F.translate(F.array_join(array, ", "), "_", " "))

    return F.concat(
        F.concat_ws(" -> ", "strategy", "label", "action"), F.when(F.col("is_severe"), "; severe").otherwise("; not severe"),
        F.lit("; asked: "), listed("calls"), F.lit("; because: "), listed("reason_codes"))


def score_routes(routed: DataFrame) -> DataFrame:
    """Counts per strategy against expected_label and severe of each record."""
    first, second = F.array_contains("calls", "classifier"), F.array_contains("calls", "reasoning")
    scored = routed.groupBy("strategy").agg(
        F.count("*").alias("cases"),
        F.count_if(F.col("severe") & (F.col("action") == DISMISS)).alias("severe_misses"),
        F.count_if((F.col("expected_label") == "healthy") & (F.col("action") != DISMISS)).alias("false_alerts"),
        F.count_if(F.col("label") == F.col("expected_label")).alias("correct_labels"),
        F.count_if(first & second).alias("escalations"), F.count_if(F.col("action") == HUMAN).alias("to_human"),
        F.count_if(first).alias("classifier_calls"), F.count_if(second).alias("reasoning_calls"))
    return scored.withColumn("cost_units", F.col("classifier_calls") * COST_UNITS["classifier"]
                             + F.col("reasoning_calls") * COST_UNITS["reasoning"])

