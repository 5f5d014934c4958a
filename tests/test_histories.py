"""State as of an event, inferred types, histories, evaluations, parity with order, stream counters, row accounting."""

import datetime as dt
import hashlib
import json
import random
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegate.functions import inference
from tidegate.operators import evaluate, ingest, monitor, reconcile
from tidegate.operators.ingest import IngestStore
from tidegate.operators.ordering import carried_forward
from tidegate.sources.partitioned import AppendLog
from tidegate.sources.specs import parse_spec
from tidegate.streaming import land, metrics

SPEC = parse_spec({
    "dataset_id": "t.rows", "contract_version": "v1", "source": {"type": "csv", "table": "rows"},
    "ingestion": {"mode": "incremental", "cursor_column": "at", "primary_key": ["id"], "lookback_hours": 24, "deletion_strategy": "tombstone",
                  "max_quarantine_ratio": 0.9},
    "target": {"bronze_name": "bronze_rows"},
    "columns": {"id": {"type": "int", "required": True}, "v": {"type": "decimal", "required": True}, "at": {"type": "timestamp", "required": True}}})


# -- state as of an event ----------------------------------------------------------

def test_values_are_carried_across_slices(spark):
    draw = random.Random(4)
    rows = [(draw.choice(["hot"] * 6 + ["a", "b", None]), i, draw.choice([None, None, None, i])) for i in range(600)]
    rows += [("late", 1000 + i, None) for i in range(40)] + [("zlast", 2000, 5), ("zlast", 2001, None)]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, seq int, x int")
    got = carried_forward(df, "k", [F.asc("seq")], {"now": F.col("x"), "even": F.when(F.col("x") % 2 == 0, F.struct("x"))}).collect()
    last, even, want = {}, {}, {}
    for k, seq, x in sorted(rows, key=lambda r: r[1]):
        last[k] = x if x is not None else last.get(k)
        even[k] = x if x is not None and x % 2 == 0 else even.get(k)
        want[seq] = (last[k], even[k])
    assert {r["seq"]: (r["now"], r["even"] and r["even"]["x"]) for r in got} == want
    assert carried_forward(df.limit(0), "k", [F.asc("seq")], {"now": F.col("x")}).collect() == []


def test_requests_are_judged_as_of_their_moment(spark):
    hash_of = lambda text: hashlib.sha256(text.encode()).hexdigest()
    replay, restore = monitor.RECOVERY_ACTIONS[1], monitor.RECOVERY_ACTIONS[0]
    log = [
        (1, "incident_opened", None, "i1", None, None, "first"), (2, "recovery_approved", "a1", "i1", replay, hash_of("first"), None),
        (3, "recovery_requested", "a1", "i1", replay, None, None),  # valid now
        (4, "tool_call", None, "i1", None, None, None), (5, "recovery_requested", "a1", "i1", replay, None, None),
        (6, "tool_call", None, "i1", None, None, "second"), (7, "recovery_requested", "a1", "i1", replay, None, None),  # stale later
        (8, "recovery_approved", "a1", "i1", restore, hash_of("second"), None),  # the last approval counts
        (9, "recovery_requested", "a1", "i1", replay, None, None), (10, "recovery_requested", "a1", "i1", restore, None, None),
        (11, "recovery_started", "a1", "i1", restore, None, None), (12, "recovery_requested", "a1", "i1", restore, None, None),
        (13, "recovery_result", "a1", "i1", restore, None, None), (14, "recovery_requested", "a1", "i1", restore, None, None),
        (15, "recovery_requested", "a1", "i2", restore, None, None), (16, "recovery_requested", None, "i1", restore, None, None),
        (17, "recovery_requested", "a9", "i1", restore, None, None), (18, "recovery_requested", "a1", "i1", "drop_table", None, None),
        (19, "recovery_requested", "a1", "i1", None, None, None), (20, "incident_opened", None, "i1", None, None, None),
        (21, "recovery_requested", "a1", "i1", restore, None, None)]
    fields = "seq int, event string, approval_id string, incident_id string, action string, payload_sha256 string, evidence_payload string"
    got = {r["seq"]: r["decision"] for r in monitor.audit_approvals(spark.createDataFrame(log, fields).repartition(3)).collect()}
    assert got == {
        3: "approved", 5: "approved", 7: "approval_payload_mismatch", 9: "approval_action_mismatch", 10: "approved",
        12: "recovery_outcome_unknown", 14: "approval_already_used", 15: "approval_incident_mismatch", 16: "no_approval", 17: "no_approval",
        18: "prohibited_action", 19: "unknown_recovery_action", 21: "approval_payload_mismatch"}


# -- inferred types ----------------------------------------------------------------

@pytest.mark.parametrize("values, want", [
    ([], "string"), ([None, "", "  "], "string"), (["true", " false ", None], "boolean"), (["True"], "string"), (["1", "-20", "0"], "bigint"),
    (["007", "1"], "string"), (["1", "2.50"], "decimal(3,2)"), (["-12.5", "100"], "decimal(4,1)"), (["1." + "1" * 38], "string"),
    (["2026-01-05", "2026-02-28"], "date"), (["2026-02-30"], "string"), (["2026-01-05", "2026-01-05 10:00:00"], "timestamp_ntz"),
    (["2026-01-05", "1"], "string"), (["true", "1"], "string"), (["1e5"], "string"), (["9" * 18], "bigint"), (["9" * 19], "string")])
def test_inferred_types(spark, values, want):
    texts = spark.createDataFrame([(v,) for v in values], "c string")
    assert inference.types_of(inference.profile(texts)) == {"c": want}


def test_types_widen_when_more_rows_arrive(spark):
    first = spark.createDataFrame([("1", "2026-01-05", "x"), ("", None, None)], "n string, d string, `odd name` string")
    second = spark.createDataFrame([("2.25", "2026-01-06 01:02:03", "true")], "n string, d string, extra string")
    parts = [inference.profile(first), inference.profile(second)]
    types = inference.types_of(inference.merge(*parts))
    assert types == inference.types_of(inference.merge(*reversed(parts))) == {
        "n": "decimal(3,2)", "d": "timestamp_ntz", "odd name": "string", "extra": "boolean"}
    rows = inference.typed(first, types).unionByName(inference.typed(second, types)).collect()
    assert [r["n"] for r in rows] == [Decimal("1.00"), None, Decimal("2.25")]
    assert rows[0]["d"] == dt.datetime(2026, 1, 5) and rows[0]["extra"] is None and rows[2]["extra"] is True and rows[2]["odd name"] is None


# -- histories and lookups ---------------------------------------------------------

def test_stretches_of_equal_columns(spark):
    a, ab = ["a"], ["a", "b"]
    runs = [("d", 1, a), ("d", 2, a), ("d", 3, None), ("d", 4, ab), ("d", 5, a), ("e", 1, ab)]
    got = monitor.schema_history(spark.createDataFrame(runs, "dataset_id string, run_seq bigint, columns array<string>")).collect()
    assert sorted((r["dataset_id"], r["stretch"], r["first_run"], r["last_run"], r["runs"], r["added"], r["removed"]) for r in got) == [
        ("d", 1, 1, 2, 2, [], []), ("d", 2, 4, 4, 1, ["b"], []), ("d", 3, 5, 5, 1, [], ["b"]), ("e", 1, 1, 1, 1, [], [])]


def test_lookups_name_what_is_missing(spark):
    audit = spark.createDataFrame([("r1", "succeeded"), ("r2", "failed")], "run_id string, status string")
    asked = spark.createDataFrame([("r2",), ("r2",), ("nowhere",)], "run_id string")
    assert {(r["run_id"], r["found"], r["status"]) for r in monitor.runs_by_id(audit, asked).collect()} == {
        ("r2", True, "failed"), ("nowhere", False, None)}
    rows = spark.createDataFrame([("s", 1), ("s", 3), ("s", 2), ("t", 9)], "source string, n int")
    found = monitor.of_sources(rows, spark.createDataFrame([("s",), ("u",)], "source string"), "n", 2).collect()
    assert sorted(tuple(r) for r in found) == [("s", 2), ("s", 3)]


def test_the_newest_report_of_a_check(spark, tmp_path):
    log = AppendLog(spark, str(tmp_path / "runs"), reconcile.RUN_DDL)
    for run, passed in (("1", True), ("2", False), ("1", False)):  # run 1 is done again
        log.append(spark.createDataFrame([(run, "c", passed, json.dumps({"n": run}))], reconcile.RUN_DDL), f"c~{run}")
    row = monitor.newest_reports(log.read()).first()
    assert (row["run_id"], row["passed"], row["runs"], row["failed"]) == ("1", False, 2, 2)


def test_evaluation_of_nothing_and_of_unknown_labels(spark):
    fields = "day bigint, defect string, rule string, reported boolean, cited boolean, injected bigint, detected bigint"
    empty = {(r["level"], r["defect"]): r for r in evaluate.summary(spark.createDataFrame([], fields), ("A", "B")).collect()}
    assert set(empty) == {("overall", None), ("defect", "A"), ("defect", "B")}
    assert all(r["cases"] == 0 and r["accuracy"] == r["recall"] == r["cited_share"] == 0.0 for r in empty.values())
    rows = [(1, "A", "A", True, True, 4, 4), (1, "A", None, True, False, 2, 0), (2, "C", "A", False, True, 0, 0)]
    got = {(r["level"], r["defect"], r["day"]): r for r in evaluate.summary(spark.createDataFrame(rows, fields), ("A", "B")).collect()}
    whole = got["overall", None, None]
    assert (whole["cases"], whole["correct"], whole["unlabelled"], whole["reported"], whole["routed"], whole["cited"]) == (3, 1, 1, 2, 1, 1)
    assert got["defect", "A", None]["accuracy"] == 0.5 and got["defect", "B", None]["cases"] == 0 and got["day", None, 2]["accuracy"] == 0.0
    assert whole["recall"] == pytest.approx(4 / 6) and len(got) == 1 + 3 + 2


# -- parity ------------------------------------------------------------------------

def test_order_only_and_other_rows(spark):
    t = spark.createDataFrame([(1, "x"), (2, "x"), (3, None), (4, "y")], "id int, s string")
    read = lambda sql, order=None: reconcile.compare_queries(spark, sql, "SELECT s, id FROM {t}", order, t=t)
    by_id = (["id"], ["id"])
    assert read("SELECT s, id FROM {t}", by_id).verdict().first()["status"] == "validated"
    moved = read("SELECT s, id FROM {t}", (["-id"], ["id"])).verdict().first()
    assert (moved["status"], moved["order_only"], moved["expected_not_produced"]) == ("mismatch", True, 0)
    other = read("SELECT if(id = 3, 'z', s) AS s, id FROM {t} UNION ALL SELECT s, id FROM {t} WHERE id = 4")
    row = other.verdict().first()
    assert (row["status"], row["order_only"], row["expected_not_produced"], row["produced_not_expected"]) == ("mismatch", False, 1, 2)
    assert [(r["direction"], r["row"], r["copies"]) for r in other.samples(5).collect()] == [
        ("expected_not_produced", [None, "3.00"], 1), ("produced_not_expected", ["y", "4.00"], 1), ("produced_not_expected", ["z", "3.00"], 1)]
    # Equal rows that stand elsewhere show by their other columns only.
    twice = reconcile.compare_queries(spark, "SELECT s FROM {t}", "SELECT s FROM {t}", t=t).verdict().first()
    assert twice["status"] == "validated" and twice["rows_compared"] == 4


def test_only_faults_of_the_query_are_execution_errors(spark, monkeypatch):
    t = spark.createDataFrame([(1, "x")], "id int, s string")
    for sql in ("SELEC 1", "SELECT nope FROM {t}", "SELECT 1 div (id - 1) AS id FROM {t}", "SELECT cast(s AS date) AS id FROM {t}"):
        found = reconcile.compare_queries(spark, sql, "SELECT id FROM {t}", t=t)
        assert found.verdict().first()["status"] == "execution_error" and found.samples().collect() == []

    class Full(PySparkException):
        pass

    def broken(df, label, *more):
        if label == "parity":
            raise Full("no space left")
        return df

    monkeypatch.setattr(reconcile, "stage", broken)
    with pytest.raises(Full):
        reconcile.compare_queries(spark, "SELECT id FROM {t}", "SELECT id FROM {t}", t=t)


# -- streams and rows --------------------------------------------------------------

def test_counters_of_every_batch_are_rows(spark, tmp_path):
    rules = {"positive": "x > 0", "small": "x < 10"}
    log = AppendLog(spark, str(tmp_path / "metrics"), metrics.METRICS_DDL)
    for values in ([1, 0, None], [50, 60], []):
        if values:
            spark.createDataFrame([(v,) for v in values], "x int").write.mode("append").parquet(str(tmp_path / "in"))
        stream = land.read_incrementally(spark, str(tmp_path / "in"), spark.createDataFrame([], "x int").schema)
        with metrics.recorded(spark, "numbers", rules, log):
            land.validate(stream, rules, str(tmp_path / "out"), str(tmp_path / "cp"), metrics="numbers").awaitTermination()
    assert {(r["batch_id"], r["rule"], r["passed"], r["failed"]) for r in log.read().collect()} == {
        (0, "positive", 1, 2), (0, "small", 2, 1), (1, "positive", 2, 0), (1, "small", 0, 2)}


def test_every_delivered_row_is_accounted_for(spark, tmp_path):
    store = IngestStore(spark, str(tmp_path / "store"))
    rows = lambda *r: spark.createDataFrame(list(r), "id string, v string, at string")
    first = [("1", "1", "2026-01-01 00:00:00"), ("2", "x", "2026-01-05 00:00:00"), ("3", "1", "2026-01-05 00:00:00")]
    second = [*first, ("1", "2", "2026-01-06 00:00:00"), ("3", "1", "2026-01-05 00:00:00"), ("4", "9", "2026-01-02 00:00:00"),
              ("5", "y", "2026-01-02 00:00:00"), ("", "1", "2026-01-06 00:00:00"), ("6", "1", "2026-01-05 12:00:00"), ("6", "2", "2026-01-05 12:00:00")]
    for extract in (first, second):
        ingest.run_ingestion(SPEC, rows(*extract), store)
    found = ingest.row_accounting(SPEC, rows(*second), store.table(SPEC), store.quarantine.read())
    got = {(json.loads(r["raw"])["id"], json.loads(r["raw"])["v"]): (r["outcome"], r["copies"]) for r in found.collect()}
    assert got == {
        ("1", "1"): ("superseded", 1), ("2", "x"): ("quarantined", 1), ("3", "1"): ("accepted", 2), ("1", "2"): ("accepted", 1),
        ("4", "9"): ("never_read", 1), ("5", "y"): ("never_read", 1), ("", "1"): ("quarantined", 1),
        ("6", "1"): ("quarantined", 1), ("6", "2"): ("quarantined", 1)}


def test_routing_follows_the_tables(spark, sf_dir, tmp_path):
    from tidegate.plans import routing

    for name in ("events", "customer"):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        if name == "events":
            rows = rows.withColumn("value", -F.col("value"))
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
    before, after = ({r["id"]: r["severe"] for r in routing.routing_records(spark, d).collect()} for d in (sf_dir, str(tmp_path)))
    assert set(before) == set(after) and sum(after.values()) > sum(before.values())
