"""Quarantine, expectations and the gate on small literal frames."""

import time

import pytest
from pyspark.sql import functions as F

from tidegate.functions.codes import codes_where
from tidegate.operators import evidence, expectations, gate, quarantine
from tidegate.sources.partitioned import AppendLog
from tidegate.sources.versions import VersionedTable

LEADS = "lead_id bigint, campaign_id bigint, stage string, email_domain string, _row_id bigint"


def leads(spark, rows):
    return spark.createDataFrame([(*r[:3], "x.com", i) for i, r in enumerate(rows)], LEADS)


def campaigns(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "campaign_id bigint")


def reasons(flagged):
    return {r["_row_id"]: r["_reasons"] for r in flagged.collect()}


def test_a_duplicate_keeps_its_other_reason(spark):
    flagged = quarantine.flag_leads(leads(spark, [(1, None, "new"), (1, None, "new")]), campaigns(spark, 1))
    assert reasons(flagged) == {0: ["null_campaign_id"], 1: ["null_campaign_id", "duplicate_lead_id"]}
    assert quarantine.accepted(flagged).count() == 0


def test_every_rule_and_null(spark):
    rows = [(1, 1, " won "), (2, 9, "new"), (3, 1, None), (4, 1, "stale"), (None, 1, "new"), (None, 1, "new")]
    flagged = quarantine.flag_leads(leads(spark, rows), campaigns(spark, 1))
    assert reasons(flagged) == {0: [], 1: ["unknown_campaign_id"], 2: ["invalid_stage"], 3: ["invalid_stage"],
                                4: [], 5: ["duplicate_lead_id"]}


def test_a_quarantined_first_arrival_still_claims_its_key(spark):
    flagged = quarantine.flag_leads(leads(spark, [(1, None, "new"), (1, 1, "new")]), campaigns(spark, 1))
    assert reasons(flagged)[1] == ["duplicate_lead_id"]


def test_a_repeated_dimension_key_does_not_multiply_rows(spark):
    flagged = quarantine.flag_leads(leads(spark, [(1, 1, "new")]), campaigns(spark, 1, 1, 1))
    assert flagged.count() == 1


def test_result_does_not_depend_on_partitioning(spark):
    rows = [(i % 40, None if i % 3 == 0 else i % 5, "new") for i in range(200)]
    frame = leads(spark, rows)
    one = reasons(quarantine.flag_leads(frame, campaigns(spark, 1, 2)))
    other = reasons(quarantine.flag_leads(frame.orderBy(F.rand(3)).repartition(7), campaigns(spark, 1, 2)))
    assert one == other


def test_a_hot_key_is_flagged_whole(spark):
    frame = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 1, id) AS lead_id", "if(id % 3 = 1, cast(null as bigint), 1) AS campaign_id",
        "'new' AS stage", "'x' AS email_domain", "id AS _row_id")
    flagged = quarantine.flag_leads(frame, campaigns(spark, 1))
    counts = {r["reason"]: r["row_count"] for r in quarantine.reason_counts({"leads": flagged}).collect()}
    assert counts["null_campaign_id"] == 1000 and counts["duplicate_lead_id"] == 1000
    assert flagged.count() == 3000


def status_of(spark, rows, bad, **changes):
    row = {"source": "leads", "total": rows, "quarantined": bad, "accepted_rows": rows - bad,
           "quarantined_rows": bad, "quarantine_rate": bad / rows, "gate_passed": bad / rows <= 0.1,
           "conserved": True, **changes}
    frame = spark.createDataFrame([row], "source string, total bigint, quarantined bigint, accepted_rows bigint,"
                                  " quarantined_rows bigint, quarantine_rate double, gate_passed boolean,"
                                  " conserved boolean")
    return frame.withColumn("_computed_ts", F.current_timestamp())


def problems(status, start=1_000, required=("leads",)):
    return {r["source"]: r["problems"] for r in gate.verdict(status, start, required).collect()}


def test_gate_counts_rows_not_reasons(spark):
    rows = [(i, 1, "new") for i in range(90)] + [(i, None, "new") for i in range(10)]
    frame = leads(spark, rows)
    persisted = quarantine.with_outcome(quarantine.flag_leads(frame, campaigns(spark, 1)))
    row = gate.gate_status({"leads": frame}, {"leads": persisted}).first()
    assert (row["total"], row["quarantined"], row["quarantine_rate"]) == (100, 10, 0.1)
    assert row["gate_passed"] and row["conserved"]


def test_a_lost_row_is_not_conserved(spark):
    frame = leads(spark, [(i, 1, "new") for i in range(20)])
    persisted = quarantine.with_outcome(quarantine.flag_leads(frame, campaigns(spark, 1)))
    row = gate.gate_status({"leads": frame}, {"leads": persisted.filter("lead_id > 0")}).first()
    assert row["gate_passed"] and not row["conserved"]


@pytest.mark.parametrize("changes, part", [
    ({"gate_passed": None}, "gate_passed: null"), ({"gate_passed": False}, "gate_passed: false"),
    ({"conserved": None}, "conserved: null"), ({"conserved": False}, "conserved: false"),
    ({"total": None}, "total: null"), ({"total": 0}, "total: empty")])
def test_verdict_fails_closed(spark, changes, part):
    assert any(p.startswith(part) for p in problems(status_of(spark, 100, 5, **changes))["leads"])


def test_verdict_on_missing_repeated_and_stale_rows(spark):
    good = status_of(spark, 100, 5)
    assert problems(good) == {"leads": []}
    assert problems(good, required=("leads", "web_events"))["web_events"] == ["missing: no gate_status row"]
    assert problems(good.unionByName(good))["leads"][0].startswith("ambiguous")
    assert problems(good, start=int(time.time() * 1000) + 3_600_000)["leads"] == [
        "freshness: computed before this run"]
    assert problems(good, start=None)["leads"] == ["run_boundary: missing or invalid"]
    assert not gate.passed(gate.verdict(good, 1000, ()))


def test_freshness_at_the_run_start_counts(spark):
    at = 1_700_000_000_000
    status = status_of(spark, 10, 0).withColumn("_computed_ts", F.timestamp_millis(F.lit(at)))
    assert problems(status, start=at)["leads"] == [] and problems(status, start=at + 1)["leads"] != []


@pytest.mark.parametrize("value", [0, -1, True, "", "12a", "-5", 1.5, None])
def test_run_start_must_be_positive_epoch_ms(spark, value):
    status = status_of(spark, 10, 0)
    with pytest.raises(Exception, match="epoch milliseconds"):
        gate.evidence_record(status, gate.verdict(status, 1000, ("leads",)), value).collect()


def test_withheld_publish_keeps_the_old_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "gold"))
    good, bad = status_of(spark, 10, 0), status_of(spark, 10, 5)
    gate.publish(spark.range(3), table, gate.verdict(good, 1000, ("leads",)))
    with pytest.raises(gate.PublicationWithheld):
        gate.publish(spark.range(9), table, gate.verdict(bad, 1000, ("leads",)))
    assert table.read().count() == 3


def test_evidence_log_is_retry_safe(spark, tmp_path):
    status = status_of(spark, 10, 0)
    record = evidence.gate_and_redact(gate.evidence_record(status, gate.verdict(status, 1000, ("leads",)), 1000))
    log = AppendLog(spark, str(tmp_path / "log"), gate.EVIDENCE_SCHEMA)
    for _ in range(2):
        log.append(record, "1000")
    row = log.read().collect()
    assert len(row) == 1 and row[0]["passed"] and row[0]["sources"][0]["total"] == 10


RULES = {"positive": "x > 0", "small": "x < 10"}


def numbers(spark):
    return spark.createDataFrame([(1,), (0,), (None,), (10,), (9,)], "x int")


def test_expectations(spark):
    assert [r["x"] for r in expectations.drop_failing(numbers(spark), RULES).collect()] == [1, 9]
    marked = expectations.mark_failing(numbers(spark), RULES).collect()
    assert [r["_failed_rules"] for r in marked] == [[], ["positive"], ["positive", "small"], ["small"], []]
    counted = {r["rule"]: (r["passed"], r["failed"]) for r in expectations.rule_counts(numbers(spark), RULES).collect()}
    assert counted == {"positive": (3, 2), "small": (3, 2)}
    with pytest.raises(Exception, match="expectation failed"):
        expectations.fail_on(numbers(spark), RULES).count()


def test_codes_ignore_unknown_conditions(spark):
    row = spark.range(1).select(codes_where(("a", F.lit(None).cast("boolean")), ("b", F.lit(True))).alias("c")).first()
    assert row["c"] == ["b"]


def test_a_published_version_is_whole(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.commit(spark.range(100), by="a") == 1
    assert table.commit(spark.range(5)) == 2 and table.read().count() == 5 and table.manifest()["notes"] == {}


def test_staged_tables_lie_in_the_shared_folder(spark):
    from tidegate.session import scratch_path

    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
