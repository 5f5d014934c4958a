"""Contracts and incremental ingestion on small literal extracts."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tidegate.operators import contracts, ingest
from tidegate.operators.ingest import IngestStore
from tidegate.sources.partitioned import Landing, PartitionedTarget
from tidegate.sources.specs import SpecError, load_specs, parse_spec

RAW = {
    "dataset_id": "t.items", "contract_version": "v1", "source": {"type": "csv", "table": "items"},
    "ingestion": {"mode": "incremental", "cursor_column": "updated_at", "primary_key": ["id"],
                  "deletion_strategy": "tombstone", "max_quarantine_ratio": 0.5},
    "target": {"bronze_name": "bronze_items"},
    "columns": {"id": {"type": "int", "required": True}, "price": {"type": "decimal", "required": True},
                "updated_at": {"type": "timestamp", "required": True}, "is_deleted": {"type": "bool"}},
}


def spec(**ingestion):
    return parse_spec({**RAW, "ingestion": {**RAW["ingestion"], **ingestion}})


def extract(spark, *rows, columns=("id", "price", "updated_at", "is_deleted")):
    full = [tuple((*r, None)[:len(columns)]) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in columns))


@pytest.fixture
def store(spark, tmp_path):
    return IngestStore(spark, str(tmp_path / "store"))


def prices(store, s):
    return {r["id"]: r["price"] for r in store.target(s).collect()}


@pytest.mark.parametrize("text, want", [
    ("19.999", "20.00"), ("2.345", "2.34"), ("2.355", "2.36"), ("1e3", "1000.00"), (" 7 ", "7.00"), ("+5", "5.00"),
    ("N/A", None), ("NaN", None), ("Infinity", None), ("1" * 40, None), ("1,5", None)])
def test_decimal_cast(spark, text, want):
    row = contracts.validate(spec(), extract(spark, ("1", text, "2026-01-01 00:00:00"))).first()
    assert row["price"] == (Decimal(want) if want else None)
    assert row["_problems"] == ([] if want else [("price", "cast_failed")])


@pytest.mark.parametrize("column, text, ok", [
    ("id", "-5", True), ("id", "+5", False), ("id", "5.0", False), ("id", "--5", False), ("id", "9" * 25, False),
    ("updated_at", "2026-01-02", True), ("updated_at", "2026-01-02T03:04:05.123456", True),
    ("updated_at", "2026-01-02 03:04:05+01:00", False), ("updated_at", "2026-1-2", False), ("updated_at", "2026", False),
    ("updated_at", "2026-02-30 00:00:00", False), ("is_deleted", "TRUE", True), ("is_deleted", "yes", False),
    ("is_deleted", "", True)])
def test_guarded_casts(spark, column, text, ok):
    values = {"id": "1", "price": "1", "updated_at": "2026-01-01 00:00:00", "is_deleted": None, column: text}
    row = contracts.validate(spec(), extract(spark, tuple(values.values()))).first()
    assert (row["_problems"] == []) is ok


def test_all_problems_of_a_row_are_listed(spark):
    row = contracts.validate(spec(), extract(spark, (" ", "x", None, "maybe"))).first()
    assert [tuple(p) for p in row["_problems"]] == [
        ("id", "null_primary_key"), ("price", "cast_failed"), ("updated_at", "missing_required"),
        ("is_deleted", "cast_failed")]
    assert json.loads(row["_raw"]) == {"id": " ", "price": "x", "updated_at": None, "is_deleted": "maybe"}


def test_rows_that_share_a_timestamp_are_not_skipped(spark, store):
    at = "2026-01-01 10:00:00"
    ingest.run_ingestion(spec(), extract(spark, ("1", "1", at), ("2", "1", at)), store)
    run = ingest.run_ingestion(spec(), extract(spark, ("1", "1", at), ("2", "1", at), ("3", "1", at)), store)
    assert (run["inserted"], run["rows_new"], run["unchanged"]) == (1, 1, 2)
    assert run["watermark_after"] == f"{at}|3"


def test_lookback_takes_late_rows_and_keeps_newer_ones(spark, store):
    s = spec(lookback_hours=24)
    ingest.run_ingestion(s, extract(spark, ("1", "5", "2026-01-01 20:00:00")), store)
    run = ingest.run_ingestion(s, extract(spark, ("1", "5", "2026-01-01 20:00:00"), ("2", "1", "2026-01-01 08:00:00"),
                                          ("1", "1", "2026-01-01 09:00:00")), store)
    assert (run["inserted"], run["unchanged"]) == (1, 2)
    assert prices(store, s) == {1: Decimal("5.00"), 2: Decimal("1.00")}


def test_late_beyond_the_lookback_is_neither_merged_nor_quarantined(spark, store):
    ingest.run_ingestion(spec(), extract(spark, ("1", "5", "2026-01-02 00:00:00")), store)
    run = ingest.run_ingestion(spec(), extract(spark, ("2", "5", "2026-01-01 00:00:00"), ("3", "x", "2026-01-01 00:00:00"),
                                               ("4", "5", "no time")), store)
    assert (run["rows_in_window"], run["quarantined"], run["failure_code"]) == (1, 1, "quarantine_ratio_exceeded")


def test_breaker_changes_nothing(spark, store):
    good = spec(max_quarantine_ratio=0.1)
    ingest.run_ingestion(good, extract(spark, ("1", "5", "2026-01-01 00:00:00")), store)
    run = ingest.run_ingestion(good, extract(spark, ("1", "7", "2026-01-02 00:00:00"), ("2", "x", "2026-01-02 00:00:00")),
                               store)
    assert (run["status"], run["failure_code"]) == ("failed", "quarantine_ratio_exceeded")
    assert prices(store, good) == {1: Decimal("5.00")} and store.watermark(good).key == ("1",)
    assert store.quarantine.read().count() == 1


def test_a_ratio_at_the_limit_passes(spark, store):
    run = ingest.run_ingestion(spec(), extract(spark, ("1", "5", "2026-01-01 00:00:00"), ("2", "x", "2026-01-01 00:00:00")),
                               store)
    assert run["status"] == "succeeded_with_quarantine" and run["quarantine_reasons"] == {"price:cast_failed": 1}


def test_schema_drift(spark, store):
    run = ingest.run_ingestion(spec(), extract(spark, ("1", "2026-01-01 00:00:00"), columns=("id", "updated_at")), store)
    assert run["failure_code"] == "schema_required_column_missing" and store.target(spec()).count() == 0
    run = ingest.run_ingestion(spec(), extract(spark, ("1", "5", "2026-01-01 00:00:00", "EUR"),
                                               columns=("id", "price", "updated_at", "currency")), store)
    assert run["status"] == "succeeded" and run["schema_diff"]["added"] == ["currency"]


def test_tombstones_and_conflicts(spark, store):
    s = spec(max_quarantine_ratio=0.9)
    ingest.run_ingestion(s, extract(spark, ("1", "5", "2026-01-01 00:00:00")), store)
    run = ingest.run_ingestion(s, extract(
        spark, ("1", "5", "2026-01-02 00:00:00", "true"), ("2", "1", "2026-01-02 00:00:00"),
        ("2", "2", "2026-01-02 00:00:00")), store)
    assert (run["deleted"], run["quarantined"], run["quarantine_reasons"]) == (1, 2, {"id:duplicate_key": 2})
    assert ingest.live_rows(store.target(s)).count() == 0


def test_equal_typed_copies_collapse(spark, store):
    run = ingest.run_ingestion(spec(), extract(spark, ("1", "1.0", "2026-01-01 00:00:00"), ("01", "1.00", "2026-01-01")),
                               store)
    assert (run["rows_in_window"], run["inserted"], run["quarantined"]) == (1, 1, 0)


def test_versions_of_one_key_in_one_batch(spark, store):
    run = ingest.run_ingestion(spec(), extract(
        spark, ("1", "1", "2026-01-01", "true"), ("1", "2", "2026-01-02"), ("2", "1", "2026-01-01"),
        ("2", "2", "2026-01-02"), ("2", "3", "2026-01-03", "true"), ("2", "4", "2026-01-04")), store)
    assert (run["inserted"], run["updated"], run["deleted"]) == (1, 3, 2)
    again = ingest.run_ingestion(spec(lookback_hours=999), extract(
        spark, ("1", "1", "2026-01-01", "true"), ("1", "2", "2026-01-02"), ("2", "4", "2026-01-04")), store)
    assert (again["unchanged"], again["rows_new"], again["watermark_after"]) == (3, 0, run["watermark_after"])


def test_a_run_that_died_before_its_audit_record_is_done_again(spark, store, monkeypatch):
    s, rows = spec(), (("1", "1", "2026-01-01"), ("2", "2", "2026-02-01"))

    def die(record):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken, pytest.raises(RuntimeError):
        broken.setattr(store, "save_audit", die)
        ingest.run_ingestion(s, extract(spark, *rows), store)
    assert store.watermark(s) is None and len(prices(store, s)) == 2
    run = ingest.run_ingestion(s, extract(spark, *rows), store)
    assert (run["run_seq"], run["unchanged"], run["inserted"]) == (1, 2, 0)
    assert prices(store, s) == {1: Decimal("1.00"), 2: Decimal("2.00")} and store.watermark(s).key == ("2",)


def test_one_changed_row_rewrites_one_folder(spark, store, tmp_path):
    s = spec()
    ingest.run_ingestion(s, extract(spark, *[(str(i), "1", f"2026-{i:02d}-01 00:00:00") for i in range(1, 10)]), store)
    files = lambda: {str(f) for f in (tmp_path / "store" / "t.items").rglob("*.parquet")}
    before = files()
    run = ingest.run_ingestion(s, extract(spark, ("3", "5", "2026-11-01 00:00:00")), store)
    assert run["updated"] == 1 and prices(store, s)[3] == Decimal("5.00") and len(prices(store, s)) == 9
    # The row stays in the range of its first version; all other folders keep their files.
    assert {f.split("_range=")[1][:7] for f in before ^ files()} == {"2026-03"}


def test_a_window_opens_only_its_folders(spark, store, tmp_path):
    s = spec(lookback_hours=24)
    landing = Landing(spark, str(tmp_path / "landing"), "updated_at", width="yyyy-MM-dd")
    first = [("1", "1", "2026-01-01 10:00:00"), ("2", "1", "2026-01-05 10:00:00")]
    ingest.run_ingestion(s, landing.deliver(extract(spark, *first)), store)
    landing.deliver(extract(spark, *first, ("3", "x", "no time"), ("4", "2", "2026-01-04T09:00:00"), ("5", "2", "2026-01-06"),
                            ("6", "2", "2026-01-04 10:00:00")))
    # A file that cannot be read, in a folder before the window.
    for file in (tmp_path / "landing" / "_range=2026-01-01").glob("*.parquet"):
        file.write_bytes(b"PAR1 broken PAR1")
    window = landing.since("2026-01-04 10:00:00")
    assert "PartitionFilters: [isnotnull(_range" in window._jdf.queryExecution().executedPlan().toString()
    assert {r["id"] for r in ingest.window_rows(s, window, store.watermark(s)).collect()} == {2, 3, 5, 6}
    assert landing.columns == ["id", "price", "updated_at", "is_deleted"]


def test_landing_without_a_cursor_column(spark, store, tmp_path):
    landing = Landing(spark, str(tmp_path / "landing"), "updated_at").deliver(extract(spark, ("1", "1"), columns=("id", "price")))
    run = ingest.run_ingestion(spec(), landing, store)
    assert (run["failure_code"], run["rows_in_source"]) == ("schema_required_column_missing", 1)
    with pytest.raises(ValueError):
        IngestStore(spark, str(tmp_path / "other"), width="week")


def test_ranges_of_odd_rows(spark, tmp_path):
    schema = T.StructType.fromDDL("k int, d date, v string")
    table = PartitionedTarget(spark, str(tmp_path / "t"), schema, ("k",), "coalesce(date_format(d, 'yyyy-MM'), 'none')")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, d date, v string, _home string")
    assert table.put(rows()) == []
    assert table.put(rows((1, None, "a", None), (None, dt.date(2026, 1, 5), "b", None))) == ["2026-01", "none"]
    stored = table.stored(rows((None, None, None, None), (1, None, None, None)), "v")
    assert {tuple(r) for r in stored.collect()} == {(1, "a", "none"), (None, "b", "2026-01")}
    assert table.put(rows((None, dt.date(2027, 1, 1), "c", "2026-01"))) == ["2026-01"]
    assert {tuple(r) for r in table.rows().collect()} == {(1, None, "a"), (None, dt.date(2027, 1, 1), "c")}


def test_rejected_rows_carry_the_time_of_their_append(spark, store):
    ingest.run_ingestion(spec(), extract(spark, ("1", "1", "2026-01-01"), ("2", "x", "2026-01-01")), store)
    row = store.quarantine.read("t.items:run:1").first()
    assert row["saved_ts"] is not None and row["run_id"] == "t.items:run:1"
    assert store.quarantine.read("t.items:run:2").count() == 0 and store.audit.read().first()["saved_ts"] is not None


def test_an_empty_extract_is_a_success(spark, store):
    run = ingest.run_ingestion(spec(), spark.createDataFrame(
        [], "id string, price string, updated_at string"), store)
    assert (run["status"], run["rows_in_window"], run["watermark_after"]) == ("succeeded", 0, None)


def test_replay_merge_counts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "x"), (4, "n")], "id int, v string")
    merged, counts = ingest.replay_merge(old, new, "id")
    assert counts.first().asDict() == {"inserted": 1, "updated": 1, "unchanged": 1, "stale": 1}
    assert {tuple(r) for r in merged.collect()} == {(1, "a"), (2, "x"), (3, None), (4, "n")}


@pytest.mark.parametrize("path, value", [
    (("columns", "id", "type"), "uuid"), (("columns", "id", "required"), False), (("ingestion", "mode"), "magic"),
    (("ingestion", "deletion_strategy"), "purge"), (("ingestion", "max_quarantine_ratio"), 1.0),
    (("ingestion", "cursor_column"), "price"), (("ingestion", "primary_key"), ["nope"])])
def test_bad_contracts_are_refused(path, value):
    raw = json.loads(json.dumps(RAW))
    place = raw
    for step in path[:-1]:
        place = place[step]
    place[path[-1]] = value
    with pytest.raises(SpecError):
        parse_spec(raw)


def test_contract_files(tmp_path):
    with pytest.raises(SpecError):
        load_specs(str(tmp_path))
    (tmp_path / "a.json").write_text(json.dumps(RAW))
    assert list(load_specs(str(tmp_path))) == ["t.items"]
    (tmp_path / "b.json").write_text(json.dumps(RAW))
    with pytest.raises(SpecError):
        load_specs(str(tmp_path))
    enum = json.loads(json.dumps(RAW))
    enum["columns"]["id"] = {"type": "enum", "required": True}
    with pytest.raises(SpecError):
        parse_spec(enum)


def test_restore_refuses_rows_that_left_the_contract(spark):
    good = extract(spark, ("1", "5.00", "2026-01-01 00:00:00"))
    assert contracts.restore(spec(), good).first()["price"] == Decimal("5.00")
    with pytest.raises(Exception, match="matches_contract"):
        contracts.restore(spec(), extract(spark, ("1", "five", "2026-01-01 00:00:00"))).collect()


def test_rows_alone_with_their_key_are_planned_without_moving(spark, store):
    s = spec()
    ingest.run_ingestion(s, extract(spark, *[(str(i), "1", "2026-01-05") for i in range(0, 40, 3)]), store)
    mark, table = store.watermark(s), store.table(s)
    rows = [(str(i), "2", f"2026-01-0{1 + i % 9}", "true" if i % 5 == 0 else None) for i in range(40)]
    rows += [(str(i), "3", "2026-01-08") for i in range(0, 40, 4)] + [("7", "9", f"2026-01-0{1 + 7 % 9}"), ("x", "1", "2026-01-01")]
    checked = ingest.window_rows(s, extract(spark, *rows), None)
    single, groups = ingest.single_rows(s, checked)
    assert {r["id"] for r in single.collect()} == {i for i in range(40) if i % 4 and i != 7}
    whole = ingest.merge_plan(s, ingest.accepted_rows(s, ingest.cursor_groups(s, checked)), table, mark)
    parts = ingest.single_plan(s, single, table, mark).unionByName(
        ingest.merge_plan(s, ingest.accepted_rows(s, groups), table, mark))
    assert sorted(map(str, parts.collect())) == sorted(map(str, whole.collect()))
    empty = IngestStore(spark, store.root + "-empty").table(s)
    assert "Exchange hashpartitioning" not in ingest.single_plan(s, checked, empty, None)._jdf.queryExecution().executedPlan().toString()


def test_rows_of_few_ranges_are_written_where_they_lie(spark, tmp_path):
    many = extract(spark, *[(str(i), "1", f"20{20 + i % 6}-01-01 00:00:00") for i in range(60)]).repartition(3)
    landing = Landing(spark, str(tmp_path / "landing"), "updated_at", width="yyyy").deliver(many)
    files = list((tmp_path / "landing").rglob("*.parquet"))
    assert landing.count() == 60 and len({f.parent.name for f in files}) == 6 and len(files) == 18  # a file for each task and folder
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_the_second_day_is_accounted_from_its_landing(spark, tmp_path, monkeypatch):
    from tidegate.plans import ingest_queries, reconcile_queries
    from tidegate.sources import derived

    at = dt.datetime(1998, 5, 1)
    spark.createDataFrame(
        [(i, 1, "F", at + dt.timedelta(days=i), 50000.0) for i in range(1, 13)], "o_orderkey long, o_custkey long, o_orderstatus string,"
        " o_orderdate timestamp_ntz, o_totalprice double").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(i, float(n) + 0.5, i * 1000.29 + n / 100) for i in range(1, 13) for n in range(1, 4)]
    spark.createDataFrame(lines, "l_orderkey long, l_quantity double, l_extendedprice double").write.parquet(str(tmp_path / "lineitem.parquet"))
    made = derived.payment_extract(spark, str(tmp_path), derived.SECOND_DAY)
    want = {i: sum(int(q) * Decimal(repr(round(p, 2))) for k, q, p in lines if k == i) for i in range(1, 13)}
    assert {int(r["order_id"]): Decimal(r["amount"]) for r in made.collect()} == want
    monkeypatch.setattr(derived, "payment_extract", None)  # only the landings derive it
    rows = ingest_queries.row_accounting(spark, str(tmp_path))
    assert {(r["copies"], r["outcome"]) for r in rows.collect()} == {(1, "accepted")}
    assert reconcile_queries.source_to_target(spark, str(tmp_path)).first()["passed"]
