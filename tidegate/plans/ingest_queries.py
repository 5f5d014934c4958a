"""Registered contract, ingestion and replay queries over the ledger extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions import inference
from tidegate.operators import contracts, ingest, monitor, quarantine
from tidegate.operators.ingest import IngestStore
from tidegate.plans import marketing
from tidegate.plans.present import plain
from tidegate.session import scratch_path, stage
from tidegate.sources import derived
from tidegate.sources.derived import FIRST_DAY, SECOND_DAY
from tidegate.sources.partitioned import YEAR, Landing
from tidegate.sources.specs import LEDGER, ORDER_LINES, ORDERS, PAYMENTS
from tidegate.sources.tables import table

EXTRACTS = {ORDERS.dataset_id: derived.order_extract, ORDER_LINES.dataset_id: derived.line_extract,
            PAYMENTS.dataset_id: derived.payment_extract}


#: The test tables hold few rows a month, so their ranges are years.
def new_store(spark: SparkSession) -> IngestStore:
    return IngestStore(spark, scratch_path(spark, "ingest"), width=YEAR)


def extract(spark, sf_dir, spec, through) -> Landing:
    """The extract as it lies at its source, in folders by cursor."""
    landing = Landing(spark, scratch_path(spark, "landing"), spec.cursor_column, width=YEAR)
    return landing.deliver(EXTRACTS[spec.dataset_id](spark, sf_dir, through))


def days_of(spark, sf_dir, spec) -> tuple[IngestStore, Landing]:
    """The store after two days, and the second day's extract as it lies at its source."""
    store = new_store(spark)
    for label, through in (("day1", FIRST_DAY), ("day2", SECOND_DAY)):
        landing = extract(spark, sf_dir, spec, through)
        ingest.run_ingestion(spec, landing, store, label)
    return store, landing


def two_days(spark, sf_dir, spec) -> IngestStore:
    return days_of(spark, sf_dir, spec)[0]


AUDIT_COUNTS = ("rows_in_source", "rows_in_window", "rows_new", "inserted", "updated", "unchanged", "deleted",
                "quarantined")


def audit_rows(store: IngestStore) -> DataFrame:
    """The audit log with its nested fields as text."""
    reasons = F.array_join(F.transform(F.array_sort(F.map_entries("quarantine_reasons")),
                                       lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return store.audit.read().select(
        "run_id", "dataset_id", "label", "contract_version", "status", "failure_code", *AUDIT_COUNTS,
        reasons.alias("reasons"), F.array_join("schema_diff.added", ",").alias("added"),
        F.array_join("schema_diff.removed", ",").alias("removed"),
        F.array_join("schema_diff.removed_required", ",").alias("removed_required"),
        "watermark_before", "watermark_after")


def contract_validate(spark, sf_dir):
    """Every order of the second day with its typed values and all of its problems."""
    checked = contracts.validate(ORDERS, derived.order_extract(spark, sf_dir, SECOND_DAY))
    problems = F.array_join(F.transform(
        contracts.PROBLEMS, lambda p: F.concat(p["column"], F.lit(":"), p["reason"])), ",")
    return checked.select("order_id", "customer_id", "status", "order_date", "updated_at", "is_deleted",
                          problems.alias("problems"))


def schema_drift(spark, sf_dir):
    """One run with an additional column, one without a required column."""
    store = new_store(spark)
    rows = derived.order_extract(spark, sf_dir, SECOND_DAY)
    ingest.run_ingestion(ORDERS, rows.withColumn("currency", F.lit("EUR")), store, "added")
    ingest.run_ingestion(ORDERS, rows.drop("customer_id"), store, "removed")
    return audit_rows(store).select("label", "status", "failure_code", "rows_in_source", "rows_in_window",
                                    "inserted", "added", "removed", "removed_required")


def _first_day_mark(spark, sf_dir):
    checked = ingest.window_rows(ORDERS, derived.order_extract(spark, sf_dir, FIRST_DAY), None)
    return ingest.newest_mark(ORDERS, ingest.accepted_rows(ORDERS, ingest.cursor_groups(ORDERS, checked)))


def ingest_window(spark, sf_dir):
    """Rows of the second day inside the lookback window, accepted or not; older folders of the landing stay closed."""
    mark = _first_day_mark(spark, sf_dir)
    delivered = extract(spark, sf_dir, ORDERS, SECOND_DAY).since(mark.floor(ORDERS.lookback_hours))
    rows = ingest.window_rows(ORDERS, delivered, mark)
    return rows.select("order_id", "customer_id", "updated_at", (F.size(contracts.PROBLEMS) == 0).alias("valid"))


def ingest_conflicts(spark, sf_dir):
    """Keys that arrive with one cursor and different contents."""
    checked = ingest.window_rows(ORDERS, derived.order_extract(spark, sf_dir, SECOND_DAY), None)
    groups = ingest.cursor_groups(ORDERS, checked).filter("_conflict")
    return groups.select("order_id", "updated_at", F.col("_copies").alias("copies"))


def ingest_reasons(spark, sf_dir):
    """Quarantine reasons of the whole second-day extract."""
    checked = stage(ingest.window_rows(ORDERS, derived.order_extract(spark, sf_dir, SECOND_DAY), None), "checked")
    return ingest.reason_histogram(ORDERS, checked, ingest.cursor_groups(ORDERS, checked))


def ingest_breaker(spark, sf_dir):
    """A second day over the allowed share of bad rows: the run fails and changes nothing."""
    store = new_store(spark)
    ingest.run_ingestion(ORDERS, extract(spark, sf_dir, ORDERS, FIRST_DAY), store, "day1")
    ingest.run_ingestion(ingest.with_ratio(ORDERS, 0.001), extract(spark, sf_dir, ORDERS, SECOND_DAY), store, "day2")
    held = store.quarantine.read().groupBy("run_id").agg(F.count("*").alias("quarantine_rows"))
    rows = F.lit(store.target(ORDERS).count()).cast("bigint")
    return audit_rows(store).join(held, "run_id", "left").select(
        "run_id", "status", "failure_code", "rows_in_window", "quarantined", "inserted", "quarantine_rows",
        "watermark_after", rows.alias("target_rows"))


def ingest_merge(spark, sf_dir):
    """Orders after two days."""
    store = two_days(spark, sf_dir, ORDERS)
    return plain(store.target(ORDERS))


def ingest_counts(spark, sf_dir):
    """What each of the two days did to the orders."""
    store = two_days(spark, sf_dir, ORDERS)
    return audit_rows(store).select("label", "status", *AUDIT_COUNTS)


def ingest_watermark(spark, sf_dir):
    """Composite watermark of the payments around each run."""
    store = two_days(spark, sf_dir, PAYMENTS)
    return audit_rows(store).select("label", "watermark_before", "watermark_after")


def ingest_audit(spark, sf_dir):
    """Complete audit records of the order lines."""
    store = two_days(spark, sf_dir, ORDER_LINES)
    return audit_rows(store)


def ingest_replay(spark, sf_dir):
    """The second day delivered twice: the repeat finds nothing new."""
    store = two_days(spark, sf_dir, PAYMENTS)
    ingest.run_ingestion(PAYMENTS, extract(spark, sf_dir, PAYMENTS, SECOND_DAY), store, "again")
    again = audit_rows(store).filter("label = 'again'")
    rows = F.lit(store.target(PAYMENTS).count()).cast("bigint")
    return again.select("status", *AUDIT_COUNTS, (F.col("watermark_before") == F.col("watermark_after"))
                        .alias("watermark_kept"), rows.alias("target_rows"))


def full_days(spark, sf_dir) -> IngestStore:
    """Two days of all three datasets."""
    store = new_store(spark)
    for label, through in (("day1", FIRST_DAY), ("day2", SECOND_DAY)):
        ingest.run_day(LEDGER, {s.dataset_id: extract(spark, sf_dir, s, through) for s in LEDGER}, store, label)
    return store


def ingest_day(spark, sf_dir):
    """Audit records of two days of the whole ledger."""
    return audit_rows(full_days(spark, sf_dir)).select("run_id", "status", *AUDIT_COUNTS, "reasons")


def live_rows(spark, sf_dir):
    """Payments that are not tombstones after two days."""
    store = two_days(spark, sf_dir, PAYMENTS)
    return plain(ingest.live_rows(store.target(PAYMENTS)).select("payment_id", "order_id", "amount", "settled_date"))


def replay_merge(spark, sf_dir):
    """Accepted leads replayed over a store that holds an older, partly different batch."""
    flagged = marketing.leads_flagged(spark, sf_dir)
    rows = stage(quarantine.accepted(flagged).select("lead_id", "campaign_id", "stage", "created_ts"), "leads")
    stored = rows.filter("created_ts < timestamp_ntz'2024-01-20 00:00:00'").withColumn(
        "stage", F.when(F.col("lead_id") % 5 == 0, "new").otherwise(F.col("stage")))
    merged, counts = ingest.replay_merge(stored, rows.filter("stage <> 'lost'"), "lead_id")
    measured = [counts, ingest.max_copies(merged, ["lead_id"]), merged.agg(F.count("*").alias("merged_rows"))]
    long = [m.unpivot([], m.columns, "measure", "value") for m in measured]
    return long[0].unionByName(long[1]).unionByName(long[2])


def row_accounting(spark, sf_dir):
    """Every payment of the second day's extract and what two days of ingestion made of it."""
    store, second = days_of(spark, sf_dir, PAYMENTS)
    rows = ingest.row_accounting(PAYMENTS, second.since(None), store.table(PAYMENTS), store.quarantine.read())
    return rows.select(F.get_json_object("raw", "$.payment_id").alias("payment_id"), F.get_json_object("raw", "$.amount").alias("amount"),
                       F.get_json_object("raw", "$.updated_at").alias("updated_at"), "copies", "outcome")


def contract_results(spark, sf_dir):
    """The runs of two days of orders with their first rejected rows."""
    store = two_days(spark, sf_dir, ORDERS)
    found = monitor.contract_results(store.audit.read(), store.quarantine.read(), 5)
    codes = F.array_join(F.transform("problems", lambda p: F.concat(p["column"], F.lit(":"), p["reason"])), ",")
    return plain(found.select("run_id", "rows_in_window", "quarantined", "place", "raw", codes.alias("problems")))


def _text_orders(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of orders as text; the second has wider values, a new column, and lacks one."""
    o = table(spark, sf_dir, "orders")
    first = o.filter("o_orderkey % 2 = 0").selectExpr(
        "cast(o_orderkey AS string) AS id", "concat(' ', cast(o_custkey AS string), ' ') AS customer",
        "cast(cast(floor(o_totalprice) AS bigint) AS string) AS total", "cast(cast(o_orderdate AS date) AS string) AS placed",
        "if(o_orderkey % 10 = 0, '', if(o_orderstatus = 'O', 'true', 'false')) AS open",
        "lpad(cast(o_orderkey AS string), 9, '0') AS code", "cast(o_custkey AS string) AS mixed", "if(o_orderkey % 4 = 0, '', ' ') AS nothing")
    second = o.filter("o_orderkey % 2 = 1").selectExpr(
        "cast(o_orderkey AS string) AS id", "cast(-o_custkey AS string) AS customer",
        "cast(cast(o_totalprice AS decimal(18,2)) AS string) AS total",
        "if(o_orderkey % 3 = 0, cast(o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400) AS string), cast(cast(o_orderdate AS date) AS string)) AS placed",
        "if(o_orderstatus = 'O', 'true', 'false') AS open", "lpad(cast(o_orderkey AS string), 9, '0') AS code",
        "if(o_orderkey % 5 = 0, 'N/A', cast(o_custkey AS string)) AS mixed", "o_orderpriority AS priority")
    return first, second


def land_inferred(spark, sf_dir):
    """Two text deliveries landed under the types that hold both: per column its type and what the typed values are."""
    deliveries = [stage(d, "delivery") for d in _text_orders(spark, sf_dir)]
    known = inference.types_of(inference.merge(*[inference.profile(d) for d in deliveries]))
    types = dict(sorted(known.items()))
    first, second = (inference.typed(d, types) for d in deliveries)
    landed = stage(first.unionByName(second), "landed")
    measured = landed.agg(*[F.struct(
        F.lit(c).alias("column"), F.lit(kind).alias("type"), F.count(c).alias("filled"), F.count_distinct(c).alias("kinds"),
        F.min(c).cast("string").alias("least"), F.max(c).cast("string").alias("greatest")).alias(f"c{i}")
        for i, (c, kind) in enumerate(types.items())])
    return measured.select(F.inline(F.array(*[f"c{i}" for i in range(len(types))])))


QUERIES = {f.__name__: f for f in (
    contract_validate, schema_drift, ingest_window, ingest_conflicts, ingest_reasons, ingest_breaker, ingest_merge,
    ingest_counts, row_accounting, contract_results, land_inferred, ingest_watermark, ingest_audit, ingest_replay, ingest_day, live_rows, replay_merge)}
