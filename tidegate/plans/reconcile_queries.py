"""Registered ledger, reconciliation, parity, digest and recall queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tidegate.operators import contracts, ingest, inject, monitor, reconcile
from tidegate.plans import gaming, ledger
from tidegate.plans.ingest_queries import EXTRACTS, extract, days_of, full_days, new_store
from tidegate.plans.present import plain
from tidegate.session import scratch_path, stage
from tidegate.sources import derived
from tidegate.sources.partitioned import YEAR, AppendLog, Landing
from tidegate.sources.specs import LEDGER, ORDER_LINES, ORDERS, PAYMENTS
from tidegate.sources.tables import table


def order_totals(spark, sf_dir):
    books = ledger.load(spark, sf_dir)
    return plain(reconcile.order_totals(books.orders, books.lines))


def gold_daily_revenue(spark, sf_dir):
    books = ledger.load(spark, sf_dir)
    return plain(reconcile.daily_revenue(books.orders, books.lines))


def daily_payments(spark, sf_dir):
    return plain(reconcile.daily_payments(ledger.load(spark, sf_dir).payments))


def _reports(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    new = gaming.retail_sales_daily(gaming.clean(spark, sf_dir, "orders"), gaming.clean(spark, sf_dir, "licensees"))
    legacy = gaming.legacy_retail_sales_daily(
        spark, derived.retail_orders(spark, sf_dir), derived.licensees(spark, sf_dir))
    return new, legacy


_REPORT = (gaming.REPORT_KEY, ("order_count", "units"), ("revenue",))


def reconcile_retail(spark, sf_dir):
    """The cutover check: the new report against the same report written a second time."""
    return plain(reconcile.reconcile(*_reports(spark, sf_dir), *_REPORT).summary())


def _changed_report(new: DataFrame) -> DataFrame:
    """The report with keys dropped, keys moved, and values off by more and less than a cent."""
    day = F.dayofmonth("order_date")
    return (
        new.filter(day != 7)
        .withColumn("region", F.when(day == 9, F.concat("region", F.lit("_X"))).otherwise(F.col("region")))
        .withColumn("units", F.when(day == 11, F.col("units") + 1).otherwise(F.col("units")))
        .withColumn("revenue", F.when(day == 13, F.col("revenue") + F.lit("0.02").cast("decimal(18,2)"))
                    .when(day == 15, F.col("revenue") + F.lit("0.01").cast("decimal(18,2)"))
                    .otherwise(F.col("revenue"))))


def reconcile_keyed(spark, sf_dir):
    """Counts of every kind of difference between a report and a changed copy."""
    new, _ = _reports(spark, sf_dir)
    report = stage(new, "report")
    return plain(reconcile.reconcile(report, _changed_report(report), *_REPORT).summary())


def recon_samples(spark, sf_dir):
    """The first ten mismatches and the first ten one-sided keys."""
    new, _ = _reports(spark, sf_dir)
    report = stage(new, "report")
    lined = reconcile.reconcile(report, _changed_report(report), *_REPORT)
    lined = reconcile.Comparison(stage(lined.rows, "lined"), lined.key)
    return lined.mismatch_sample().select(*lined.key, "column", "new", "legacy").unionByName(
        lined.missing_sample().select(*lined.key, F.col("side").alias("column"), F.lit(None).cast("string").alias("new"),
                                      F.lit(None).cast("string").alias("legacy")))


def reconcile_injected(spark, sf_dir):
    """One planted change per mode, each found as exactly that."""
    new, _ = _reports(spark, sf_dir)
    report = stage(new, "report")
    found = [
        reconcile.reconcile(report, reconcile.inject_discrepancy(report, gaming.REPORT_KEY, mode), *_REPORT)
        .summary().select(F.lit(mode).alias("mode"), "only_in_new", "only_in_legacy", "value_mismatches", "passed")
        for mode in reconcile.INJECT_MODES]
    return found[0].unionByName(found[1]).unionByName(found[2])


def source_to_target(spark, sf_dir):
    """Daily payments of the extract against the table ingested over two days.

    The extract delivers some first-day payments only on the second day, before the read
    window, so this is the one check that can miss them.
    """
    store, second = days_of(spark, sf_dir, PAYMENTS)
    return plain(reconcile.source_to_target(PAYMENTS, second.since(None), store.target(PAYMENTS)).summary())


def payments_vs_orders(spark, sf_dir):
    books = ledger.load(spark, sf_dir)
    return plain(reconcile.payments_vs_orders(
        reconcile.payment_positions(books.orders, books.lines, books.payments)))


def payment_findings(spark, sf_dir):
    """Every order or unknown order id with its finding."""
    books = ledger.load(spark, sf_dir)
    return plain(reconcile.payment_positions(books.orders, books.lines, books.payments))


def orphan_payments(spark, sf_dir):
    books = ledger.load(spark, sf_dir)
    return plain(reconcile.orphan_payments(books.payments, books.orders).select("payment_id", "order_id", "amount"))


LEGACY_TOTALS = "SELECT o_custkey, sum(o_totalprice) AS total FROM {orders} GROUP BY o_custkey"
REFERENCE_TOTALS = """
SELECT o_custkey, cast(sum(cast(o_totalprice AS decimal(18,2))) AS decimal(28,2)) AS total
FROM {orders} GROUP BY o_custkey"""
WRONG_TOTALS = """
SELECT o_custkey, sum(if(o_orderkey % 50 = 0, 0, o_totalprice)) AS total FROM {orders} GROUP BY o_custkey"""


def parity_match(spark, sf_dir):
    """Two writings of one report agree after normalisation."""
    return reconcile.parity(spark, LEGACY_TOTALS, REFERENCE_TOTALS, orders=table(spark, sf_dir, "orders"))


def parity_mismatch(spark, sf_dir):
    """A report that loses some orders differs in both directions."""
    return reconcile.parity(spark, WRONG_TOTALS, REFERENCE_TOTALS, orders=table(spark, sf_dir, "orders"))


ORDERED = "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderkey % 3 = 0"
LOST = "SELECT o_orderkey, o_custkey, if(o_orderkey % 50 = 0, 0, o_totalprice) AS o_totalprice FROM {orders} WHERE o_orderkey % 3 = 0"


def parity_ordered(spark, sf_dir):
    """Equal rows in the same order, equal rows in another one, other rows, and the same without an order."""
    orders = table(spark, sf_dir, "orders")
    key, back, price = ["o_orderkey"], ["-o_orderkey"], ["-o_totalprice", "o_orderkey"]
    cases = (("same_order", ORDERED, (key, key)), ("reversed", ORDERED, (back, key)), ("by_price", ORDERED, (price, price)),
             ("other_rows", LOST, (key, key)), ("no_order", ORDERED, None))
    rows = [reconcile.compare_queries(spark, sql, ORDERED, order, orders=orders).verdict().withColumn("case", F.lit(name))
            for name, sql, order in cases]
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    return whole


def parity_samples(spark, sf_dir):
    """The first rows of each direction where a report loses some orders."""
    found = reconcile.compare_queries(spark, WRONG_TOTALS, REFERENCE_TOTALS, orders=table(spark, sf_dir, "orders")).samples(5)
    return found.select("direction", F.col("row")[0].alias("customer"), F.col("row")[1].alias("total"), "copies")


def parity_error(spark, sf_dir):
    """Queries that cannot be read, name no column, or fail on a value."""
    orders = table(spark, sf_dir, "orders")
    cases = (("unreadable", "SELEC o_custkey FROM {orders}"), ("unknown_column", "SELECT nowhere, 1 FROM {orders}"),
             ("division", "SELECT o_custkey, sum(1 div (o_orderkey - o_orderkey)) FROM {orders} GROUP BY o_custkey"),
             ("cast", "SELECT o_custkey, cast(o_orderpriority AS int) FROM {orders}"),
             ("fewer_columns", "SELECT o_custkey FROM {orders}"))
    rows = [reconcile.compare_queries(spark, sql, REFERENCE_TOTALS, orders=orders).verdict().select(F.lit(name).alias("case"), "status", "rows_compared")
            for name, sql in cases]
    whole = rows[0]
    for more in rows[1:]:
        whole = whole.unionByName(more)
    return whole


def table_digest(spark, sf_dir):
    """Digest of the orders, and of the orders in another order and partitioning."""
    # A double enters as the shortest text that gives it back, so a change in any of its bits shows.
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    moved = orders.repartition("o_custkey")
    return reconcile.table_digest(orders).withColumn("copy", F.lit("as_read")).unionByName(
        reconcile.table_digest(moved).withColumn("copy", F.lit("shuffled")))


def duplicate_key_check(spark, sf_dir):
    return reconcile.duplicate_rows(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def detection_recall(spark, sf_dir):
    """Planted faults by defect, and how many of them the checks report."""
    orders = derived.order_extract(spark, sf_dir, derived.SECOND_DAY)
    lines = derived.line_extract(spark, sf_dir, derived.SECOND_DAY)
    number = F.expr("try_cast(order_id AS bigint)")
    bad_price = inject.overwrite_value(
        lines, "bad_unit_price", ["order_id", "line_no"], F.col("line_no").cast("bigint") % 131 == 0, "unit_price", "N/A")
    bad_status = inject.overwrite_value(
        orders, "invalid_status", ["order_id"], number % 137 == 0, "status", "refunded")
    keyless = inject.keyless_copies(orders.filter("order_id <> ''"), ["order_id"], number % 139 == 0,
                                    label=["customer_id", "updated_at"])
    # A row that is rejected for another reason cannot conflict, so conflicts go into every copy of the keys that pass.
    valid = contracts.valid_rows(ORDERS, orders).select(F.col("order_id").cast("string").alias("order_id")).distinct()
    doubled = inject.conflicting_copies(
        orders.join(valid, "order_id", "left_semi"), ["order_id"], number % 149 == 0, "customer_id", "-1")

    def rejected(spec, rows, reason, defect, keys):
        checked = contracts.validate(spec, rows).filter(F.exists(
            contracts.PROBLEMS, lambda p: p["reason"] == reason))
        if reason == contracts.NULL_PRIMARY_KEY:
            # The copy lost its key; its raw row still names the customer and the cursor.
            raw = [F.get_json_object(contracts.RAW, f"$.{c}") for c in ("customer_id", "updated_at")]
            return checked.select(F.lit(defect).alias("defect"), F.concat_ws("|", *raw).alias("key"))
        return checked.select(F.lit(defect).alias("defect"),
                              F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"))

    conflicts = ingest.cursor_groups(ORDERS, contracts.validate(ORDERS, doubled.rows)).filter("_conflict").select(
        F.lit("duplicate_key").alias("defect"), F.col("order_id").cast("string").alias("key"))
    detections = (
        rejected(ORDER_LINES, bad_price.rows, contracts.CAST_FAILED, "bad_unit_price", ["order_id", "line_no"])
        .unionByName(rejected(ORDERS, bad_status.rows, contracts.INVALID_ENUM, "invalid_status", ["order_id"]))
        .unionByName(rejected(ORDERS, keyless.rows, contracts.NULL_PRIMARY_KEY, "null_key", ["order_id"]))
        .unionByName(conflicts))
    labels = bad_price.labels.unionByName(bad_status.labels).unionByName(keyless.labels).unionByName(doubled.labels)
    return inject.recall(labels, detections)


def payment_recall(spark, sf_dir):
    """Missing and doubled payments planted into settled orders, and how many are found."""
    books = ledger.load(spark, sf_dir)
    before = stage(reconcile.payment_positions(books.orders, books.lines, books.payments), "before")
    settled = before.filter("finding = 'settled'").select("order_id")
    clean = stage(reconcile.live(books.payments).join(settled, "order_id", "left_semi").select(
        *books.payments.columns), "payments")
    where = F.col("order_id") % 7 == 0
    lost = inject.missing_payments(clean, where)
    doubled = inject.double_charges(clean, where, 5 * derived.LATE_COPY)

    def found(made, finding, defect):
        positions = reconcile.payment_positions(books.orders, books.lines, made.rows)
        return positions.filter(F.col("finding") == finding).select(
            F.lit(defect).alias("defect"), F.col("order_id").cast("string").alias("key"))

    return inject.recall(
        lost.labels.unionByName(doubled.labels),
        found(lost, "unpaid", "missing_payment").unionByName(found(doubled, "overpaid", "duplicate_charge")))


def reconcile_runs(spark, sf_dir):
    """The run log of a passing and a blocked cutover check."""
    new, legacy = _reports(spark, sf_dir)
    report = stage(new, "report")
    log = AppendLog(spark, scratch_path(spark, "recon-runs"), reconcile.RUN_DDL)
    reconcile.record_run(reconcile.reconcile(report, legacy, *_REPORT).summary(), "retail", "1", log)
    blocked = False
    try:
        reconcile.record_run(reconcile.reconcile(report, _changed_report(report), *_REPORT).summary(), "retail", "2", log)
    except reconcile.CutoverBlocked:
        blocked = True
    return log.read().select("run_id", "check_name", "passed", F.get_json_object("report", "$.new_rows").cast("bigint")
                             .alias("new_rows"), F.lit(blocked).alias("second_blocked"))


def check_lookup(spark, sf_dir):
    """The newest report of each check after several runs of two checks."""
    new, legacy = _reports(spark, sf_dir)
    report = stage(new, "report")
    log = AppendLog(spark, scratch_path(spark, "recon-runs"), reconcile.RUN_DDL)
    summaries = {"same": reconcile.reconcile(report, legacy, *_REPORT).summary(),
                 "changed": reconcile.reconcile(report, _changed_report(report), *_REPORT).summary()}
    for check, run_id, which in (("retail", "1", "same"), ("retail", "2", "changed"), ("monthly", "1", "changed"), ("monthly", "2", "same")):
        log.append(reconcile.run_record(summaries[which], check, run_id), f"{check}~{run_id}")
    found = monitor.newest_reports(log.read())
    return found.select("check_name", "runs", "failed", "run_id", "passed", F.get_json_object("report", "$.value_mismatches").cast("bigint")
                        .alias("value_mismatches"))


def _landed(spark, spec, rows: DataFrame) -> Landing:
    return Landing(spark, scratch_path(spark, "landing"), spec.cursor_column, YEAR).deliver(rows)


def defect_incidents(spark, sf_dir):
    """A source that delivers nothing new, a column that goes, and one that comes, each as the incident of its run."""
    store = new_store(spark)
    second = {s.dataset_id: EXTRACTS[s.dataset_id](spark, sf_dir, derived.SECOND_DAY) for s in LEDGER}
    faulty = {ORDERS.dataset_id: inject.stale_extract(second[ORDERS.dataset_id], "updated_at", "1999-06-01"),
              ORDER_LINES.dataset_id: inject.removed_column(second[ORDER_LINES.dataset_id], "unit_price"),
              PAYMENTS.dataset_id: inject.added_column(second[PAYMENTS.dataset_id].filter("amount <> 'N/A'"), "currency", "EUR")}
    ingest.run_day(LEDGER, {s.dataset_id: extract(spark, sf_dir, s, derived.FIRST_DAY) for s in LEDGER}, store, "day1")
    ingest.run_day(LEDGER, {s.dataset_id: _landed(spark, s, faulty[s.dataset_id]) for s in LEDGER}, store, "day2")
    return ledger.run_incidents(store, 2).select("incident_key", "trigger", "dataset_id", "status", "failure_code", "root_cause")


def late_arrival_recall(spark, sf_dir):
    """New payments of the second day stamped long before the read window, and how many of them the accounting finds."""
    store = new_store(spark)
    ingest.run_ingestion(PAYMENTS, extract(spark, sf_dir, PAYMENTS, derived.FIRST_DAY), store, "day1")
    second = derived.payment_extract(spark, sf_dir, derived.SECOND_DAY)
    where = (F.col("updated_at") > derived.FIRST_DAY) & (F.col("payment_id").cast("bigint") % 11 == 0)
    made = inject.late_arrivals(second, ["payment_id"], where, "updated_at", "1990-01-01 00:00:00")
    ingest.run_ingestion(PAYMENTS, _landed(spark, PAYMENTS, made.rows), store, "day2")
    rows = ingest.row_accounting(PAYMENTS, made.rows, store.table(PAYMENTS), store.quarantine.read())
    unread = rows.filter(F.col("outcome") == ingest.NEVER_READ).select(
        F.lit("late_arrival").alias("defect"), F.get_json_object("raw", "$.payment_id").alias("key"))
    return inject.recall(made.labels, unread)


def restore_target(spark, sf_dir):
    """Typed orders saved as JSON lines and restored through their contract."""
    path = scratch_path(spark, "saved")
    ledger.load(spark, sf_dir).orders.write.json(path)
    saved = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in ORDERS.columns])).json(path)
    return plain(contracts.restore(ORDERS, saved))


def day_incidents(spark, sf_dir):
    """Incidents of the second ingested day, from its audit records and checks."""
    store = full_days(spark, sf_dir)
    found = ledger.day_incidents(store, derived.payment_extract(spark, sf_dir, derived.SECOND_DAY), 2)
    return found.select("incident_key", "trigger", "dataset_id", "run_id", "status", "root_cause")


QUERIES = {f.__name__: f for f in (
    payment_recall, reconcile_runs, check_lookup, defect_incidents, late_arrival_recall, restore_target, day_incidents, parity_ordered, parity_samples, parity_error,
     order_totals, gold_daily_revenue, daily_payments, reconcile_retail, reconcile_keyed, recon_samples,
    reconcile_injected, source_to_target, payments_vs_orders, payment_findings, orphan_payments, parity_match,
    parity_mismatch, table_digest, duplicate_key_check, detection_recall)}
