"""The order-to-cash tables: typed current rows of the three ledger datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.operators import contracts, monitor, reconcile
from tidegate.operators.ingest import IngestStore
from tidegate.session import stage
from tidegate.sources import derived
from tidegate.sources.specs import ORDER_LINES, ORDERS, PAYMENTS


@dataclass(frozen=True)
class Ledger:
    orders: DataFrame
    lines: DataFrame
    payments: DataFrame


def load(spark: SparkSession, sf_dir: str, through: str = derived.SECOND_DAY) -> Ledger:
    """Valid rows of each extract, newest version per key, tombstones included."""
    return Ledger(
        contracts.latest_valid(ORDERS, derived.order_extract(spark, sf_dir, through)),
        contracts.latest_valid(ORDER_LINES, derived.line_extract(spark, sf_dir, through)),
        contracts.latest_valid(PAYMENTS, derived.payment_extract(spark, sf_dir, through)))


def day_checks(store: IngestStore, payments: DataFrame, day: int) -> tuple[DataFrame, DataFrame]:
    """(verdicts, findings) of the two reconciliation checks of a day over the ingested tables."""
    against_source = reconcile.source_to_target(PAYMENTS, payments, store.target(PAYMENTS)).summary()
    positions = reconcile.payment_positions(store.target(ORDERS), store.target(ORDER_LINES), store.target(PAYMENTS))
    against_orders = stage(reconcile.payments_vs_orders(positions), "positions")
    number = F.lit(day).cast("bigint").alias("day")
    verdicts = against_source.select(number, F.lit("source_to_target").alias("check_name"), "passed").unionByName(
        against_orders.select(number, F.lit("payments_vs_orders").alias("check_name"), "passed"))
    return verdicts, against_orders.select(number, "overpaid_orders", "unpaid_orders")


def _audit_of(store: IngestStore, day: int) -> DataFrame:
    return store.audit.read().filter(F.col("label") == f"day{day}").withColumn("day", F.lit(day).cast("bigint")).withColumn(
        "added", F.col("schema_diff.added"))


def run_incidents(store: IngestStore, day: int) -> DataFrame:
    """Incidents of one ingested day that its audit records alone tell, with their root cause."""
    audit = _audit_of(store, day)
    no_checks = audit.sparkSession.createDataFrame([], "day bigint, check_name string, passed boolean")
    no_findings = audit.sparkSession.createDataFrame([], "day bigint, overpaid_orders bigint, unpaid_orders bigint")
    return monitor.root_causes(monitor.incidents(audit, no_checks), audit, no_findings)


def day_incidents(store: IngestStore, payments: DataFrame, day: int) -> DataFrame:
    """Incidents of one ingested day with their root cause, from its audit records and checks."""
    audit = _audit_of(store, day)
    verdicts, findings = day_checks(store, payments, day)
    found = monitor.incidents(audit, verdicts)
    return monitor.root_causes(found, audit, findings)
