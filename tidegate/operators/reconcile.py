"""Reconciliation and parity: keyed comparison, order to cash, query results, digests."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidegate.functions.codes import entries_where
from tidegate.operators import contracts, expectations
from tidegate.operators.ordering import global_row_number
from tidegate.session import stage
from tidegate.sources.partitioned import AppendLog
from tidegate.sources.specs import DatasetSpec

SAMPLE = 10  # rows shown of each kind of difference; the counts are always complete
PAID_STATUSES = ("paid", "shipped")  # fixed values

_MISMATCH = "array<struct<column:string,new:string,legacy:string>>"


@dataclass(frozen=True)
class Comparison:
    """Two row sets lined up on a business key; one row per key."""

    rows: DataFrame
    key: tuple[str, ...]

    def summary(self) -> DataFrame:
        """Complete counts and the verdict."""
        only_new, only_legacy = F.col("_legacy_rows") == 0, F.col("_new_rows") == 0
        counted = self.rows.agg(
            F.count_if(~only_legacy).alias("new_rows"), F.count_if(~only_new).alias("legacy_rows"),
            F.count_if(only_new).alias("only_in_new"), F.count_if(only_legacy).alias("only_in_legacy"),
            F.coalesce(F.sum(F.size("_mismatches")), F.lit(0)).cast("bigint").alias("value_mismatches"))
        clean = (F.col("only_in_new") == 0) & (F.col("only_in_legacy") == 0) & (F.col("value_mismatches") == 0)
        return counted.withColumn("passed", clean)

    def missing(self) -> DataFrame:
        """Keys present on one side: those only in new first, each side in key order."""
        side = F.when(F.col("_legacy_rows") == 0, "only_in_new").when(F.col("_new_rows") == 0, "only_in_legacy")
        return self.rows.select(*self.key, side.alias("side")).filter("side IS NOT NULL")

    def mismatches(self) -> DataFrame:
        """One row per key and differing column."""
        return self.rows.select(*self.key, F.posexplode("_mismatches").alias("_seq", "_m")).select(
            *self.key, "_seq", "_m.column", "_m.new", "_m.legacy")

    def missing_sample(self, n: int = SAMPLE) -> DataFrame:
        return self.missing().orderBy(F.desc("side"), *self.key).limit(n)

    def mismatch_sample(self, n: int = SAMPLE) -> DataFrame:
        return self.mismatches().orderBy(*self.key, "_seq").limit(n).drop("_seq")


def reconcile(new: DataFrame, legacy: DataFrame, key: tuple[str, ...], exact: tuple[str, ...],
              money: tuple[str, ...], tolerance: float | str = "0.01") -> Comparison:
    """Line up two row sets whose key must be unique; a repeated key stops the job.

    Both sides are stacked and grouped once. That is one shuffle for the pair, it compares
    NULL keys as equal, and it counts the rows per key on the way.
    """
    values = (*exact, *money)

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*key, F.lit(name).alias("_side"), F.struct(*values).alias("_values"))

    def of(name: str) -> Column:
        return F.col("_side") == name

    lined = side(new, "new").unionByName(side(legacy, "legacy")).groupBy(*key).agg(
        F.count_if(of("new")).alias("_new_rows"), F.count_if(of("legacy")).alias("_legacy_rows"),
        F.max(F.when(of("new"), F.col("_values"))).alias("_new"),
        F.max(F.when(of("legacy"), F.col("_values"))).alias("_legacy"))
    unique = expectations.fail_on(lined, {"unique_key": "_new_rows <= 1 AND _legacy_rows <= 1"})
    both = "_new_rows = 1 AND _legacy_rows = 1"

    def found(column: str, differs: str) -> tuple[str, str]:
        return (f"{both} AND {differs}",
                f"named_struct('column', '{column}', 'new', cast(_new.`{column}` AS string),"
                f" 'legacy', cast(_legacy.`{column}` AS string))")

    checks = [found(c, f"NOT (_new.`{c}` <=> _legacy.`{c}`)") for c in exact]
    checks += [found(c, f"NOT coalesce(abs(_new.`{c}` - _legacy.`{c}`) <= {tolerance}, _new.`{c}` <=> _legacy.`{c}`)")
               for c in money]
    return Comparison(unique.withColumn("_mismatches", F.expr(entries_where(checks, _MISMATCH))), tuple(key))


RUN_DDL = "run_id string, check_name string, passed boolean, report string"


class CutoverBlocked(RuntimeError):
    """A reconciliation did not pass; its run record is already in the log."""


def run_record(summary: DataFrame, check: str, run_id: str) -> DataFrame:
    """The one-row log entry of a check: verdict and report as JSON."""
    return summary.select(F.lit(run_id).alias("run_id"), F.lit(check).alias("check_name"), "passed",
                          F.to_json(F.struct(*summary.columns)).alias("report"))


def record_run(summary: DataFrame, check: str, run_id: str, log: AppendLog) -> None:
    """Log the verdict first, then stop the caller if the check did not pass."""
    log.append(run_record(summary, check, run_id), f"{check}~{run_id}")
    if not log.read(f"{check}~{run_id}").first()["passed"]:
        raise CutoverBlocked(f"{check} {run_id}")


INJECT_MODES = ("none", "revenue", "missing_row")  # fixed values


def inject_discrepancy(report: DataFrame, key: tuple[str, ...], mode: str) -> DataFrame:
    """Change or drop the first row in key order, to prove that a comparison notices."""
    if mode not in INJECT_MODES:
        raise ValueError(f"mode must be one of {INJECT_MODES}")
    if mode == "none":
        return report
    first = report.agg(F.min(F.struct(*key)).alias("_first"))  # one row
    marked = report.join(F.broadcast(first), F.struct(*key).eqNullSafe(F.col("_first")), "left")
    if mode == "missing_row":
        return marked.filter("_first IS NULL").drop("_first")
    raised = F.when(F.col("_first").isNotNull(), F.col("revenue") + 125).otherwise(F.col("revenue"))
    return marked.withColumn("revenue", raised).drop("_first")


# -- order to cash -----------------------------------------------------------------

def live(df: DataFrame) -> DataFrame:
    return df.filter("NOT coalesce(is_deleted, false)")


def order_totals(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """order_id, order_date, status, total of live orders; an order without lines totals 0."""
    totals = live(lines).groupBy("order_id").agg(
        F.sum(F.col("unit_price") * F.col("quantity").cast("decimal(20,0)")).cast("decimal(28,2)").alias("_total"))
    return live(orders).join(totals, "order_id", "left").select(
        "order_id", "order_date", "status",
        F.coalesce("_total", F.lit(0).cast("decimal(28,2)")).alias("total"))


def daily_revenue(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Recognized revenue (paid or shipped) by order date."""
    return order_totals(orders, lines).filter(F.col("status").isin(*PAID_STATUSES)).groupBy(
        F.col("order_date").alias("business_date")).agg(
        F.count("*").alias("order_count"), F.sum("total").alias("revenue"))


def daily_payments(payments: DataFrame) -> DataFrame:
    return live(payments).groupBy(F.col("settled_date").alias("business_date")).agg(
        F.count("*").alias("payment_count"), F.sum("amount").alias("amount"))


def source_to_target(spec: DatasetSpec, extract: DataFrame, target: DataFrame) -> Comparison:
    """Daily payments straight from the extract against those of the ingested table.

    The whole extract counts, not the read window; rows that break the contract are the
    quarantine's business.
    """
    source = contracts.latest_valid(spec, extract)
    return reconcile(daily_payments(target), daily_payments(source), ("business_date",),
                     ("payment_count",), ("amount",), "0")


def payment_positions(orders: DataFrame, lines: DataFrame, payments: DataFrame,
                      business_date: str | None = None) -> DataFrame:
    """One row per order or unknown order id with what was owed, paid, and the finding.

    Payments are summed per order before they meet the orders, so an order with a third of
    all payments joins as one row.
    """
    owed = order_totals(orders, lines)
    paid = live(payments).groupBy("order_id").agg(
        F.sum("amount").alias("_paid"), F.count("*").alias("payments"))
    both = owed.withColumn("_known", F.lit(True)).join(paid, "order_id", "full_outer")
    got = F.coalesce("_paid", F.lit(0).cast("decimal(28,2)"))
    judged = F.col("status").isin(*PAID_STATUSES)
    if business_date is not None:
        judged = judged & (F.col("order_date") == F.lit(business_date).cast("date"))
    finding = (
        F.when(F.col("_known").isNull(), "orphan")
        .when(~F.coalesce(judged, F.lit(False)), "not_judged").when(got == 0, "unpaid")
        .when(got > F.col("total"), "overpaid").when(got < F.col("total"), "underpaid").otherwise("settled"))
    return both.select("order_id", "order_date", "status", "total", got.alias("paid"),
                       F.coalesce("payments", F.lit(0)).alias("payments"), finding.alias("finding"))


def payments_vs_orders(positions: DataFrame) -> DataFrame:
    """Headline of the order-level check: sums, counts per finding, verdict."""
    judged = ~F.col("finding").isin("orphan", "not_judged")

    def rows(finding: str) -> Column:
        return F.count_if(F.col("finding") == finding)

    def money(column: str) -> Column:
        return F.coalesce(F.sum(F.when(judged, F.col(column))), F.lit(0).cast("decimal(38,2)"))

    found = positions.agg(
        money("total").alias("expected_revenue"), money("paid").alias("payments_received"),
        rows("unpaid").alias("unpaid_orders"), rows("overpaid").alias("overpaid_orders"),
        rows("underpaid").alias("underpaid_orders"),
        F.coalesce(F.sum(F.when(F.col("finding") == "orphan", F.col("payments"))), F.lit(0)).alias("orphan_payments"))
    nothing = sum((F.col(c) for c in ("unpaid_orders", "overpaid_orders", "underpaid_orders", "orphan_payments")),
                  F.lit(0)) == 0
    return found.withColumn("difference", F.col("payments_received") - F.col("expected_revenue")).withColumn(
        "passed", nothing)


def finding_sample(positions: DataFrame, finding: str, n: int = SAMPLE) -> DataFrame:
    """The first order ids with one finding."""
    return positions.filter(F.col("finding") == finding).select("order_id").orderBy("order_id").limit(n)


def orphan_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Live payments whose order is unknown or deleted."""
    return live(payments).join(live(orders).select("order_id"), "order_id", "left_anti")


# -- parity of query results -------------------------------------------------------

VALIDATED, MISMATCH, EXECUTION_ERROR = "validated", "mismatch", "execution_error"  # fixed values


def normalized_columns(df: DataFrame) -> list[Column]:
    """Values as comparable text: numbers to 2 digits half-up, midnight as a date."""
    columns = []
    for i, f in enumerate(df.schema.fields):
        value, kind = F.col(f"`{f.name}`"), f.dataType
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            number = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value).cast("decimal(38,10)")
            odd = F.when(F.isnan(value), "NaN").when(F.abs(value) == float("inf"), value.cast("string"))
            text = F.coalesce(odd, F.round(number, 2).cast("decimal(38,2)").cast("string"))
        elif isinstance(kind, (T.NumericType,)):
            text = F.round(value.cast("decimal(38,6)") if isinstance(kind, T.IntegralType) else value, 2).cast(
                "decimal(38,2)").cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = F.when(F.date_trunc("day", value) == value.cast("timestamp"),
                          value.cast("date").cast("string")).otherwise(value.cast("string"))
        else:
            text = value.cast("string")
        columns.append(text.alias(f"c{i}"))
    return columns


def normalized(df: DataFrame) -> DataFrame:
    return df.select(*normalized_columns(df))


def result_difference(got: DataFrame, want: DataFrame,
                      order: tuple[list[str], list[str]] | None = None) -> DataFrame:
    """One row per distinct row of both sides: `copies` > 0 means expected and not produced, < 0 the
    reverse; `wanted` counts it on the reference side, and `moved` its copies that stand at another place.

    One grouping by row and place, combined before its shuffle, is summed again by row, so the multiset and the
    positions are decided together. `order` holds the columns that order `got` and those that order `want` (a descending
    one starts with "-"); without it places do not count. Places do not depend on how the rows are partitioned.
    """
    def tagged(df: DataFrame, sign: int) -> DataFrame:
        names = df.columns
        if order:
            columns = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order[sign > 0]]
            df = global_row_number(df, columns, "_place")
        place = F.col("_place") if order else F.lit(0).cast("bigint")
        return df.select(*normalized_columns(df.select(*[F.col(f"`{c}`") for c in names])), place.alias("_place"),
                         F.lit(sign).cast("bigint").alias("_copies"))

    both = tagged(want, 1).unionAll(tagged(got, -1))
    columns = [c for c in both.columns if c not in ("_copies", "_place")]
    placed = both.groupBy(*columns, "_place").agg(F.sum("_copies").alias("_net"), F.count_if(F.col("_copies") > 0).alias("_wanted"))
    return placed.groupBy(*columns).agg(
        F.sum("_net").alias("copies"), F.sum("_wanted").alias("wanted"), F.sum(F.greatest("_net", F.lit(0))).alias("moved"))


# Fixed list: error classes that are the query's own fault; any other error, as of the storage, is the caller's to see.
_QUERY_FAULTS = ("AnalysisException", "ParseException", "ArithmeticException", "NumberFormatException", "DateTimeException",
                 "ArrayIndexOutOfBoundsException", "SparkRuntimeException")


def _is_query_fault(error: PySparkException) -> bool:
    """Whether the query, and not its surroundings, failed; a task's error is looked for among the causes."""
    if isinstance(error, AnalysisException):
        return True
    cause = getattr(error, "_origin", None)
    while cause is not None:
        if any(cause.getClass().getSimpleName().endswith(name) for name in _QUERY_FAULTS):
            return True
        cause = cause.getCause()
    return False


@dataclass(frozen=True)
class Parity:
    """The difference of two query results, written once; without one the query did not run."""

    reference: DataFrame
    difference: DataFrame | None

    def verdict(self) -> DataFrame:
        """One row: status, rows compared, rows that differ in each direction, and whether only the order differs."""
        if self.difference is None:
            zero = F.lit(0).cast("bigint")
            return self.reference.agg(
                F.lit(EXECUTION_ERROR).alias("status"), F.count("*").alias("rows_compared"), zero.alias("expected_not_produced"),
                zero.alias("produced_not_expected"), F.lit(False).alias("order_only"))
        found = self.difference.agg(
            F.coalesce(F.sum("wanted"), F.lit(0)).alias("rows_compared"),
            F.coalesce(F.sum(F.greatest("copies", F.lit(0))), F.lit(0)).alias("expected_not_produced"),
            F.coalesce(F.sum(F.greatest(-F.col("copies"), F.lit(0))), F.lit(0)).alias("produced_not_expected"),
            F.coalesce(F.sum("moved"), F.lit(0)).alias("_moved"))
        same_rows = (F.col("expected_not_produced") == 0) & (F.col("produced_not_expected") == 0)
        status = F.when(same_rows & (F.col("_moved") == 0), VALIDATED).otherwise(MISMATCH)
        return found.select(status.alias("status"), "rows_compared", "expected_not_produced", "produced_not_expected",
                            (same_rows & (F.col("_moved") > 0)).alias("order_only"))

    def samples(self, n: int = SAMPLE) -> DataFrame:
        """The first n distinct rows of each direction, by their texts, with how many copies are too many."""
        if self.difference is None:
            return self.reference.sparkSession.createDataFrame([], "direction string, row array<string>, copies bigint")
        values = [c for c in self.difference.columns if c not in ("copies", "wanted", "moved")]
        row = F.array(*[F.col(c) for c in values]).alias("row")

        def side(direction: str, sign: int) -> DataFrame:
            extra = (F.col("copies") * sign).alias("copies")
            return self.difference.filter(F.col("copies") * sign > 0).orderBy(*values).limit(n).select(F.lit(direction).alias("direction"), row, extra)

        return side("expected_not_produced", 1).unionByName(side("produced_not_expected", -1))


def compare_queries(spark: SparkSession, legacy_sql: str, reference_sql: str,
                    order: tuple[list[str], list[str]] | None = None, **tables: DataFrame) -> Parity:
    """Run both queries and keep their difference."""
    want = stage(spark.sql(reference_sql, **tables), "reference")
    try:
        # Written at once, so that a value the engine refuses at run time shows here.
        got = stage(spark.sql(legacy_sql, **tables), "parity")
        if len(got.columns) != len(want.columns):
            raise AnalysisException(f"{len(got.columns)} columns instead of {len(want.columns)}")
    except PySparkException as error:
        if not _is_query_fault(error):
            raise
        return Parity(want, None)
    return Parity(want, stage(result_difference(got, want, order), "difference"))


def parity(spark: SparkSession, legacy_sql: str, reference_sql: str,
           order: tuple[list[str], list[str]] | None = None, **tables: DataFrame) -> DataFrame:
    """One row: status, rows compared, and how many rows differ in each direction."""
    return compare_queries(spark, legacy_sql, reference_sql, order, **tables).verdict().drop("order_only")


# -- digests and key checks --------------------------------------------------------

def table_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Order-independent digest over all columns: row count and commutative sums of row hashes.

    Sums combine inside each task; collecting and sorting the row hashes would put the whole
    table into one row. A value enters with its length and a NULL with a mark of its own, so
    no two rows share a text; both halves of the MD5 are summed.
    """
    def value(c: str) -> Column:
        text = F.col(f"`{c}`").cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("null"))

    hashed = F.md5(F.concat_ws(",", *[value(c) for c in columns or df.columns]))
    halves = [F.sum(F.conv(F.substring(hashed, at, 16), 16, 10).cast("decimal(20,0)")).cast("string") for at in (1, 17)]
    return df.agg(F.count("*").alias("row_count"), F.concat_ws("-", *halves).alias("digest"))


def fast_digest(df: DataFrame) -> DataFrame:
    """The same idea with a 64-bit engine hash over all columns, for runs on one engine."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.agg(F.count("*").alias("row_count"), F.sum(row.cast("decimal(20,0)")).alias("hash_sum"),
                  F.bit_xor(row).alias("hash_xor"))


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """count(*) - count(DISTINCT key), with rows and distinct keys."""
    return df.groupBy(*keys).agg(F.count("*").alias("_n")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"), F.count("*").alias("key_count")).withColumn(
        "excess_rows", F.col("row_count") - F.col("key_count"))
