"""Incremental ingestion of one extract: check, window, quarantine, merge, audit.

All rows stay on the executors. The driver sees the watermark, one line of counts, the reason
histogram (at most columns x codes) and the ranges a run writes, and decides whether the run commits.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.functions import casts
from tidegate.functions.keys import same_keys
from tidegate.operators import contracts
from tidegate.operators.contracts import PROBLEMS, RAW
from tidegate.operators.skew import sliced_join
from tidegate.session import stage
from tidegate.sources.partitioned import DAY, HOME, MONTH, NO_RANGE, YEAR, AppendLog, Landing, PartitionedTarget
from tidegate.sources.specs import DatasetSpec

# Run states and failure codes.
SUCCEEDED = "succeeded"
SUCCEEDED_WITH_QUARANTINE = "succeeded_with_quarantine"
FAILED = "failed"
SCHEMA_REQUIRED_COLUMN_MISSING = "schema_required_column_missing"
QUARANTINE_RATIO_EXCEEDED = "quarantine_ratio_exceeded"

AUDIT_DDL = (
    "run_id string, dataset_id string, label string, contract_version string, status string, failure_code string,"
    " rows_in_source bigint, rows_in_window bigint, rows_new bigint, inserted bigint, updated bigint,"
    " unchanged bigint, deleted bigint, quarantined bigint, quarantine_reasons map<string,bigint>,"
    " schema_diff struct<added:array<string>,removed:array<string>,removed_required:array<string>>,"
    " watermark_before string, watermark_after string, run_seq bigint, mark array<string>, columns array<string>")
QUARANTINE_DDL = f"run_id string, dataset_id string, raw string, problems {contracts.PROBLEMS_TYPE}"


@dataclass(frozen=True)
class Watermark:
    """The newest cursor a dataset has accepted: timestamp text, then the key as text."""

    cursor: str
    key: tuple[str, ...]

    def floor(self, hours: int) -> str:
        return str(datetime.fromisoformat(self.cursor) - timedelta(hours=hours))

    def literal(self, spec: DatasetSpec) -> Column:
        """The same struct `cursor_of` builds from a row."""
        parts = [F.lit(self.cursor).cast("timestamp_ntz").alias(spec.cursor_column)]
        parts += [F.lit(k).cast(spec.columns[c].ddl).alias(c) for c, k in zip(spec.primary_key, self.key)]
        return F.struct(*parts)

    def text(self) -> str:
        return "|".join((self.cursor, *self.key))


def cursor_of(spec: DatasetSpec) -> Column:
    """Composite cursor; structs compare field by field."""
    return F.struct(spec.cursor_column, *spec.primary_key)


def in_window(spec: DatasetSpec, mark: Watermark | None) -> Column:
    """Rows at or after watermark - lookback; a rejected row without a readable cursor stays."""
    if mark is None:
        return F.lit(True)
    floor = F.lit(mark.floor(spec.lookback_hours)).cast("timestamp_ntz")
    return F.when(F.size(PROBLEMS) == 0, F.col(spec.cursor_column) >= floor).otherwise(
        F.col("_raw_cursor").isNull() | (F.col("_raw_cursor") >= floor))


def window_rows(spec: DatasetSpec, extract: DataFrame, mark: Watermark | None) -> DataFrame:
    """Checked rows of the extract inside the read window.

    A delivered cursor that can be read and lies before the window goes ahead of all checks.
    """
    if mark is not None and spec.cursor_column in extract.columns:
        delivered = F.expr(casts.to_timestamp(f"cast(`{spec.cursor_column}` AS string)"))
        floor = F.lit(mark.floor(spec.lookback_hours)).cast("timestamp_ntz")
        extract = extract.filter(~F.coalesce(delivered < floor, F.lit(False)))
    return contracts.validate(spec, extract).filter(in_window(spec, mark)).drop("_raw_cursor")


def cursor_groups(spec: DatasetSpec, checked: DataFrame) -> DataFrame:
    """Valid rows by (key, cursor): the content, the copies, and whether the copies differ.

    The smallest and the largest content are equal exactly when all copies are, so one
    aggregate that combines before the shuffle replaces collecting the copies.
    """
    content = F.struct(F.lit(0).alias("_any"), *spec.payload())
    grouped = checked.filter(F.size(PROBLEMS) == 0).groupBy(*spec.primary_key, spec.cursor_column).agg(
        F.min(content).alias("_low"), F.max(content).alias("_high"), F.count("*").alias("_copies"))
    return grouped.withColumn("_conflict", ~F.col("_low").eqNullSafe(F.col("_high"))).drop("_high")


def accepted_rows(spec: DatasetSpec, groups: DataFrame) -> DataFrame:
    """One row per (key, cursor) whose copies agree."""
    return groups.filter("NOT _conflict").select(
        *[F.col(f"_low.{c}").alias(c) if c in spec.payload() else F.col(c) for c in spec.columns])


def single_rows(spec: DatasetSpec, checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows that share their key with no other, the cursor groups of all other valid rows).

    Few keys come twice as a rule. They are found by counting keys, which combines before the shuffle; a row that is
    alone with its key needs no grouping and does not move.
    """
    keys = list(spec.primary_key)
    valid = checked.filter(F.size(PROBLEMS) == 0)
    names = [f"_k{i}" for i in range(len(keys))]
    counted = valid.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count("*").alias("_rows"))
    repeated = stage(counted.filter("_rows > 1").select(*names), "repeated-keys")
    same = same_keys(valid, repeated, list(zip(keys, names)))
    # Written before they are grouped, so that a key with many rows can be split by the join and combined by the grouping.
    several = stage(valid.join(repeated, same, "left_semi").select(*spec.columns, PROBLEMS), "repeated-rows")
    return valid.join(repeated, same, "left_anti").select(*spec.columns), stage(cursor_groups(spec, several), "groups")


def quarantine_rows(spec: DatasetSpec, checked: DataFrame, groups: DataFrame, full: DataFrame | None = None) -> DataFrame:
    """Raw rows with their problems: contract failures, then every copy of a conflict.

    Where `checked` has the raw text of rejected rows only, `full` gives the checked rows with the text of every row.
    """
    invalid = checked.filter(F.size(PROBLEMS) > 0).select(RAW, PROBLEMS, F.lit(0).alias("_kind"))
    keys = [*spec.primary_key, spec.cursor_column]
    conflicts = groups.filter("_conflict").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    valid = (checked if full is None else full).filter(F.size(PROBLEMS) == 0)
    pairs = [(k, f"_k{i}") for i, k in enumerate(keys)]
    code = F.array(F.struct(F.lit(",".join(spec.primary_key)).alias("column"),
                            F.lit(contracts.DUPLICATE_KEY).alias("reason")))
    copies = valid.join(conflicts, same_keys(valid, conflicts, pairs), "left_semi").select(
        RAW, code.alias(PROBLEMS), F.lit(1).alias("_kind"))
    return invalid.unionByName(copies)


def reason_histogram(spec: DatasetSpec, checked: DataFrame, groups: DataFrame) -> DataFrame:
    """Problems per `column:reason`; a row counts once for each of its problems."""
    coded = checked.select(F.explode(PROBLEMS).alias("p")).select(
        F.concat("p.column", F.lit(":"), "p.reason").alias("reason"), F.lit(1).cast("bigint").alias("n"))
    copies = groups.filter("_conflict").select(
        F.lit(f"{','.join(spec.primary_key)}:{contracts.DUPLICATE_KEY}").alias("reason"), F.col("_copies").alias("n"))
    return coded.unionByName(copies).groupBy("reason").agg(F.sum("n").alias("rows"))


def merge_plan(spec: DatasetSpec, accepted: DataFrame, target: PartitionedTarget, mark: Watermark | None) -> DataFrame:
    """One row per delivered key: its newest version, and what applying all of its versions
    in cursor order does, without applying them.

    Versions at or below the stored cursor change nothing. The others are ordered, so only
    the first can insert; a tombstone counts as deleted wherever it stands. The newest
    version replaces the stored row exactly when some version changed it.
    """
    keys, cursor = list(spec.primary_key), spec.cursor_column
    # A key may bring any number of versions, and they are grouped by key right after.
    stored = target.stored(accepted, cursor).withColumnRenamed(cursor, "_stored")
    versions = sliced_join(accepted, stored, keys, [cursor])
    changed, removed, fresh = _version_facts(spec, mark)
    return versions.groupBy(*keys).agg(
        F.max(F.struct(cursor, *spec.payload())).alias("_newest"),
        F.count_if(changed).alias("_changed"), F.count_if(~changed).alias("_unchanged"),
        F.count_if(changed & removed).alias("_deleted"),
        F.min(F.when(changed, F.struct(F.col(cursor).alias("at"), removed.alias("gone")))).alias("_first"),
        F.count("_stored").alias("_known"), F.count_if(fresh).alias("_fresh"), F.max(HOME).alias(HOME))


def single_plan(spec: DatasetSpec, single: DataFrame, target: PartitionedTarget, mark: Watermark | None) -> DataFrame:
    """The merge plan of rows that are alone with their key: the same columns, without a grouping.

    The stored keys are written first: their size decides whether the delivered rows move to meet them.
    """
    keys, cursor = list(spec.primary_key), spec.cursor_column
    stored = target.stored(single, cursor)
    names = [f"_k{i}" for i in range(len(keys))]
    stored = stage(stored.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(cursor).alias("_stored"), HOME), "stored")
    changed, removed, fresh = _version_facts(spec, mark)

    def one(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0).cast("bigint")

    return single.join(stored, same_keys(single, stored, list(zip(keys, names))), "left").select(
        *keys, F.struct(cursor, *spec.payload()).alias("_newest"), one(changed).alias("_changed"), one(~changed).alias("_unchanged"),
        one(changed & removed).alias("_deleted"),
        F.when(changed, F.struct(F.col(cursor).alias("at"), removed.alias("gone"))).alias("_first"),
        one(F.col("_stored").isNotNull()).alias("_known"), one(fresh).alias("_fresh"), HOME)


def _version_facts(spec: DatasetSpec, mark: Watermark | None) -> tuple[Column, Column, Column]:
    """Whether a version beside its `_stored` cursor changes something, is a tombstone, and lies above the watermark."""
    changed = F.col("_stored").isNull() | (F.col(spec.cursor_column) > F.col("_stored"))
    removed = F.lit(False)
    if spec.deletion_strategy == "tombstone" and "is_deleted" in spec.columns:
        removed = F.coalesce(F.col("is_deleted"), F.lit(False))
    return changed, removed, F.lit(True) if mark is None else cursor_of(spec) > mark.literal(spec)


def plan_winners(spec: DatasetSpec, plan: DataFrame) -> DataFrame:
    """The rows the target takes over, with the range of the row they replace."""
    return plan.filter("_changed > 0").select(
        *[F.col(c) if c in spec.primary_key else F.col(f"_newest.{c}").alias(c) for c in spec.columns], HOME)


def plan_totals(spec: DatasetSpec, plan: DataFrame) -> DataFrame:
    """One row: the counts of a run and its largest cursor."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(f"_{name}"), F.lit(0)).alias(name)

    inserted = F.count_if((F.col("_known") == 0) & ~F.col("_first.gone")).alias("inserted")
    top = F.max(F.struct(F.col(f"_newest.{spec.cursor_column}").alias(spec.cursor_column), *spec.primary_key))
    summed = plan.agg(
        total("changed"), total("unchanged"), total("deleted"), total("fresh"), inserted, top.alias("top"))
    return summed.select(
        F.col("fresh").alias("rows_new"), "inserted", (F.col("changed") - F.col("deleted") - F.col("inserted"))
        .alias("updated"), "unchanged", "deleted",
        F.array(*[F.col(f"top.{c}").cast("string") for c in (spec.cursor_column, *spec.primary_key)]).alias("top"))


def newest_mark(spec: DatasetSpec, accepted: DataFrame) -> Watermark | None:
    """The largest composite cursor of the accepted rows."""
    top = accepted.agg(F.max(cursor_of(spec)).alias("top")).select(
        *[F.col(f"top.{c}").cast("string") for c in (spec.cursor_column, *spec.primary_key)]).first()
    return None if top[0] is None else Watermark(top[0], tuple(top[1:]))


def live_rows(target: DataFrame) -> DataFrame:
    """Rows that are not tombstones."""
    return target.filter(~F.coalesce(F.col("is_deleted"), F.lit(False)))


def business_range(spec: DatasetSpec, width: str) -> str:
    """The range of a row by its first date column, or else by its cursor, as SQL."""
    by = next((c.name for c in spec.columns.values() if c.type == "date"), spec.cursor_column)
    return f"if(year(`{by}`) BETWEEN 0 AND 9999, date_format(`{by}`, '{width}'), '{NO_RANGE}')"


class IngestStore:
    """Targets, audit records and quarantined rows of a group of datasets, on shared storage.

    The newest audit record of a dataset holds its watermark. It is written after the rows: a run that dies in between is done
    again over the same window and finds its rows stored, so the target is the same; its record then counts them as unchanged.
    """

    def __init__(self, spark: SparkSession, root: str, width: str = MONTH):
        if width not in (YEAR, MONTH, DAY):
            raise ValueError(f"no range is {width} wide")
        self.spark, self.root, self.width = spark, root.rstrip("/"), width
        self.audit = AppendLog(spark, f"{self.root}/_audit", AUDIT_DDL)
        self.quarantine = AppendLog(spark, f"{self.root}/_quarantine", QUARANTINE_DDL)

    def table(self, spec: DatasetSpec) -> PartitionedTarget:
        return PartitionedTarget(self.spark, f"{self.root}/{spec.dataset_id}", spec.schema(), spec.primary_key,
                                 business_range(spec, self.width))

    def target(self, spec: DatasetSpec) -> DataFrame:
        return self.table(spec).rows()

    def last(self, spec: DatasetSpec) -> dict:
        """Number of runs of a dataset, and watermark and columns of the newest."""
        runs = self.audit.read().filter(F.col("dataset_id") == spec.dataset_id)
        found = runs.agg(F.count("*").alias("runs"), F.max_by(F.struct("mark", "columns"), "run_seq").alias("newest")).first()
        return {"runs": found["runs"], **(found["newest"].asDict() if found["newest"] else {"mark": None, "columns": None})}

    def watermark(self, spec: DatasetSpec) -> Watermark | None:
        saved = self.last(spec)["mark"]
        return Watermark(saved[0], tuple(saved[1:])) if saved else None

    def save_audit(self, record: dict) -> None:
        self.audit.append(self.spark.createDataFrame([record], AUDIT_DDL), record["run_id"])


def run_ingestion(spec: DatasetSpec, extract: DataFrame | Landing, store: IngestStore, label: str = "run") -> dict:
    """Ingest one extract and return its audit record; bad data is a failed run, not an error.

    Of a landing only the folders of the read window are opened.
    """
    table, last = store.table(spec), store.last(spec)
    mark = Watermark(last["mark"][0], tuple(last["mark"][1:])) if last["mark"] else None
    seq = last["runs"] + 1
    source_rows = extract.count()
    observed = sorted(extract.columns) if source_rows else last["columns"] or sorted(spec.columns)
    diff = contracts.schema_diff(spec, observed)
    before = mark.text() if mark else None
    record = {
        "run_id": f"{spec.dataset_id}:{label}:{seq}", "dataset_id": spec.dataset_id, "label": label,
        "contract_version": spec.contract_version, "status": None, "failure_code": None,
        "rows_in_source": source_rows, "rows_in_window": 0, "rows_new": 0, "inserted": 0, "updated": 0,
        "unchanged": 0, "deleted": 0, "quarantined": 0, "quarantine_reasons": {},
        "schema_diff": {"added": diff.added, "removed": diff.removed, "removed_required": diff.removed_required},
        "watermark_before": before, "watermark_after": before, "run_seq": seq, "mark": last["mark"], "columns": last["columns"],
    }
    if diff.removed_required:
        record.update(status=FAILED, failure_code=SCHEMA_REQUIRED_COLUMN_MISSING)
        store.save_audit(record)
        return record

    delivered = extract.since(mark.floor(spec.lookback_hours) if mark else None) if isinstance(extract, Landing) else extract
    read = window_rows(spec, delivered, mark)
    # The raw text is the larger part of a row and is asked for again only where copies of a key differ.
    checked = stage(read.withColumn(RAW, F.when(F.size(PROBLEMS) > 0, F.col(RAW))), "checked")
    single, groups = single_rows(spec, checked)
    reasons = {r["reason"]: r["rows"] for r in reason_histogram(spec, checked, groups).collect()}
    seen = checked.agg(F.count_if(F.size(PROBLEMS) > 0).alias("rejected"), F.count("*").alias("rows")).first()
    ok = ~F.col("_conflict")
    line = groups.agg(F.count_if(ok).alias("ok"), F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
                      F.coalesce(F.sum(F.when(~ok, F.col("_copies"))), F.lit(0)).alias("copies")).first()
    quarantined = seen["rejected"] + line["copies"]
    window = seen["rows"] - seen["rejected"] - line["rows"] + line["ok"] + quarantined
    record.update(rows_in_window=window, quarantined=quarantined, quarantine_reasons=dict(sorted(reasons.items())))
    if line["copies"]:
        rows = quarantine_rows(spec, checked, stage(groups.filter("_conflict"), "conflicts"), read)
    else:
        rows = quarantine_rows(spec, checked, groups)
    if window and quarantined / window > spec.max_quarantine_ratio:
        record.update(status=FAILED, failure_code=QUARANTINE_RATIO_EXCEEDED)
        _save_quarantine(store, record, rows)
        store.save_audit(record)
        return record

    several = merge_plan(spec, accepted_rows(spec, groups), table, mark)
    plan = stage(single_plan(spec, single, table, mark).unionByName(several), "plan")
    totals = plan_totals(spec, plan).first().asDict()
    top = totals.pop("top")
    after = _later(spec, mark, Watermark(top[0], tuple(top[1:])) if top[0] is not None else None)
    record.update(totals, watermark_after=after.text() if after else None, mark=[after.cursor, *after.key] if after else None,
                  columns=observed, status=SUCCEEDED_WITH_QUARANTINE if quarantined else SUCCEEDED)
    if quarantined:
        _save_quarantine(store, record, rows)
    table.put(plan_winners(spec, plan))
    store.save_audit(record)
    return record


def _later(spec: DatasetSpec, mark: Watermark | None, top: Watermark | None) -> Watermark | None:
    """The larger of two composite cursors, compared as their declared types."""
    if mark is None or top is None:
        return mark or top

    def order(w: Watermark):
        return (datetime.fromisoformat(w.cursor),
                *[int(k) if spec.columns[c].type == "int" else k for c, k in zip(spec.primary_key, w.key)])

    return max(mark, top, key=order)


def _save_quarantine(store: IngestStore, record: dict, rows: DataFrame) -> None:
    store.quarantine.append(rows.select(
        F.lit(record["run_id"]).alias("run_id"), F.lit(record["dataset_id"]).alias("dataset_id"),
        F.col(RAW).alias("raw"), F.col(PROBLEMS).alias("problems")), record["run_id"])


def run_day(specs: tuple[DatasetSpec, ...], extracts: dict[str, DataFrame | Landing], store: IngestStore,
            label: str) -> list[dict]:
    """Ingest the datasets of one day in contract order."""
    return [run_ingestion(spec, extracts[spec.dataset_id], store, label) for spec in specs]


def with_ratio(spec: DatasetSpec, ratio: float) -> DatasetSpec:
    return replace(spec, max_quarantine_ratio=ratio)


# -- where did each delivered row go ------------------------------------------------

ACCEPTED, SUPERSEDED, QUARANTINED, NEVER_READ = "accepted", "superseded", "quarantined", "never_read"


def row_accounting(spec: DatasetSpec, extract: DataFrame, target: PartitionedTarget, quarantine: DataFrame) -> DataFrame:
    """One row per distinct row of an extract with its copies and what became of it.

    Extract and quarantine are stacked and grouped once by the raw text; the key then looks up the stored cursor. A row
    in the quarantine is quarantined; one with the stored cursor was accepted, one older than it superseded; and a row that no run
    has read, for example because it came later than the lookback allows, was never read. `raw` is the row as delivered.
    """
    keys, cursor = list(spec.primary_key), spec.cursor_column
    names = [*keys, cursor]
    checked = contracts.validate(spec, extract)
    valid = F.size(PROBLEMS) == 0
    delivered = checked.select(F.col(RAW).alias("raw"), *[F.when(valid, F.col(c)).alias(c) for c in names], F.lit(1).alias("_copies"),
                               F.lit(0).alias("_held"))
    held = quarantine.filter(F.col("dataset_id") == spec.dataset_id).select("raw", F.lit(0).alias("_copies"), F.lit(1).alias("_held"))
    rows = delivered.unionByName(held, allowMissingColumns=True).groupBy("raw").agg(
        F.sum("_copies").alias("copies"), F.max("_held").alias("_held"), *[F.max(c).alias(c) for c in names]).filter("copies > 0")
    rows = stage(rows, "accounting")
    stored = target.stored(rows.select(*keys), cursor).select(*keys, F.col(cursor).alias("_stored"))
    joined = sliced_join(rows, stored, keys, ["raw"])
    outcome = (F.when(F.col("_held") == 1, QUARANTINED).when(F.col(cursor) == F.col("_stored"), ACCEPTED)
               .when(F.col(cursor) < F.col("_stored"), SUPERSEDED).otherwise(NEVER_READ))
    return joined.select("raw", "copies", *names, outcome.alias("outcome"))


# -- replay by natural key ---------------------------------------------------------

def replay_merge(current: DataFrame | None, accepted: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(merged rows, one row of counts) for a replayed batch without a cursor.

    A key that is new is inserted, one whose content differs is replaced, the rest stay.
    A replay never deletes; `stale` counts stored keys the batch no longer holds.
    """
    content = [c for c in accepted.columns if c != key]
    batch = accepted.select(F.col(key).alias("_key"), F.struct(*content).alias("_new"))
    if current is None:
        current = accepted.filter(F.lit(False))
    stored = current.select(F.col(key).alias("_old_key"), F.struct(*content).alias("_old"))
    both = stored.join(batch, stored["_old_key"].eqNullSafe(batch["_key"]), "full_outer")
    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = F.col("_old").eqNullSafe(F.col("_new"))
    counts = both.agg(
        F.count_if(~had & has).alias("inserted"), F.count_if(had & has & ~same).alias("updated"),
        F.count_if(had & has & same).alias("unchanged"), F.count_if(had & ~has).alias("stale"))
    merged = both.select(
        F.when(has, F.col("_key")).otherwise(F.col("_old_key")).alias(key),
        F.when(has, F.col("_new")).otherwise(F.col("_old")).alias("_row"))
    return merged.select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in accepted.columns]), counts


def max_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """The largest number of rows that share a key; 1 means the key is unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n").alias("max_copies"))
