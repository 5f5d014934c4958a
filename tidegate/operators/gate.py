"""The publication gate: status per source, a fail-closed verdict, evidence, publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions.rules import QUARANTINE_RATE_THRESHOLD, REQUIRED_SOURCES
from tidegate.operators.quarantine import ACCEPTED, REASONS
from tidegate.sources.versions import VersionedTable

EVIDENCE_SCHEMA = (
    "run_start_ms bigint, run_start_ts timestamp, written_ts timestamp, passed boolean, problems array<string>,"
    " sources array<struct<source:string,gate_passed:boolean,conserved:boolean,total:bigint,quarantined:bigint,"
    "accepted_rows:bigint,quarantined_rows:bigint,quarantine_rate:double,computed_ts:timestamp>>")


def safe_ratio(part: Column, whole: Column, empty: Column) -> Column:
    """part / whole as a double, or `empty` when there is nothing to divide by."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(empty)


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def gate_status(inputs: dict[str, DataFrame], persisted: dict[str, DataFrame],
                threshold: float = QUARANTINE_RATE_THRESHOLD) -> DataFrame:
    """One row per source. `total` counts the input itself; the other counts come from the
    outcome table that was really written, so a row lost or doubled on the way shows as
    conserved = false. A source without input rows has no row here, which the verdict
    reports as missing."""
    totals = _union([
        frame.agg(F.count("*").alias("total")).filter("total > 0").select(F.lit(s).alias("source"), "total")
        for s, frame in inputs.items()])
    written = _union([
        frame.agg(F.count_if(F.size(REASONS) > 0).alias("quarantined"),
                  F.count_if(F.col(ACCEPTED)).alias("accepted_rows"),
                  F.count_if(~F.col(ACCEPTED)).alias("quarantined_rows"))
        .select(F.lit(s).alias("source"), "quarantined", "accepted_rows", "quarantined_rows")
        for s, frame in persisted.items()])
    rate = safe_ratio(F.col("quarantined"), F.col("total"), F.lit(0.0))
    return (
        totals.join(written, "source", "left")
        .withColumn("quarantine_rate", rate)
        .withColumn("gate_passed", F.col("quarantine_rate") <= F.lit(threshold))
        .withColumn("conserved", F.col("accepted_rows") + F.col("quarantined_rows") == F.col("total"))
        .withColumn("_computed_ts", F.current_timestamp())
    )


def verdict(status: DataFrame, run_start_ms: int | None,
            required: tuple[str, ...] = REQUIRED_SOURCES) -> DataFrame:
    """One row per required source with the problems that block publication.

    Anything but exactly one fresh, passing, conserved, non-empty row is a problem. Sources
    that are not required are ignored. A missing run boundary blocks every source.
    """
    spark = status.sparkSession
    wanted = spark.createDataFrame([(s, i) for i, s in enumerate(required)], "source string, seq int")
    # The status holds one row per source, so these groups stay tiny.
    found = status.groupBy("source").agg(
        F.count("*").alias("copies"),
        *[F.any_value(c).alias(c) for c in ("gate_passed", "conserved", "total", "quarantine_rate", "_computed_ts")])
    rows = wanted.join(found, "source", "left")
    if not _valid_boundary(run_start_ms):
        return rows.select("source", "seq", F.array(F.lit("run_boundary: missing or invalid")).alias("problems"))
    start = F.timestamp_millis(F.lit(run_start_ms))
    single = [
        F.when(F.col("gate_passed").isNull(), "gate_passed: null")
        .when(~F.col("gate_passed"), F.concat(
            F.lit("gate_passed: false at rate "),
            F.coalesce(F.round("quarantine_rate", 4).cast("decimal(6,4)").cast("string"), F.lit("unknown")))),
        F.when(F.col("conserved").isNull(), "conserved: null").when(~F.col("conserved"), "conserved: false"),
        F.when(F.col("total").isNull(), "total: null").when(F.col("total") <= 0, "total: empty batch"),
        F.when(F.col("_computed_ts").isNull(), "freshness: no timestamp")
        .when(F.col("_computed_ts") < start, "freshness: computed before this run"),
    ]
    problems = (
        F.when(F.col("copies").isNull(), F.array(F.lit("missing: no gate_status row")))
        .when(F.col("copies") > 1, F.array(F.lit("ambiguous: more than one gate_status row")))
        .otherwise(F.array_compact(F.array(*single)))
    )
    return rows.select("source", "seq", problems.alias("problems"))


def _valid_boundary(run_start_ms) -> bool:
    return isinstance(run_start_ms, int) and not isinstance(run_start_ms, bool) and run_start_ms > 0


def passed(verdicts: DataFrame) -> bool:
    """True when at least one source is required and none has a problem (n_sources rows)."""
    rows = verdicts.select(F.size("problems").alias("n")).collect()
    return bool(rows) and all(r["n"] == 0 for r in rows)


def evidence_record(status: DataFrame, verdicts: DataFrame, run_start_ms: int) -> DataFrame:
    """The nested log row of one gate decision; its arrays hold one element per source."""
    entry = status.select(F.struct(
        "source", "gate_passed", "conserved", "total", "quarantined", "accepted_rows", "quarantined_rows",
        "quarantine_rate", F.col("_computed_ts").alias("computed_ts")).alias("entry"))
    judged = verdicts.select(F.struct("seq", "source", "problems").alias("judged"))
    # Both frames hold one row per source; collect_list skips the side that is missing.
    gathered = entry.unionByName(judged, allowMissingColumns=True).agg(
        F.array_sort(F.collect_list("entry")).alias("sources"),
        F.array_sort(F.collect_list("judged")).alias("judged"))
    given = F.lit(run_start_ms).cast("bigint") if _valid_boundary(run_start_ms) else F.lit(None).cast("bigint")
    started = F.coalesce(given, F.raise_error(F.lit("a run starts at positive epoch milliseconds")).cast("bigint"))
    named = F.transform("judged", lambda r: F.transform(
        r["problems"], lambda p: F.concat(r["source"], F.lit(" "), p)))
    return gathered.withColumn("problems", F.flatten(named)).select(
        started.alias("run_start_ms"), F.timestamp_millis(started).alias("run_start_ts"),
        F.current_timestamp().alias("written_ts"),
        (F.size("problems") == 0).alias("passed"), "problems", "sources")


class PublicationWithheld(RuntimeError):
    """The gate did not pass; the published version is unchanged."""


def publish(df: DataFrame, target: VersionedTable, verdicts: DataFrame, **notes) -> int:
    """Commit `df` as the next published version, but only behind a passing verdict."""
    if not passed(verdicts):
        raise PublicationWithheld(target.path)
    return target.commit(df, **notes)

