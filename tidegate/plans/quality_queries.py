"""Registered landing, silver, expectation, streaming, quarantine and gate queries."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions.rules import GAMING_RULES, SALES_RULES
from tidegate.operators import evidence, expectations, gate, inject, monitor, quarantine
from tidegate.operators.ordering import first_per_key, latest_per_key
from tidegate.plans import marketing, sales
from tidegate.plans.present import joined, plain
from tidegate.session import scratch_path, stage
from tidegate.sources import derived
from tidegate.sources.tables import table, with_arrival_order
from tidegate.sources.partitioned import YEAR, AppendLog, PartitionedTarget
from tidegate.sources.versions import VersionedTable
from tidegate.streaming import changes, land, metrics

STREAMED_TABLES = ("customer", "orders", "lineitem", "part", "supplier", "nation", "region")


def bronze_stream_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every sales table as an append stream; rows landed per table."""
    root = scratch_path(spark, "bronze")
    running = []
    for name in STREAMED_TABLES:
        schema = table(spark, sf_dir, name).schema
        stream = land.read_incrementally(spark, sf_dir, schema, f"{name}.parquet")
        running.append(land.land(stream, name, f"{root}/{name}", f"{root}/_checkpoint/{name}"))
    for query in running:
        query.awaitTermination()
    counts = [
        spark.read.parquet(f"{root}/{name}").groupBy("_source_table").agg(
            F.count("*").alias("landed_rows"), F.count("_ingest_ts").alias("stamped_rows"))
        for name in STREAMED_TABLES]
    whole = counts[0]
    for part in counts[1:]:
        whole = whole.unionByName(part)
    return whole


def bronze_row_id(spark, sf_dir):
    """Arrival position of each order in its landed file."""
    return with_arrival_order(table(spark, sf_dir, "orders")).select("o_orderkey", F.col("_row_id.row").alias("row"))


def silver_trim(spark, sf_dir):
    """Customers that arrive padded, trimmed in every text column."""
    padded = table(spark, sf_dir, "customer").withColumns({
        "c_name": F.concat(F.lit("  "), "c_name", F.lit(" ")),
        "c_mktsegment": F.concat("c_mktsegment", F.lit("   "))})
    return plain(sales.trim_strings(padded))


def silver_typed(spark, sf_dir):
    """ISO texts as date and timestamp; text that is no date becomes NULL."""
    e = table(spark, sf_dir, "events")
    text = e.select("event_id", F.when(F.col("event_id") % 31 == 0, "not a day").otherwise(
        F.col("ts").cast("string")).alias("event_ts"))
    return text.select("event_id", F.expr("try_cast(event_ts AS timestamp_ntz)").alias("event_ts"),
                       F.expr("try_cast(substring(event_ts, 1, 10) AS date)").alias("event_date"))


def faulty_lines(lines: DataFrame) -> DataFrame:
    """Line items with planted zero quantities, bad or missing discounts and negative prices."""
    return lines.withColumns({
        "l_quantity": F.when(F.col("l_partkey") % 97 == 0, 0.0).otherwise(F.col("l_quantity")),
        "l_discount": F.when(F.col("l_suppkey") % 89 == 0, 1.5).when(F.col("l_partkey") % 101 == 0, None)
        .otherwise(F.col("l_discount")),
        "l_extendedprice": F.when(F.col("l_orderkey") % 103 == 0, -F.col("l_extendedprice") - 1)
        .otherwise(F.col("l_extendedprice"))})


def _line_summary(lines: DataFrame) -> DataFrame:
    return plain(lines.groupBy("l_suppkey").agg(
        F.count("*").alias("kept"), F.sum(F.col("l_extendedprice").cast("decimal(18,6)")).alias("price")))


def expect_drop(spark, sf_dir):
    """Lines that meet all six rules, summed per supplier."""
    lines = faulty_lines(table(spark, sf_dir, "lineitem"))
    return _line_summary(expectations.drop_failing(lines, SALES_RULES["lineitem"]))


def expect_all(spark, sf_dir):
    """Wagers that meet the whole rule dictionary."""
    return plain(expectations.drop_failing(derived.wagers(spark, sf_dir), GAMING_RULES["wagers"]))


def expect_fail(spark, sf_dir):
    """Lines behind a rule that stops the run when broken; the given table meets it."""
    lines = expectations.fail_on(table(spark, sf_dir, "lineitem"), {"valid_orderkey": "l_orderkey IS NOT NULL"})
    return _line_summary(lines)


def expect_metrics(spark, sf_dir):
    """Passed and failed rows per rule."""
    return expectations.rule_counts(faulty_lines(table(spark, sf_dir, "lineitem")), SALES_RULES["lineitem"])


def expect_stream(spark, sf_dir):
    """The same rules on a stream, with observed counters, summed per supplier."""
    root = scratch_path(spark, "expect-stream")
    stream = land.read_incrementally(spark, sf_dir, table(spark, sf_dir, "lineitem").schema, "lineitem.parquet")
    land.validate(stream, SALES_RULES["lineitem"], f"{root}/out", f"{root}/checkpoint",
                  prepare=faulty_lines).awaitTermination()
    return _line_summary(spark.read.parquet(f"{root}/out"))


def latest_per_key_query(spark, sf_dir):
    """Newest version of each campaign."""
    newest = latest_per_key(derived.campaigns(spark, sf_dir), ["campaign_id"], ["_ingest_ts"])
    return plain(newest.drop("_ingest_ts"))


def dedup_by_key(spark, sf_dir):
    """First arrivals and later copies of the operations events."""
    first, copies = quarantine.split_first_arrivals(derived.ops_events(spark, sf_dir), "ops_event_id", "_row_id")
    return first.select("ops_event_id", "_row_id", F.lit("kept").alias("outcome")).unionByName(
        copies.select("ops_event_id", "_row_id", F.lit("duplicate").alias("outcome")))


def scd1_stream(spark, sf_dir):
    """Two days of customer changes, the second with updates and late older versions."""
    root = scratch_path(spark, "scd1")
    customer = table(spark, sf_dir, "customer")

    def version(rows: DataFrame, sequence: int) -> DataFrame:
        return rows.withColumns({"c_acctbal": F.col("c_acctbal").cast("decimal(18,2)") + sequence,
                                 "seq": F.lit(sequence).cast("bigint")})

    days = (version(customer, 2),
            version(customer.filter("c_mktsegment = 'BUILDING'"), 3).unionByName(
                version(customer.filter("c_mktsegment IN ('BUILDING', 'MACHINERY')"), 1)))
    target = PartitionedTarget(spark, f"{root}/customers", days[0].schema, ("c_custkey",), "cast(c_nationkey AS string)")
    for rows in days:
        rows.write.mode("append").parquet(f"{root}/landing")
        stream = land.read_incrementally(spark, f"{root}/landing", rows.schema)
        changes.apply_changes(stream, target, ["seq"], f"{root}/checkpoint").awaitTermination()
    return plain(target.rows().select("c_custkey", "c_name", "c_acctbal", "seq"))


def scd1_orders_stream(spark, sf_dir):
    """Orders in three deliveries of several files, one file a micro-batch, the last with older versions that come late."""
    root = scratch_path(spark, "scd1-orders")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")

    def version(rows: DataFrame, status: str, later: str) -> DataFrame:
        return rows.select("o_orderkey", "o_custkey", F.lit(status).alias("status"), "o_orderdate",
                           (F.col("o_orderdate") + F.expr(f"interval {later}")).alias("changed_at"))

    deliveries = (version(o, "placed", "1 day"), version(o.filter("o_orderstatus = 'F'"), "shipped", "3 days"),
                  version(o.filter("o_orderkey % 3 = 0"), "paid", "2 days"))
    target = PartitionedTarget(spark, f"{root}/orders", deliveries[0].schema, ("o_orderkey",),
                               f"date_format(o_orderdate, '{YEAR}')")
    for rows in deliveries:
        rows.repartition(2, "o_orderkey").write.mode("append").parquet(f"{root}/landing")
        stream = land.read_incrementally(spark, f"{root}/landing", rows.schema, files_per_trigger=1)
        changes.apply_changes(stream, target, ["changed_at", "status"], f"{root}/checkpoint").awaitTermination()
    return target.rows()


# -- quarantine and gate -----------------------------------------------------------

def dq_leads(spark, sf_dir):
    flagged = marketing.leads_flagged(spark, sf_dir)
    return flagged.select("lead_id", "campaign_id", "stage", "_row_id", joined(quarantine.REASONS).alias("reasons"))


def dq_web_events(spark, sf_dir):
    flagged = marketing.web_events_flagged(spark, sf_dir)
    return flagged.select("event_id", "campaign_id", "session_duration_seconds", "page_views",
                          joined(quarantine.REASONS).alias("reasons"))


def dq_ops_events(spark, sf_dir):
    flagged = marketing.ops_events_flagged(spark, sf_dir)
    return plain(flagged.select("ops_event_id", "event_type", "success", "latency_seconds", "_row_id",
                                joined(quarantine.REASONS).alias("reasons")))


def _quarantine_table(spark, flagged: DataFrame, *columns: str) -> DataFrame:
    """What the quarantine of a run holds after the run was done twice, next to an earlier run's rows."""
    path, rows = scratch_path(spark, "quarantine"), stage(flagged, "flagged")
    quarantine.save_quarantined(rows.limit(0), path, "run-0")
    for _attempt in range(2):
        log = quarantine.save_quarantined(rows, path, "run-1")
    held = log.read("run-1")
    stamped = F.col("_quarantined_ts").isNotNull() & (F.col("_quarantined_ts") <= F.col("saved_ts"))
    return plain(held.select(*columns, joined(quarantine.REASONS).alias("reasons"), stamped.alias("stamped")))


def quarantine_leads(spark, sf_dir):
    return _quarantine_table(spark, marketing.leads_flagged(spark, sf_dir), "lead_id", "campaign_id", "stage", "_row_id")


def quarantine_web_events(spark, sf_dir):
    return _quarantine_table(spark, marketing.web_events_flagged(spark, sf_dir), "event_id", "campaign_id",
                             "session_duration_seconds", "page_views")


def quarantine_ops_events(spark, sf_dir):
    return _quarantine_table(spark, marketing.ops_events_flagged(spark, sf_dir), "ops_event_id", "event_type", "success",
                             "latency_seconds", "_row_id")


def expect_stream_metrics(spark, sf_dir):
    """Passed and failed lines per rule and micro-batch, as the stream reported them while it ran."""
    root = scratch_path(spark, "stream-metrics")
    lines = table(spark, sf_dir, "lineitem")
    log = AppendLog(spark, f"{root}/metrics", metrics.METRICS_DDL)
    for part in range(3):
        lines.filter(F.col("l_orderkey") % 3 == part).write.mode("append").parquet(f"{root}/landing")
        stream = land.read_incrementally(spark, f"{root}/landing", lines.schema)
        with metrics.recorded(spark, "lines", SALES_RULES["lineitem"], log):
            land.validate(stream, SALES_RULES["lineitem"], f"{root}/out", f"{root}/checkpoint", metrics="lines",
                          prepare=faulty_lines).awaitTermination()
    return log.read().select("batch_id", "rule", "passed", "failed")


def first_case_per_defect(spark, sf_dir):
    """The first quarantined web event of each set of reasons, by arrival."""
    flagged = quarantine.quarantined(marketing.web_events_flagged(spark, sf_dir)).select(
        joined(quarantine.REASONS).alias("reasons"), "_row_id", "event_id", "campaign_id")
    return first_per_key(flagged, ["reasons"], ["_row_id"])


def dq_rate(spark, sf_dir):
    """Faults planted into clean operations events at three rates, and how many of them the checks quarantine."""
    clean = quarantine.accepted(marketing.ops_events_flagged(spark, sf_dir)).select("ops_event_id", "event_type", "success", "latency_seconds", "_row_id")
    rows = stage(clean, "clean-ops")
    counts = []
    for rate in (0.0, 0.25, 1.0):
        where = inject.at_rate(["ops_event_id"], rate)
        made = inject.overwrite_value(rows, "invalid_latency", ["ops_event_id"], where, "latency_seconds", None)
        flagged = quarantine.flag_ops_events(made.rows)
        planted = made.labels.agg(F.count("*").alias("planted"))
        found = flagged.agg(F.count("*").alias("rows"), F.count_if(F.size(quarantine.REASONS) > 0).alias("quarantined"))
        both = found.join(F.broadcast(planted))  # one row each
        counts.append(both.select(F.lit(rate).alias("rate"), "rows", (F.col("planted") == F.col("quarantined")).alias("all_found"),
                                  (F.abs(F.col("planted") / F.col("rows") - rate) < 0.05).alias("near_rate")))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def sources_lookup(spark, sf_dir):
    """Gate status and the newest quarantined rows of two of the three sources."""
    batch = marketing.run_batch(spark, sf_dir)
    asked = spark.createDataFrame([("leads",), ("ops_events",), ("nowhere",)], "source string")
    status = monitor.of_sources(batch.status(), asked, "_computed_ts").select(
        "source", F.lit("status").alias("kind"), F.col("quarantined").alias("number"), F.lit("").alias("reasons"))
    held = quarantine.quarantined(marketing.leads_flagged(spark, sf_dir)).select(
        F.lit("leads").alias("source"), F.col("_row_id").alias("number"), joined(quarantine.REASONS).alias("reasons")).unionByName(
        quarantine.quarantined(marketing.web_events_flagged(spark, sf_dir)).select(
            F.lit("web_events").alias("source"), F.col("_row_id").alias("number"), joined(quarantine.REASONS).alias("reasons")))
    newest = monitor.of_sources(held, asked, "number", 3).withColumn("kind", F.lit("quarantine"))
    return status.unionByName(newest)


def dq_conservation(spark, sf_dir):
    """Input rows against accepted plus quarantined rows of each written source."""
    status = marketing.run_batch(spark, sf_dir).status()
    return status.select("source", "total", "accepted_rows", "quarantined_rows", "conserved")


def quality_metrics(spark, sf_dir):
    return quarantine.reason_counts({
        "leads": marketing.leads_flagged(spark, sf_dir), "web_events": marketing.web_events_flagged(spark, sf_dir),
        "ops_events": marketing.ops_events_flagged(spark, sf_dir)})


def gate_status(spark, sf_dir):
    status = marketing.run_batch(spark, sf_dir).status()
    return status.drop("_computed_ts")


def gate_verdict(spark, sf_dir):
    """Problems per required source; no text means the source does not block."""
    started = int(time.time() * 1000) - 1000
    verdicts = gate.verdict(marketing.run_batch(spark, sf_dir).status(), started)
    return verdicts.select("source", F.array_join("problems", "; ").alias("problems"))


def gated_publish(spark, sf_dir):
    """A publish behind a passing gate, then one that the default threshold withholds."""
    started = int(time.time() * 1000) - 1000
    batch = marketing.run_batch(spark, sf_dir)
    target = VersionedTable(spark, scratch_path(spark, "published"))
    report = marketing.campaign_performance(marketing.campaigns_clean(spark, sf_dir), batch.clean("leads"))
    gate.publish(report, target, gate.verdict(batch.status(threshold=0.5), started))
    withheld = False
    try:
        gate.publish(report.withColumn("budget", F.col("budget") * 2), target,
                     gate.verdict(batch.status(), started))
    except gate.PublicationWithheld:
        withheld = True
    return plain(target.read().select("campaign_id", "budget", "lead_count", "won_count").withColumns({
        "version": F.lit(target.manifest()["version"]).cast("bigint"), "second_withheld": F.lit(withheld)}))


def evidence_log(spark, sf_dir):
    """The nested log row of a run, appended twice as a retry would, one row per source."""
    started = int(time.time() * 1000) - 1000
    status = stage(marketing.run_batch(spark, sf_dir).status(), "status")
    record = gate.evidence_record(status, gate.verdict(status, started), started)
    log = AppendLog(spark, scratch_path(spark, "evidence"), gate.EVIDENCE_SCHEMA)
    for _attempt in range(2):
        log.append(evidence.gate_and_redact(record), str(started))
    return log.read().select("passed", F.size("problems").cast("bigint").alias("problem_count"),
                             F.inline("sources")).select(
        "passed", "problem_count", "source", "gate_passed", "conserved", "total", "quarantined",
        "accepted_rows", "quarantined_rows", "quarantine_rate")


def evidence_refused(spark, sf_dir):
    """The log row of a run whose problems hold a marker: redacted, and failed whatever the gate said."""
    started = int(time.time() * 1000) - 1000
    status = stage(marketing.run_batch(spark, sf_dir).status(threshold=0.5), "status")
    record = gate.evidence_record(status, gate.verdict(status, started), started)
    marked = record.withColumn("sources", F.transform("sources", lambda s: s.withField("source", F.concat(
        s["source"], F.when(s["quarantined"] > 0, F.lit(f" {evidence.CANARY_MARKER}")).otherwise(F.lit(""))))))
    log = AppendLog(spark, scratch_path(spark, "evidence"), gate.EVIDENCE_SCHEMA)
    log.append(evidence.gate_and_redact(record), "clean")
    log.append(evidence.gate_and_redact(marked), "marked")
    return log.read().select("passed", joined("problems").alias("problems"), F.size("sources").cast("bigint").alias("sources"))


def silver_clients(spark, sf_dir):
    """The clients dimension: the newest version of each, its name trimmed."""
    return marketing.clients_clean(spark, sf_dir).select("client_id", "client_name", "tier")


QUERIES = {f.__name__: f for f in (
    bronze_stream_land, bronze_row_id, silver_trim, silver_typed, expect_drop, expect_all, expect_fail,
    expect_metrics, expect_stream, dedup_by_key, scd1_stream, scd1_orders_stream, dq_leads, dq_web_events, dq_ops_events,
    quarantine_leads, quarantine_web_events, quarantine_ops_events, expect_stream_metrics, first_case_per_defect, dq_rate,
    sources_lookup, dq_conservation, quality_metrics, gate_status, gate_verdict, gated_publish, evidence_log, evidence_refused, silver_clients)}
QUERIES["latest_per_key"] = latest_per_key_query
