"""Marketing and operations: flagged sources, the gate over them, and the gold tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions.rules import CAMPAIGN_RULES, QUARANTINE_RATE_THRESHOLD
from tidegate.operators import gate, quarantine
from tidegate.operators.expectations import drop_failing
from tidegate.operators.gate import safe_ratio
from tidegate.operators.ordering import latest_per_key
from tidegate.session import stage
from tidegate.sources import derived


def campaigns_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(derived.campaigns(spark, sf_dir), ["campaign_id"], ["_ingest_ts"])
    return drop_failing(newest, CAMPAIGN_RULES)


def clients_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest_per_key(derived.clients(spark, sf_dir), ["client_id"], ["_ingest_ts"])
    return newest.withColumn("client_name", F.trim("client_name"))


def leads_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.flag_leads(derived.leads(spark, sf_dir), campaigns_clean(spark, sf_dir))


def web_events_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.flag_web_events(derived.web_events(spark, sf_dir), campaigns_clean(spark, sf_dir))


def ops_events_flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine.flag_ops_events(derived.ops_events(spark, sf_dir))


@dataclass
class Batch:
    """One run: the inputs as they arrived and the outcome tables as they were written."""

    inputs: dict[str, DataFrame]
    persisted: dict[str, DataFrame]

    def clean(self, source: str) -> DataFrame:
        return self.persisted[source].filter(quarantine.ACCEPTED).drop(quarantine.ACCEPTED, quarantine.REASONS)

    def status(self, threshold: float = QUARANTINE_RATE_THRESHOLD) -> DataFrame:
        return gate.gate_status(self.inputs, self.persisted, threshold)


def run_batch(spark: SparkSession, sf_dir: str) -> Batch:
    """Flag each source once and write it partitioned by outcome.

    Accepted rows, quarantined rows, metrics and status all read that one table; without the
    write each of them would run the joins again.
    """
    flagged = {"leads": leads_flagged(spark, sf_dir), "web_events": web_events_flagged(spark, sf_dir),
               "ops_events": ops_events_flagged(spark, sf_dir)}
    inputs = {"leads": derived.leads(spark, sf_dir), "web_events": derived.web_events(spark, sf_dir),
              "ops_events": derived.ops_events(spark, sf_dir)}

    def write(source: str) -> DataFrame:
        return stage(quarantine.with_outcome(flagged[source]), source, (quarantine.ACCEPTED,))

    # The sources do not depend on each other, so their jobs share the cluster.
    with ThreadPoolExecutor(len(flagged)) as pool:
        persisted = dict(zip(flagged, pool.map(write, flagged)))
    return Batch(inputs, persisted)


def campaign_performance(campaigns: DataFrame, leads: DataFrame) -> DataFrame:
    per_campaign = leads.groupBy("campaign_id").agg(
        F.count("*").alias("lead_count"), F.count_if(F.col("stage") == "won").alias("won_count"))
    filled = campaigns.join(per_campaign, "campaign_id", "left").fillna({"lead_count": 0, "won_count": 0})
    n = F.col("lead_count")
    return filled.select(
        "campaign_id", "client_id", "channel", "budget", "status", "lead_count", "won_count",
        safe_ratio(F.col("won_count"), n, F.lit(0.0)).alias("conversion_rate"),
        safe_ratio(F.col("budget"), n, F.lit(None).cast("double")).alias("cost_per_lead"))


def client_funnel(campaigns: DataFrame, leads: DataFrame) -> DataFrame:
    """Counts per client and month; leads are counted per campaign and month before the join."""
    month = F.trunc(F.col("created_ts").cast("date"), "month").alias("month_date")
    stages = ("new", "qualified", "won", "lost")
    per_campaign = leads.groupBy("campaign_id", month).agg(
        *[F.count_if(F.col("stage") == s).alias(f"{s}_count") for s in stages], F.count("*").alias("total_leads"))
    return per_campaign.join(campaigns.select("campaign_id", "client_id"), "campaign_id").groupBy(
        "client_id", "month_date").agg(
        *[F.sum(f"{s}_count").alias(f"{s}_count") for s in stages], F.sum("total_leads").alias("total_leads"))


def ops_health(ops: DataFrame) -> DataFrame:
    daily = ops.groupBy(F.col("event_ts").cast("date").alias("event_date")).agg(
        F.count("*").alias("total_events"), F.count_if("success").alias("success_count"),
        F.sum("latency_seconds").alias("_latency"), F.count("latency_seconds").alias("_timed"),
        F.count_if(F.col("event_type") == "telegram_message").alias("telegram_messages"),
        F.count_if(F.col("event_type") == "daily_plan_run").alias("daily_plan_runs"))
    return daily.select(
        "event_date", "total_events", "success_count",
        safe_ratio(F.col("success_count"), F.col("total_events"), F.lit(0.0)).alias("success_rate"),
        safe_ratio(F.col("_latency"), F.col("_timed"), F.lit(None).cast("double")).alias("avg_latency_seconds"),
        "telegram_messages", "daily_plan_runs")
