"""Reason-coded quarantine that conserves every input row.

A row keeps the union of the codes it earns; a row with any code is quarantined whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidegate.functions.codes import codes_where
from tidegate.functions.rules import VALID_STAGES
from tidegate.operators import expectations
from tidegate.sources.partitioned import AppendLog

REASONS = "_reasons"
ACCEPTED = "accepted"


def mark_repeats(df: DataFrame, key: str, arrival: str, name: str = "_repeat") -> DataFrame:
    """True for every row that is not the first arrival of its key (NULL is one key).

    The first arrival comes from an aggregate that combines before the shuffle, so a key
    with a third of all rows costs one small row per task. Only keys seen twice are joined
    back, and the join spreads a hot key over slices.
    """
    repeated = (
        df.groupBy(F.col(key).alias("_key"))
        .agg(F.min(arrival).alias("_first"), F.count("*").alias("_copies"))
        .filter("_copies > 1").drop("_copies")
    )
    joined = df.join(repeated, df[key].eqNullSafe(repeated["_key"]), "left")
    late = F.coalesce(F.col(arrival) > F.col("_first"), F.lit(False))
    return joined.withColumn(name, late).drop("_key", "_first")


def mark_known(df: DataFrame, foreign_key: str, dimension: DataFrame, key: str, arrival: str,
               name: str = "_known") -> DataFrame:
    """True when `foreign_key` names a row of `dimension`.

    NULL keys can never match; a second join column spreads them instead of sending them
    all to the one task that NULL hashes to.
    """
    keys = (
        dimension.select(F.col(key).alias("_dim_key")).filter("_dim_key IS NOT NULL").distinct()
        .withColumn("_dim_spread", F.lit(0).cast("bigint")).withColumn(name, F.lit(True))
    )
    spread = F.when(F.col(foreign_key).isNull(), F.xxhash64(arrival)).otherwise(F.lit(0).cast("bigint"))
    left = df.withColumn("_spread", spread)
    on = (left[foreign_key] == keys["_dim_key"]) & (left["_spread"] == keys["_dim_spread"])
    joined = left.join(keys, on, "left")
    return joined.withColumn(name, F.coalesce(name, F.lit(False))).drop(
        "_spread", "_dim_key", "_dim_spread")


def _checked(flagged: DataFrame) -> DataFrame:
    return expectations.fail_on(flagged, {"reasons_not_null": f"{REASONS} IS NOT NULL"})


def flag_leads(leads: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Leads with reason codes; `campaigns` are the rows the silver layer accepted."""
    trimmed = leads.withColumn("stage", F.trim("stage")).withColumn("email_domain", F.trim("email_domain"))
    marked = mark_repeats(trimmed, "lead_id", "_row_id")
    marked = mark_known(marked, "campaign_id", campaigns, "campaign_id", "_row_id")
    missing = F.col("campaign_id").isNull()
    return _checked(marked.withColumn(REASONS, codes_where(
        ("null_campaign_id", missing),
        ("unknown_campaign_id", ~missing & ~F.col("_known")),
        ("invalid_stage", F.col("stage").isNull() | ~F.col("stage").isin(*VALID_STAGES)),
        ("duplicate_lead_id", F.col("_repeat")),
    )).drop("_known", "_repeat"))


def flag_web_events(events: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Web events with reason codes."""
    marked = mark_repeats(events, "event_id", "_row_id")
    marked = mark_known(marked, "campaign_id", campaigns, "campaign_id", "_row_id")
    missing = F.col("campaign_id").isNull()
    duration = F.col("session_duration_seconds")
    return _checked(marked.withColumn(REASONS, codes_where(
        ("null_campaign_id", missing),
        ("unknown_campaign_id", ~missing & ~F.col("_known")),
        ("invalid_duration", duration.isNull() | (duration < 0)),
        ("duplicate_event_id", F.col("_repeat")),
    )).drop("_known", "_repeat"))


def flag_ops_events(events: DataFrame) -> DataFrame:
    """Operations events with reason codes."""
    marked = mark_repeats(events, "ops_event_id", "_row_id")
    latency = F.col("latency_seconds")
    return _checked(marked.withColumn(REASONS, codes_where(
        ("invalid_latency", latency.isNull() | (latency < 0)),
        ("duplicate_ops_event_id", F.col("_repeat")),
    )).drop("_repeat"))


def with_outcome(flagged: DataFrame) -> DataFrame:
    """Adds the boolean the persisted table is partitioned by."""
    return flagged.withColumn(ACCEPTED, F.size(REASONS) == 0)


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size(REASONS) == 0).drop(REASONS)


def quarantined(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size(REASONS) > 0).withColumn("_quarantined_ts", F.current_timestamp())


def save_quarantined(flagged: DataFrame, path: str, run: str) -> AppendLog:
    """Append the quarantined rows of a run, with the time of their quarantine; a retried run replaces its own rows."""
    rows = quarantined(flagged)
    log = AppendLog(flagged.sparkSession, path, rows.schema)
    log.append(rows, run)
    return log


def split_first_arrivals(df: DataFrame, key: str, arrival: str) -> tuple[DataFrame, DataFrame]:
    """(first arrival of each key, later copies)."""
    marked = mark_repeats(df, key, arrival)
    return marked.filter("NOT _repeat").drop("_repeat"), marked.filter("_repeat").drop("_repeat")


def reason_counts(flagged: dict[str, DataFrame]) -> DataFrame:
    """Rows per (source, reason), with accepted rows under the code `accepted`.

    A row with two codes counts under both, so the counts do not add up to the rows.
    """
    parts = [
        frame.select(F.lit(source).alias("source"),
                     F.explode(F.when(F.size(REASONS) == 0, F.array(F.lit("accepted")))
                               .otherwise(F.col(REASONS))).alias("reason"))
        for source, frame in flagged.items()
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("source", "reason").agg(F.count("*").alias("row_count"))
