"""Labelled faults in copies of a table, to measure whether the checks find them.

Every injector takes the rows to touch as a condition and returns the changed rows together
with one label (defect, key) per touched key. `sampled` is the seeded, hashed condition.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Injected:
    rows: DataFrame
    labels: DataFrame  # defect string, key string


def sampled(keys: list[str], one_in: int, seed: int = 7) -> Column:
    """True for about one row in `one_in`, the same rows in every run."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(one_in)) == 0


def at_rate(keys: list[str], rate: float, seed: int = 7) -> Column:
    """True for the given share of rows; a share outside [0, 1] fails the job that uses it."""
    share = F.lit(rate).cast("double")
    drawn = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1 << 20)) / float(1 << 20)
    return F.when(share.between(0, 1), drawn < share).otherwise(
        F.raise_error(F.lit(f"{rate!r} is no share")).cast("boolean"))


def _label(df: DataFrame, where: Column, defect: str, keys: list[str]) -> DataFrame:
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.filter(where).select(F.lit(defect).alias("defect"), text.alias("key")).distinct()


def overwrite_value(df: DataFrame, defect: str, keys: list[str], where: Column, column: str, value) -> Injected:
    """bad_unit_price, invalid_status, and the fact faults: one column gets a wrong value."""
    wrong = F.when(where, F.lit(value).cast(df.schema[column].dataType)).otherwise(F.col(column))
    return Injected(df.withColumn(column, wrong), _label(df, where, defect, keys))


def keyless_copies(df: DataFrame, keys: list[str], where: Column, label: list[str] | None = None) -> Injected:
    """null_key: copies of the touched rows that arrive without their first key column.

    `label` names the columns of the label's key, where detections can only name others than the lost key.
    """
    copies = df.filter(where).withColumn(keys[0], F.lit("").cast(df.schema[keys[0]].dataType))
    return Injected(df.unionByName(copies), _label(df, where, "null_key", label or keys))


def conflicting_copies(df: DataFrame, keys: list[str], where: Column, column: str, value) -> Injected:
    """duplicate_key: copies with the same key and cursor and another content."""
    copies = df.filter(where).withColumn(column, F.lit(value).cast(df.schema[column].dataType))
    return Injected(df.unionByName(copies), _label(df, where, "duplicate_key", keys))


def double_charges(payments: DataFrame, where: Column, offset: int) -> Injected:
    """duplicate_charge: the same settlement again under a new payment id."""
    again = payments.filter(where).withColumn(
        "payment_id", (F.col("payment_id").cast("bigint") + offset).cast(payments.schema["payment_id"].dataType))
    return Injected(payments.unionByName(again), _label(payments, where, "duplicate_charge", ["order_id"]))


def missing_payments(payments: DataFrame, where: Column) -> Injected:
    return Injected(payments.filter(~where), _label(payments, where, "missing_payment", ["order_id"]))


def late_arrivals(df: DataFrame, keys: list[str], where: Column, cursor: str, back_dated: str) -> Injected:
    """late_arrival: the touched rows carry a cursor before the read window."""
    moved = F.when(where, F.lit(back_dated)).otherwise(F.col(cursor).cast("string"))
    return Injected(df.withColumn(cursor, moved), _label(df, where, "late_arrival", keys))


def stale_extract(df: DataFrame, cursor: str, since: str) -> DataFrame:
    """stale_source: nothing newer than `since` is delivered."""
    return df.filter(F.col(cursor) <= F.lit(since))


def removed_column(df: DataFrame, column: str) -> DataFrame:
    return df.drop(column)


def added_column(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.withColumn(column, F.lit(value))


def recall(labels: DataFrame, detections: DataFrame) -> DataFrame:
    """Per defect: labels, labels with a detection of the same defect and key, and the share."""
    found = detections.select("defect", "key").distinct().withColumn("_found", F.lit(True))
    return labels.join(found, ["defect", "key"], "left").groupBy("defect").agg(
        F.count("*").alias("injected"), F.count("_found").alias("detected")).withColumn(
        "recall", F.col("detected").cast("double") / F.col("injected"))
