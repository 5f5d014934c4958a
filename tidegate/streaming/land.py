"""Append streams: land a table with audit columns, validate rows on the way."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators.expectations import Rules, drop_failing, observed
from tidegate.sources.tables import audit_columns


def read_incrementally(spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet",
                       files_per_trigger: int | None = None) -> DataFrame:
    """New parquet files of a folder as a stream; only names matching `files` are read."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def append_available(stream: DataFrame, target: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Process everything that has arrived, then stop; the checkpoint makes reruns no-ops."""
    writer = stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).option("path", target).start()


def land(stream: DataFrame, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append untouched source columns plus the two audit columns."""
    return append_available(stream.select("*", *audit_columns(source)), target, checkpoint)


def validate(stream: DataFrame, rules: Rules, target: str, checkpoint: str, metrics: str = "rules",
             prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Count rule failures with an observation and append the rows that meet every rule.

    The counts of each micro-batch are in the query's progress under `metrics`.
    """
    rows = prepare(stream) if prepare else stream
    return append_available(drop_failing(observed(rows, rules, metrics), rules), target, checkpoint)
