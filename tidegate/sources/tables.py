"""Batch and incremental scans of tables stored as parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Batch scan of one table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def audit_columns(source: str) -> list[Column]:
    """The two columns every landed row carries besides its untouched source columns."""
    return [F.current_timestamp().alias("_ingest_ts"), F.lit(source).alias("_source_table")]


def with_arrival_order(df: DataFrame, name: str = "_row_id") -> DataFrame:
    """Stamp the arrival position of each row of a file scan.

    File modification time, path and row index order the rows of a landing folder; unlike
    a generated id the stamp does not depend on how the scan was split into tasks.
    """
    return df.withColumn(
        name,
        F.struct(
            F.col("_metadata.file_modification_time").alias("landed_at"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.row_index").alias("row"),
        ),
    )


def string_extract(df: DataFrame, *columns: Column) -> DataFrame:
    """A source extract the way CSV, REST and JDBC dumps deliver it: text only."""
    picked = df.select(*columns) if columns else df
    return picked.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in picked.columns])


def read_delimited(spark: SparkSession, path: str, columns: list[str], **options: str) -> DataFrame:
    """A headed CSV extract as text; the contract decides the types later."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.options(header="true", enforceSchema="false", **options).schema(schema).csv(path)


def read_jdbc_extract(spark: SparkSession, url: str, source_table: str, key: str, bounds: tuple[int, int],
                      partitions: int, cursor: str | None = None, floor: str | None = None, **options: str) -> DataFrame:
    """A JDBC extract read in parallel key ranges, as text; with a floor, the database filters by the cursor."""
    rows = (
        spark.read.format("jdbc").options(**options)
        .option("url", url).option("dbtable", source_table).option("partitionColumn", key)
        .option("lowerBound", bounds[0]).option("upperBound", bounds[1])
        .option("numPartitions", partitions).load()
    )
    if cursor is not None and floor is not None:
        # A comparison of the plain column, so it becomes part of the statement that the database runs.
        rows = rows.filter(F.col(cursor).isNull() | (F.col(cursor) >= F.lit(floor).cast(rows.schema[cursor].dataType)))
    return string_extract(rows)


def read_event_log(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """A JSON-lines log; a torn line belongs to a write that never finished and is skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
