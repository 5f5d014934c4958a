"""Small helpers that several operators share."""

from __future__ import annotations

import pathlib
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.session import scratch_path

__all__ = ["fresh_name", "held_out", "ship", "shuffle_partitions", "stage", "table", "tokenizer_path"]


BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table, so that others never reach an operator."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def held_out(doc_id: str | Column, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves `remainder` modulo 5; a null id is not held out."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == remainder, F.lit(False))


def tokenizer_path(name: str) -> str:
    """Where an installed public vocabulary lies; every executor has the same installation."""
    import public_tokenizers

    return public_tokenizers.path(name)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder, compressed with zstd as texts dominate here, and return a scan of it."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package: Spark's file server hands the zipped code to them.

    Also keeps the batches that reach Python small, so that a worker's memory does not follow the rows' length.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = pathlib.Path(__file__).resolve().parents[1]
    name = f"{tempfile.mkdtemp(prefix='code-')}/{package.name}.zip"
    with zipfile.ZipFile(name, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(name)
    _shipped.add(context.applicationId)
