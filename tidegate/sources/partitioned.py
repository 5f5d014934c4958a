"""Tables kept as partitioned Parquet: Spark prunes their folders and overwrites only those that a change touches.

Every write is one Spark job with `partitionOverwriteMode=dynamic`: the folders its rows belong to are replaced, all
others stay. A job that dies replaces nothing, and one that is done again replaces the same folders. A table has one
writer at a time; readers may see the folders of one write change one after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tidegate.functions import casts
from tidegate.functions.keys import same_keys

RANGE, HOME, RUN, SAVED = "_range", "_home", "_run", "saved_ts"
YEAR, MONTH, DAY = "yyyy", "yyyy-MM", "yyyy-MM-dd"  # how wide a range of dates is; a range should fill a few files
NO_RANGE = "none"  # sorts after all dates
FEW = 32  # so many folders a task fills side by side; rows of more folders are brought together first


def range_of(value: Column, width: str) -> Column:
    """The range a date or timestamp falls into, as a text that sorts like it."""
    return F.when(F.year(value).between(0, 9999), F.date_format(value, width)).otherwise(NO_RANGE)


def _create(spark: SparkSession, path: str, schema: T.StructType, by: str) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(by).parquet(path)


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Lets a task keep the files of so many folders open, instead of sorting its rows by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def _write(rows: DataFrame, path: str, by: str, few: bool, overwrite: str) -> None:
    """Write rows by folder: where they lie if the folders are few, so that the files of a folder are at most the tasks."""
    # REBALANCE gives each folder few files and splits a folder that holds a large share of the rows.
    placed = rows if few else rows.hint("rebalance", by)
    with _open_files(rows.sparkSession, FEW if few else 0):
        placed.write.mode("overwrite").option("partitionOverwriteMode", overwrite).option("compression", "zstd").partitionBy(by).parquet(path)


def _replace(rows: DataFrame, path: str, by: str, few: bool = False) -> None:
    _write(rows, path, by, few, "dynamic")


class PartitionedTarget:
    """The current row of each key, in one folder per range.

    A key stays in the range of its first row, so a newer version replaces it there and no folder
    ever has to be emptied. `range_expr` is SQL over the table's columns.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: tuple[str, ...], range_expr: str):
        self.spark, self.path, self.keys, self.range_expr = spark, path.rstrip("/"), tuple(keys), range_expr
        self.columns = schema.fieldNames()
        self.schema = T.StructType([*schema.fields, T.StructField(RANGE, T.StringType())])
        _create(spark, self.path, self.schema, RANGE)

    def read(self, ranges: list[str] | None = None) -> DataFrame:
        """The current rows with their range; a choice of ranges is a partition filter."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return rows if ranges is None else rows.filter(F.col(RANGE).isin(ranges))

    def rows(self) -> DataFrame:
        return self.read().select(*self.columns)

    def stored(self, asked: DataFrame, *columns: str) -> DataFrame:
        """Keys, home range and the given columns of the stored rows whose key occurs in `asked`.

        Only these columns are scanned, and while `asked` is small the table itself does not move.
        """
        found = self.read().select(*self.keys, *columns, F.col(RANGE).alias(HOME))
        if found.isEmpty():
            return found.filter(F.lit(False))  # nothing moves to meet an empty table
        wanted = asked.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)])
        return found.join(wanted, same_keys(found, wanted, [(k, f"_k{i}") for i, k in enumerate(self.keys)]), "left_semi")

    def put(self, winners: DataFrame) -> list[str]:
        """Store one row per key of `winners` (columns and HOME) in place of the stored one; returns the ranges written.

        HOME is the range of the stored row, as `stored` gives it, and null for a key that is not stored.

        Only the folders of these ranges are read and written; their number is bounded by the ranges of the table.
        `winners` is read twice, so it should be a staged table. The write replaces folders when all of its tasks are done, which
        is why it may read them.
        """
        placed = winners.select(*self.columns, F.coalesce(HOME, F.expr(self.range_expr)).alias(RANGE))
        touched = sorted(r[RANGE] for r in placed.select(RANGE).distinct().collect())
        if touched:
            old = self.read(touched)
            lost = winners.filter(F.col(HOME).isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)])
            kept = old.join(lost, same_keys(old, lost, [(k, f"_k{i}") for i, k in enumerate(self.keys)]), "left_anti")
            _replace(kept.unionByName(placed), self.path, RANGE, len(touched) <= FEW)
        return touched


class Landing:
    """Rows of a source as it delivered them, one folder per range of their cursor.

    A cursor that cannot be read lies in a folder of its own, which every window reads.
    """

    def __init__(self, spark: SparkSession, path: str, cursor: str, width: str = MONTH):
        self.spark, self.path, self.cursor, self.width = spark, path.rstrip("/"), cursor, width
        self._schema: T.StructType | None = None

    def deliver(self, extract: DataFrame) -> Landing:
        """Take over a snapshot of the source in place of the one before."""
        at = F.lit(NO_RANGE)
        if self.cursor in extract.columns:
            at = range_of(F.expr(casts.to_timestamp(f"cast(`{self.cursor}` AS string)")), self.width)
        rows = extract.withColumn(RANGE, at)
        self._schema = rows.schema
        _write(rows, self.path, RANGE, self.width == YEAR, "static")
        return self

    @property
    def columns(self) -> list[str]:
        return [c for c in self._schema.fieldNames() if c != RANGE]

    def count(self) -> int:
        """All delivered rows; Parquet's footers answer."""
        return self._read().count()

    def _read(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self.path)

    def since(self, floor: str | None) -> DataFrame:
        """Every row whose cursor may lie at or after `floor`; older folders are not opened."""
        rows = self._read()
        if floor is not None:
            rows = rows.filter(F.col(RANGE) >= F.lit(floor[:len(self.width)]))
        return rows.drop(RANGE)


class AppendLog:
    """Append-only rows with the time of their append, one folder per run; a repeated run replaces its own rows."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str):
        given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.spark, self.path = spark, path.rstrip("/")
        self.columns = given.fieldNames()
        self.schema = T.StructType([*given.fields, T.StructField(SAVED, T.TimestampType()), T.StructField(RUN, T.StringType())])
        _create(spark, self.path, self.schema, RUN)

    def append(self, rows: DataFrame, run: str) -> None:
        _replace(rows.select(*self.columns).withColumns({SAVED: F.current_timestamp(), RUN: F.lit(run)}), self.path, RUN)

    def read(self, run: str | None = None) -> DataFrame:
        """The rows of all runs, or of one by a partition filter."""
        rows = self.spark.read.schema(self.schema).parquet(self.path)
        return (rows if run is None else rows.filter(F.col(RUN) == run)).drop(RUN)
