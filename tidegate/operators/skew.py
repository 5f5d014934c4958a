"""A join that stays balanced when one key holds a large share of the rows.

Adaptive execution splits a skewed join by itself, except where the join feeds a grouping on
the same key: splitting would cost that grouping its partitioning, so Spark leaves the hot
key in one task. This join spreads such keys over numbered slices instead.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

def sliced_join(left: DataFrame, right: DataFrame, keys: list[str], spread_by: list[str],
                rows_per_slice: int | None = None, how: str = "left") -> DataFrame:
    """`left` joined to `right` (one row per key, same key names) on `keys`, NULL-safe.

    The rows per key are counted by an aggregate that combines before the shuffle. Keys above
    `rows_per_slice` get as many slices as they need, on both sides; all other keys keep one.
    By default a slice is the mean load of a shuffle partition, so there are at most as many
    such keys as shuffle partitions, which bounds the broadcast.
    """
    if rows_per_slice is None:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows_per_slice = max(left.count() // partitions, 1)
    names = [f"_hot{i}" for i in range(len(keys))]
    slices = F.ceil(F.count("*") / F.lit(rows_per_slice)).cast("int")
    hot = left.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(
        slices.alias("_slices")).filter("_slices > 1")

    def with_slices(df: DataFrame) -> DataFrame:
        on = reduce(lambda a, b: a & b, [df[k].eqNullSafe(hot[n]) for k, n in zip(keys, names)])
        return df.join(F.broadcast(hot), on, "left").withColumn("_slices", F.coalesce("_slices", F.lit(1))).drop(*names)

    spread = with_slices(left).withColumn(
        "_slice", F.pmod(F.xxhash64(*spread_by), F.col("_slices")).cast("int")).drop("_slices")
    copies = with_slices(right).withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    renamed = copies.select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("_slice").alias("_right_slice"),
                            *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [spread[k].eqNullSafe(renamed[n]) for k, n in zip(keys, names)])
    return spread.join(renamed, on & (spread["_slice"] == renamed["_right_slice"]), how).drop(
        *names, "_slice", "_right_slice")
