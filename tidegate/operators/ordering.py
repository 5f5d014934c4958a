"""Total-order operators that never gather the rows in one task.

A window without PARTITION BY moves every row to a single task, and a window over a hot
key does the same for that key. Here the rows are range-partitioned by the sort itself,
numbered inside their partition, and shifted by the sizes of the partitions before. Only
those sizes (one row per shuffle partition) are brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidegate.session import stage

_INDEX_BITS = 33  # layout of monotonically_increasing_id: partition above, row index below


def _sorted_slices(df: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in total order with `_slice` (ascending range) and `_index` (place within it)."""
    numbered = df.orderBy(*order).withColumn("_mid", F.monotonically_increasing_id())
    staged = stage(numbered, "sorted")
    return staged.select(
        "*",
        F.shiftright("_mid", _INDEX_BITS).alias("_slice"),
        F.col("_mid").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)).alias("_index"),
    ).drop("_mid")


def _prefix(sizes: DataFrame, value: str, name: str) -> DataFrame:
    """Running total of `value` over the slices before each one; one row per slice."""
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn(name, F.sum(value).over(before))


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number",
                      total: str | None = None) -> DataFrame:
    """Number the rows 1..N in `order`, which must be unique; `total` adds N itself."""
    slices = _sorted_slices(df, order)
    sizes = slices.groupBy("_slice").agg(F.count("*").alias("_size"))
    offsets = _prefix(sizes, "_size", "_before")
    if total:
        offsets = offsets.withColumn(total, F.sum("_size").over(Window.partitionBy()))
    # At most spark.sql.shuffle.partitions rows, so the broadcast has a fixed bound.
    joined = slices.join(F.broadcast(offsets.drop("_size")), "_slice")
    return joined.withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_index") + 1).drop(
        "_slice", "_index", "_before")


def global_ntile(df: DataFrame, tiles: int, order: list[Column], name: str) -> DataFrame:
    """NTILE over the whole frame: the first N mod tiles groups hold one row more."""
    numbered = global_row_number(df, order, "_rn", "_total")
    small = F.expr(f"_total div {tiles}")
    larger = F.expr(f"_total % {tiles}")
    in_larger = larger * (small + 1)
    tile = F.when(
        F.col("_rn") <= in_larger,
        F.expr(f"(_rn - 1) div ((_total div {tiles}) + 1)") + 1,
    ).otherwise(larger + F.expr(
        f"(_rn - 1 - (_total % {tiles}) * ((_total div {tiles}) + 1)) div greatest(_total div {tiles}, 1)") + 1)
    return numbered.withColumn(name, tile.cast("int")).drop("_rn", "_total")


def global_rank(df: DataFrame, by: str, key: str, name: str, descending: bool = True) -> DataFrame:
    """RANK with gaps by one column; `key` is a unique column that orders ties."""
    first = F.desc(by) if descending else F.asc(by)
    numbered = global_row_number(df, [first, F.asc(key)], "_rn")
    # Only values that occur more than once need to look up their first position.
    tied = (
        numbered.groupBy(F.col(by).alias("_value"))
        .agg(F.min("_rn").alias("_first"), F.count("*").alias("_copies")).filter("_copies > 1")
        .drop("_copies")
    )
    joined = numbered.join(tied, numbered[by].eqNullSafe(tied["_value"]), "left")
    return joined.withColumn(name, F.coalesce("_first", "_rn")).drop("_rn", "_first", "_value")


def running_total(df: DataFrame, value: str, order: list[Column], name: str) -> DataFrame:
    """SUM(value) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING); `order` must be unique."""
    slices = _sorted_slices(df, order)
    sums = slices.groupBy("_slice").agg(F.sum(value).alias("_sum"))
    offsets = _prefix(sums, "_sum", "_before").drop("_sum")
    inside = Window.partitionBy("_slice").orderBy("_index").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    local = slices.withColumn("_local", F.sum(value).over(inside))
    joined = local.join(F.broadcast(offsets), "_slice")
    # Like the window, NULL only while every value so far is NULL.
    whole = F.coalesce(F.col("_before") + F.col("_local"), F.col("_before"), F.col("_local"))
    return joined.withColumn(name, whole).drop("_slice", "_index", "_before", "_local")


def position_in_group(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """ROW_NUMBER per group where a group may be too large for one task."""
    numbered = global_row_number(df, [F.asc(group), *order], "_rn")
    starts = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("_rn").alias("_start"))
    joined = numbered.join(starts, numbered[group].eqNullSafe(starts["_group"]))
    return joined.withColumn(name, F.col("_rn") - F.col("_start") + 1).drop("_rn", "_start", "_group")


def carried_forward(df: DataFrame, key: str, order: list[Column], values: dict[str, Column]) -> DataFrame:
    """Each row with the last non-NULL value of its key at or before it, under the given names.

    Rows are range-sorted by (key, order), so a key with many rows lies in several neighbouring slices. Inside a slice a window
    carries the values; across slices only the key that a slice ends with can go on, which is one row per slice.
    """
    named = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    slices = _sorted_slices(named, [F.asc(key), *order])
    edges = slices.groupBy("_slice").agg(
        F.min_by(key, "_index").alias("_first_key"), F.max_by(key, "_index").alias("_last_key"))
    # The last known values of the key a slice ends with; at most spark.sql.shuffle.partitions rows.
    ends = slices.join(F.broadcast(edges), "_slice").filter(F.col(key).eqNullSafe(F.col("_last_key"))).groupBy("_slice").agg(
        *[F.max_by(F.when(F.col(f"_v_{n}").isNotNull(), F.col(f"_v_{n}")), F.when(F.col(f"_v_{n}").isNotNull(), F.col("_index")))
          .alias(f"_e_{n}") for n in values])
    run, before = Window.partitionBy("_last_key").orderBy("_slice"), Window.orderBy("_slice")
    known = edges.join(ends, "_slice").withColumns({f"_e_{n}": F.last(f"_e_{n}", ignorenulls=True).over(run) for n in values})
    goes_on = F.lag("_last_key").over(before).eqNullSafe(F.col("_first_key")) & F.lag("_slice").over(before).isNotNull()
    carried = known.select("_slice", "_first_key", *[F.when(goes_on, F.lag(f"_e_{n}").over(before)).alias(f"_c_{n}") for n in values])
    inside = Window.partitionBy("_slice", key).orderBy("_index").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = slices.withColumns({f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values})
    whole = local.join(F.broadcast(carried), "_slice")
    from_before = F.col(key).eqNullSafe(F.col("_first_key"))
    return whole.select(*df.columns, *[F.coalesce(f"_l_{n}", F.when(from_before, F.col(f"_c_{n}"))).alias(n) for n in values])


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row of each key, by an aggregate that combines before the shuffle.

    The rest of the row breaks ties, so the result does not depend on arrival at the task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    newest = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_row"))
    return newest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The earliest row of each key; the mirror of latest_per_key."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    oldest = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_row"))
    return oldest.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])
