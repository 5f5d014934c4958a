"""Types of text columns, inferred from all of their values and widened when more rows arrive.

What is known of a column is a row of counts and digit widths. Two such rows merge by sums and maxima, in any order,
so the type of many deliveries is the type of their merged rows. A type holds every value seen; the order of widening is nothing,
boolean, integer, decimal; date, timestamp; and text for all that do not fit together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.functions import casts

# Digits without leading zeros: an id like 007 would lose its text as a number.
_INTEGER = "^-?(0|[1-9][0-9]{0,17})$"
_DECIMAL = "^-?(0|[1-9][0-9]*)[.][0-9]+$"
_MOST_DIGITS = 38
COUNTS = ("rows", "filled", "booleans", "integers", "decimals", "dates", "timestamps")
WIDTHS = ("whole", "fraction")


def profile(texts: DataFrame) -> DataFrame:
    """One row per column of `texts` (all strings): what its values could be; a blank is no value.

    One aggregate over all columns that combines before the shuffle.
    """
    def counters(column: str) -> list[Column]:
        raw = f"`{column}`"
        clean = casts.stripped(raw)
        filled = f"coalesce({clean}, '') <> ''"
        number = f"{clean} RLIKE '{_INTEGER}' OR {clean} RLIKE '{_DECIMAL}'"
        tests = {
            "filled": filled, "booleans": f"{clean} IN ('true', 'false')", "integers": f"{clean} RLIKE '{_INTEGER}'",
            "decimals": number, "dates": f"length({clean}) = 10 AND {casts.to_date(clean)} IS NOT NULL",
            "timestamps": f"{casts.to_timestamp(clean)} IS NOT NULL"}
        counted = [F.expr(f"count_if({test})").alias(name) for name, test in tests.items()]
        digits = [F.expr(f"coalesce(max(if({number}, length(replace(substring_index({clean}, '.', 1), '-', '')), 0)), 0)").alias("whole"),
                  F.expr(f"coalesce(max(if({clean} RLIKE '{_DECIMAL}', length(substring_index({clean}, '.', -1)), 0)), 0)").alias("fraction")]
        return [F.lit(column).alias("column"), F.count("*").alias("rows"), *counted, *digits]

    columns = texts.columns
    wide = texts.agg(*[F.struct(*counters(c)).alias(f"c{i}") for i, c in enumerate(columns)])
    return wide.select(F.inline(F.array(*[f"c{i}" for i in range(len(columns))])))


def merge(*profiles: DataFrame) -> DataFrame:
    """The profile of all rows together; a column that a delivery lacks keeps what the others know."""
    whole = profiles[0]
    for more in profiles[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("column").agg(*[F.sum(c).alias(c) for c in COUNTS], *[F.max(c).alias(c) for c in WIDTHS])


def ddl_type() -> Column:
    """The narrowest type that holds every value of a profiled column."""
    def all_of(count: str) -> Column:
        return F.col(count) == F.col("filled")

    decimal = F.concat(F.lit("decimal("), (F.col("whole") + F.col("fraction")).cast("string"), F.lit(","),
                       F.col("fraction").cast("string"), F.lit(")"))
    fits = F.col("whole") + F.col("fraction") <= _MOST_DIGITS
    return (F.when(F.col("filled") == 0, "string").when(all_of("booleans"), "boolean").when(all_of("integers"), "bigint")
            .when(all_of("decimals") & fits, decimal).when(all_of("dates"), "date").when(all_of("timestamps"), "timestamp_ntz")
            .otherwise("string"))


def types_of(profiled: DataFrame) -> dict[str, str]:
    """Type by column; one row per column comes to the driver."""
    return {r["column"]: r["type"] for r in profiled.select("column", ddl_type().alias("type")).collect()}


def typed(texts: DataFrame, types: dict[str, str]) -> DataFrame:
    """The texts under inferred types: blanks are NULL in typed columns, text stays as delivered, lacking columns are NULL."""
    def value(column: str, kind: str) -> str:
        if column not in texts.columns:
            return f"cast(NULL AS {kind}) AS `{column}`"
        clean = casts.stripped(f"`{column}`")
        made = f"`{column}`" if kind == "string" else f"cast(nullif({clean}, '') AS {kind})"
        if kind == "timestamp_ntz":
            made = casts.to_timestamp(clean)
        return f"{made} AS `{column}`"

    return texts.selectExpr(*[value(c, kind) for c, kind in types.items()])
