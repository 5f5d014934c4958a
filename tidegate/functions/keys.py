"""NULL-safe joins on several key columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame


def same_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])
