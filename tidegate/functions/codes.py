"""Arrays of the codes whose condition holds.

Concatenating one-element arrays stays inside generated code; filtering NULLs out of an
array runs a lambda per row and takes the whole projection out of it.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def codes_where(*coded: tuple[str, Column]) -> Column:
    """array<string> of the codes whose condition is true, in the given order; never NULL."""
    none = F.array().cast("array<string>")
    return F.concat(*[F.when(condition, F.array(F.lit(code))).otherwise(none) for code, condition in coded])


def entries_where(coded: list[tuple[str, str]], array_type: str) -> str:
    """The same as SQL text, for (condition, value) pairs of any array type."""
    none = f"cast(array() AS {array_type})"
    return "concat(" + ", ".join(f"if({condition}, array({value}), {none})" for condition, value in coded) + ")"
