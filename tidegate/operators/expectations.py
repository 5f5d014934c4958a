"""Declarative row rules: drop, warn, fail, and count.

A rule is a name and a SQL predicate. A row meets it only when the predicate is true;
false and NULL both fail it, the way a filter treats them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from tidegate.functions.codes import codes_where

Rules = dict[str, str]


def met(predicate: str) -> Column:
    """True or false, never NULL."""
    return F.coalesce(F.expr(predicate), F.lit(False))


def all_met(rules: Rules) -> Column:
    return reduce(lambda a, b: a & b, [met(p) for p in rules.values()])


def drop_failing(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that meet every rule; plain filters, so they reach the scan."""
    return reduce(lambda frame, predicate: frame.filter(predicate), rules.values(), df)


def mark_failing(df: DataFrame, rules: Rules, name: str = "_failed_rules") -> DataFrame:
    """Keep every row and list the rules it fails, in rule order."""
    return df.withColumn(name, codes_where(*[(rule, ~met(p)) for rule, p in rules.items()]))


def fail_on(df: DataFrame, rules: Rules) -> DataFrame:
    """Stop the job at the first row that fails a rule.

    The check sits in a filter because an unused projected column would be pruned away.
    """
    for rule, predicate in rules.items():
        stop = F.raise_error(F.lit(f"expectation failed: {rule} ({predicate})")).cast("boolean")
        df = df.filter(F.when(met(predicate), F.lit(True)).otherwise(stop))
    return df


def rule_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """One row per rule with passed and failed row counts, from a single aggregate."""
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(~met(p)).alias(f"_f{i}") for i, p in enumerate(rules.values())],
    )
    entries = [
        F.struct(F.lit(rule).alias("rule"), (F.col("_rows") - F.col(f"_f{i}")).alias("passed"),
                 F.col(f"_f{i}").alias("failed"))
        for i, rule in enumerate(rules)
    ]
    return counted.select(F.inline(F.array(*entries)))


def observed(df: DataFrame, rules: Rules, name: str | Observation) -> DataFrame:
    """Count rule failures while the rows flow past; works on batch and streaming frames."""
    counters = [F.count_if(~met(p)).alias(rule) for rule, p in rules.items()]
    return df.observe(name, F.count("*").alias("rows"), *counters)
