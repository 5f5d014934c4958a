"""Ratios over labelled results, for all of them and by group, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidegate.operators.gate import safe_ratio


def summary(results: DataFrame, defects: tuple[str, ...]) -> DataFrame:
    """One row overall, one per defect and one per day (`level` says which).

    `results`: day, defect (the expected label), rule (the label given, may be NULL), reported, cited (booleans), injected,
    detected (row counts). A defect of `defects` without results has a row of zeros, and so has the whole where nothing was evaluated;
    a ratio of nothing is 0. Rows are expanded once per grouping set and combine before the shuffle.
    """
    spark = results.sparkSession
    # One row of weight 0 per defect makes its group exist.
    empty = spark.createDataFrame([(d,) for d in defects], "defect string").select("defect", F.lit(0).cast("bigint").alias("weight"))
    rows = results.withColumn("weight", F.lit(1).cast("bigint")).unionByName(empty, allowMissingColumns=True)

    def cases(condition: Column) -> Column:
        return F.count_if((F.col("weight") == 1) & F.coalesce(condition, F.lit(False)))

    counted = rows.groupingSets([[], ["defect"], ["day"]], "defect", "day").agg(
        F.grouping_id("defect", "day").alias("_set"), F.sum("weight").alias("cases"),
        cases(F.col("rule") == F.col("defect")).alias("correct"), cases(F.col("rule").isNull()).alias("unlabelled"),
        cases(F.col("reported")).alias("reported"), cases(F.col("reported") & (F.col("rule") == F.col("defect"))).alias("routed"),
        cases(F.col("reported") & F.col("cited")).alias("cited"), F.coalesce(F.sum("injected"), F.lit(0)).alias("injected"),
        F.coalesce(F.sum("detected"), F.lit(0)).alias("detected"))
    level = F.when(F.col("_set") == 3, "overall").when(F.col("_set") == 1, "defect").otherwise("day")
    none = F.lit(0.0)
    return counted.filter("_set <> 2 OR day IS NOT NULL").select(
        level.alias("level"), "defect", "day", "cases", "correct", "unlabelled", "reported", "routed", "cited", "injected", "detected",
        safe_ratio(F.col("correct"), F.col("cases"), none).alias("accuracy"),
        safe_ratio(F.col("routed"), F.col("cases"), none).alias("routed_share"),
        safe_ratio(F.col("cited"), F.col("reported"), none).alias("cited_share"),
        safe_ratio(F.col("detected"), F.col("injected"), none).alias("recall"))
