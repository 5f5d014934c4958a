"""Regulated gaming and retail: validated silver, daily activity, flags, sales report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions.rules import GAMING_RULES
from tidegate.operators import risk
from tidegate.operators.expectations import drop_failing
from tidegate.sources import derived

_RAW = {"players": derived.players, "wagers": derived.wagers, "deposits": derived.deposits,
        "sessions": derived.sessions, "licensees": derived.licensees, "orders": derived.retail_orders}

REPORT_KEY = ("domain", "region", "product_category", "order_date")


def clean(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """Validated rows of an entity; text dates become dates without failing on bad ones."""
    rows = drop_failing(_RAW[entity](spark, sf_dir), GAMING_RULES[entity])
    if entity == "players":
        return rows.withColumn("signup_date", F.try_to_date("signup_date"))
    if entity == "orders":
        return rows.withColumn("order_date", F.try_to_date("order_date"))
    return rows


def player_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.player_daily(clean(spark, sf_dir, "wagers"), clean(spark, sf_dir, "deposits"),
                             clean(spark, sf_dir, "sessions"))


def player_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.player_flags(clean(spark, sf_dir, "players"), player_daily(spark, sf_dir))


def retail_sales_daily(orders: DataFrame, licensees: DataFrame) -> DataFrame:
    """Sums per licensee first, so a licensee with a third of all orders joins as few rows."""
    per_licensee = orders.groupBy("licensee_id", "domain", "product_category", "order_date").agg(
        F.count("*").alias("order_count"), F.sum("quantity").alias("units"), F.sum("amount").alias("revenue"))
    return per_licensee.join(licensees.select("licensee_id", "region"), "licensee_id").groupBy(*REPORT_KEY).agg(
        F.sum("order_count").alias("order_count"), F.sum("units").alias("units"),
        F.round(F.sum("revenue"), 2).alias("revenue"))


LEGACY_REPORT = """
SELECT o.domain, l.region, o.product_category, o.order_date,
       count(*) AS order_count, sum(o.quantity) AS units, round(sum(o.amount), 2) AS revenue
FROM {orders} o
JOIN (SELECT licensee_id, region FROM {licensees}
      WHERE licensee_id IS NOT NULL AND domain IN ('liquor', 'cannabis')) l
  ON o.licensee_id = l.licensee_id
WHERE o.amount >= 0 AND o.quantity > 0
GROUP BY o.domain, l.region, o.product_category, o.order_date
"""


def legacy_retail_sales_daily(spark: SparkSession, raw_orders: DataFrame, raw_licensees: DataFrame) -> DataFrame:
    """The same report written a second time, as SQL over the raw rows, for reconciliation."""
    report = spark.sql(LEGACY_REPORT, orders=raw_orders, licensees=raw_licensees)
    return report.withColumn("order_date", F.try_to_date("order_date"))
