"""Sales medallion: typed silver tables and the gold revenue tables.

Line revenue is summed per order (or per part) before any join. The partial sums combine
inside each task, so an order or part with a third of all lines costs one row per task, and
the join that follows sees one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.functions.rules import SALES_RULES
from tidegate.operators.expectations import drop_failing
from tidegate.operators.ordering import global_ntile, global_rank
from tidegate.sources.tables import table


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim every string column, leave the others alone."""
    return df.select(*[F.trim(f.name).alias(f.name) if f.dataType.simpleString() == "string" else F.col(f.name)
                       for f in df.schema.fields])


def silver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Trimmed table without the rows that break its rules."""
    return trim_strings(drop_failing(table(spark, sf_dir, name), SALES_RULES.get(name, {})))


def line_revenue():
    """price * (1 - discount) as delivered: prices to 6 digits, discounts to 8, and no rounding of the product."""
    discount = F.coalesce(F.col("l_discount"), F.lit(0.0)).cast("decimal(9,8)")
    return F.col("l_extendedprice").cast("decimal(18,6)") * (F.lit(1).cast("decimal(1,0)") - discount)


def revenue_per_order(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    """Revenue by order; with `orders`, the lines of those orders only."""
    lines = silver(spark, sf_dir, "lineitem")
    if orders is not None:
        lines = lines.join(orders.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
    return lines.groupBy("l_orderkey").agg(F.sum(line_revenue()).alias("order_revenue"))


def monthly_revenue_by_region(spark: SparkSession, sf_dir: str, since: str | None = None, before: str | None = None) -> DataFrame:
    """Revenue by region and month; days from `since` up to, not including, `before` are pushed to the scan."""
    orders = silver(spark, sf_dir, "orders").filter("o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL")
    if since is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit(since)))
    if before is not None:
        orders = orders.filter(F.col("o_orderdate") < F.to_timestamp_ntz(F.lit(before)))
    customer = silver(spark, sf_dir, "customer").filter("c_custkey IS NOT NULL")
    # Before the sum only where a range makes the orders the smaller side.
    per_order = revenue_per_order(spark, sf_dir, orders if since or before else None)
    by_customer_month = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .groupBy("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month_date"))
        .agg(F.sum("order_revenue").alias("revenue"))
    )
    nation, region = silver(spark, sf_dir, "nation"), silver(spark, sf_dir, "region")
    return (
        by_customer_month.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("r_name").alias("region_name"), "month_date")
        .agg(F.sum("revenue").alias("revenue"))
    )


def customer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with orders, before the segment is attached."""
    orders = silver(spark, sf_dir, "orders").filter("o_orderkey IS NOT NULL AND o_custkey IS NOT NULL")
    customer = silver(spark, sf_dir, "customer").filter("c_custkey IS NOT NULL")
    per_order = revenue_per_order(spark, sf_dir)
    # Grouping by (order, customer) reuses the partitioning of the order join, so counting
    # distinct orders needs no shuffle of its own.
    order_grain = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .groupBy("o_orderkey", "o_custkey")
        .agg(F.sum("order_revenue").alias("revenue"), F.min("o_orderdate").alias("first_date"),
             F.max("o_orderdate").alias("last_date"))
    )
    per_customer = order_grain.groupBy("o_custkey").agg(
        F.count("*").alias("total_orders"), F.sum("revenue").alias("total_revenue"),
        F.min("first_date").alias("first_order_date"), F.max("last_date").alias("last_order_date"))
    return per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_custkey").alias("customer_key"), F.col("c_name").alias("customer_name"),
        "total_orders", "total_revenue",
        (F.col("total_revenue").cast("double") / F.col("total_orders")).alias("avg_order_value"),
        "first_order_date", "last_order_date")


def customer_lifetime_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = customer_metrics(spark, sf_dir)
    tiled = global_ntile(metrics, 5, [F.asc("total_revenue"), F.asc("customer_key")], "_tile")
    segment = (F.when(F.col("_tile") == 1, "Low").when(F.col("_tile").isin(2, 3, 4), "Medium")
               .when(F.col("_tile") == 5, "High").otherwise("Unknown"))
    return tiled.withColumn("value_segment", segment).drop("_tile")


def product_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = silver(spark, sf_dir, "part")
    per_part = silver(spark, sf_dir, "lineitem").filter("l_partkey IS NOT NULL").groupBy("l_partkey").agg(
        F.sum(line_revenue()).alias("total_revenue"),
        F.sum(F.col("l_quantity").cast("decimal(18,6)")).alias("total_quantity"),
        F.count_distinct("l_orderkey").alias("order_count"))
    return per_part.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_partkey").alias("product_key"), F.col("p_name").alias("product_name"),
        "total_revenue", "total_quantity", "order_count")


def top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return global_rank(product_metrics(spark, sf_dir), "total_revenue", "product_key", "revenue_rank")
