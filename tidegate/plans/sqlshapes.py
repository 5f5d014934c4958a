"""The meaning of legacy query shapes, written as Spark plans over the sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.operators.ordering import running_total
from tidegate.operators.scripts import month_boundaries
from tidegate.plans.present import plain
from tidegate.sources.tables import table


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some names end in spaces, some regions are missing."""
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).selectExpr(
        "c_custkey AS customer_id", "if(c_custkey % 4 = 0, concat(c_name, '   '), c_name) AS name",
        "if(c_custkey % 7 = 0, NULL, n_name) AS region",
        "timestamp_ntz'2020-01-15 08:00:00' + make_dt_interval(cast(c_custkey % 900 AS int)) AS created_at")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id",
        """CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'shipped'
                WHEN o_orderstatus = 'P' THEN 'paid' WHEN o_orderkey % 10 = 0 THEN 'cancelled' ELSE 'placed' END AS status""",
        "cast(o_orderdate AS date) AS order_date",
        "o_orderdate + make_dt_interval(0, 0, 0, o_orderkey % 86400) AS updated_at")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS order_id", "l_partkey * 10 + l_linenumber AS line_no",
        "cast(floor(l_quantity) AS bigint) AS quantity", "cast(l_extendedprice AS decimal(18,2)) AS unit_price")


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order from a minimum total on; some without amount or date, some of
    unknown orders."""
    return table(spark, sf_dir, "orders").filter("o_totalprice >= 20000").selectExpr(
        "o_orderkey AS payment_id", "if(o_orderkey % 59 = 0, -o_orderkey - 1, o_orderkey) AS order_id",
        "if(o_orderkey % 17 = 0, NULL, cast(o_totalprice AS decimal(18,2))) AS amount",
        "if(o_orderkey % 23 = 0, NULL, date_add(cast(o_orderdate AS date), cast(o_orderkey % 9 AS int))) AS settled_date")


def sql_isnull(spark, sf_dir):
    """ISNULL(x, d)."""
    return orders(spark, sf_dir).select("order_id", F.coalesce("status", F.lit("unknown")).alias("status"))


def sql_top_ordered(spark, sf_dir):
    """SELECT TOP 3 ... ORDER BY."""
    return orders(spark, sf_dir).select("order_id", "order_date").orderBy(
        F.desc("order_date"), F.desc("order_id")).limit(3)


def sql_convert_date(spark, sf_dir):
    """GROUP BY CONVERT(date, x)."""
    return orders(spark, sf_dir).groupBy(F.expr("try_cast(updated_at AS date)").alias("update_day")).agg(
        F.count("*").alias("n"))


def sql_dateadd(spark, sf_dir):
    """DATEADD(day, 30, x)."""
    return orders(spark, sf_dir).select("order_id", F.date_add("order_date", 30).alias("due_date"))


def sql_datediff_day(spark, sf_dir):
    """DATEDIFF(day, a, b) over a join; a missing date gives NULL."""
    o, p = orders(spark, sf_dir).select("order_id", "order_date"), payments(spark, sf_dir)
    return plain(o.join(p, "order_id").select(
        "order_id", "payment_id", F.datediff("settled_date", "order_date").alias("days_to_pay")))


def sql_datediff_month(spark, sf_dir):
    """DATEDIFF(month, a, b) counts the month boundaries crossed."""
    end = F.expr("timestamp_ntz'2026-11-01 00:00:00'")
    return customers(spark, sf_dir).select("customer_id", month_boundaries(F.col("created_at"), end).alias("months"))


def sql_iif(spark, sf_dir):
    """IIF takes the else branch when the condition is unknown."""
    return payments(spark, sf_dir).select(
        "payment_id", F.when(F.col("amount") >= 200000, "large").otherwise("small").alias("size"))


def sql_string_plus(spark, sf_dir):
    """'ORD-' + CAST(id AS VARCHAR)."""
    return orders(spark, sf_dir).selectExpr("order_id", "'ORD-' || cast(order_id AS string) AS order_code")


def sql_len(spark, sf_dir):
    """LEN ignores trailing spaces."""
    return customers(spark, sf_dir).select(
        "customer_id", F.length(F.rtrim("name")).cast("bigint").alias("name_len"))


def sql_latest_order_window(spark, sf_dir):
    """ROW_NUMBER() = 1 per customer, as an aggregate that combines before the shuffle."""
    newest = orders(spark, sf_dir).groupBy("customer_id").agg(
        F.max(F.struct("order_date", "order_id")).alias("_newest"))
    return newest.select("customer_id", F.col("_newest.order_id").alias("order_id"))


def sql_running_total(spark, sf_dir):
    """SUM() OVER (ORDER BY ... ROWS UNBOUNDED PRECEDING) without one task for all rows."""
    rows = payments(spark, sf_dir).filter("settled_date IS NOT NULL").select("settled_date", "payment_id", "amount")
    total = running_total(rows, "amount", [F.asc("settled_date"), F.asc("payment_id")], "running")
    return plain(total.select("payment_id", "running"))


def _amounts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("order_id").agg(
        F.sum(F.col("quantity").cast("decimal(20,0)") * F.col("unit_price")).alias("amount"))


def sql_revenue_having(spark, sf_dir):
    """Join, filter, GROUP BY customer HAVING SUM(...) > limit; lines are summed per order first."""
    o = orders(spark, sf_dir).filter(F.col("status").isin("paid", "shipped")).select("order_id", "customer_id")
    revenue = o.join(_amounts(order_lines(spark, sf_dir)), "order_id").groupBy("customer_id").agg(
        F.sum("amount").alias("revenue"))
    return plain(revenue.filter(F.col("revenue") > 30000000))


def sql_unpaid_antijoin(spark, sf_dir):
    """LEFT JOIN ... WHERE right IS NULL."""
    o = orders(spark, sf_dir).filter(F.col("status").isin("paid", "shipped")).select("order_id")
    return o.join(payments(spark, sf_dir).select("order_id"), "order_id", "left_anti")


def sql_integer_division(spark, sf_dir):
    """int / int truncates."""
    return order_lines(spark, sf_dir).selectExpr("order_id", "line_no", "quantity div 2 AS half_qty")


def sql_cte_daily(spark, sf_dir):
    """WITH daily AS (...); a NULL status fails `<> 'cancelled'`."""
    o = orders(spark, sf_dir).filter("status <> 'cancelled'").select("order_id", "order_date")
    return plain(o.join(_amounts(order_lines(spark, sf_dir)), "order_id").groupBy("order_date").agg(
        F.sum("amount").alias("revenue")))


def sql_nolock(spark, sf_dir):
    """A table hint changes nothing; the filter reaches the scan."""
    return orders(spark, sf_dir).filter("customer_id = 2").select("order_id", "status")


def sql_count_distinct_case(spark, sf_dir):
    """COUNT(DISTINCT ...) next to SUM(CASE ...)."""
    return orders(spark, sf_dir).groupBy("order_date").agg(
        F.count_distinct("customer_id").alias("customers"),
        F.count_if(F.col("status") == "paid").alias("paid_orders"))


def sql_concat_null(spark, sf_dir):
    """NULL + 'x' is NULL."""
    return customers(spark, sf_dir).selectExpr("customer_id", "region || '-' || name AS label")


QUERIES = {f.__name__: f for f in (
    sql_isnull, sql_top_ordered, sql_convert_date, sql_dateadd, sql_datediff_day, sql_datediff_month, sql_iif,
    sql_string_plus, sql_len, sql_latest_order_window, sql_running_total, sql_revenue_having, sql_unpaid_antijoin,
    sql_integer_division, sql_cte_daily, sql_nolock, sql_count_distinct_case, sql_concat_null)}
