"""Inputs of the pipelines, derived from the TPC-H-like and event tables.

Every derivation is a narrow projection (plus the joins the grain needs), so the work grows
with the tables. Faults are planted by key arithmetic so that a SQL oracle can plant the
same ones; `operators.inject` has the hashed, seeded form for measuring recall.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidegate.sources.tables import table

LATE_COPY = 1_000_000_000_000  # arrival offset of replayed rows


def money(column: Column | str) -> Column:
    """Exact two-digit money from a double that holds two digits."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def _every(key: str, step: int) -> Column:
    return F.col(key) % step == 0


# -- marketing and operations ------------------------------------------------------

def campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaign versions; every tenth campaign also has an older, cheaper version."""
    c = table(spark, sf_dir, "customer")
    versions = F.when(_every("c_custkey", 10), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))
    return c.select("*", F.explode(versions).alias("version")).select(
        F.col("c_custkey").alias("campaign_id"),
        F.when(_every("c_custkey", 89), None).otherwise(F.col("c_nationkey").cast("bigint")).alias("client_id"),
        F.col("c_mktsegment").alias("channel"),
        F.when(F.col("version") == 1, money(F.lit(1))).otherwise(money("c_acctbal")).alias("budget"),
        F.when(F.col("c_custkey") % 3 == 0, "paused").otherwise("active").alias("status"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(version)").alias("_ingest_ts"),
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("client_id"),
        F.concat(F.lit("  "), "n_name", F.lit(" ")).alias("client_name"),
        F.when(F.col("n_regionkey") < 2, "gold").otherwise("standard").alias("tier"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("_ingest_ts"),
    )


def leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    arrivals = F.when(_every("event_id", 40), F.array(F.lit(0), F.lit(LATE_COPY))).otherwise(
        F.array(F.lit(0).cast("bigint")))
    faulty = (F.when(_every("event_id", 7), "stale").when(_every("event_id", 11), None).otherwise("new"))
    stage = (
        F.when(F.col("event_type") == "signup", " new ").when(F.col("event_type") == "click", "qualified")
        .when(F.col("event_type") == "purchase", "won ").when(F.col("event_type") == "view", "lost")
        .otherwise(faulty)
    )
    return e.select("*", F.explode(arrivals).alias("later")).select(
        F.col("event_id").alias("lead_id"),
        F.when(_every("event_id", 50), None).otherwise(F.col("user_id")).alias("campaign_id"),
        stage.alias("stage"),
        F.col("ts").alias("created_ts"),
        F.lit(" example.com ").alias("email_domain"),
        (F.col("event_id") + F.col("later")).alias("_row_id"),
    )


def web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    duration = (
        F.when(_every("event_id", 47), -1).when(_every("event_id", 53), None)
        .otherwise(F.floor("value").cast("bigint"))
    )
    return e.select(
        "event_id",
        F.when(_every("event_id", 59), None).otherwise(F.col("user_id")).alias("campaign_id"),
        duration.alias("session_duration_seconds"),
        F.get_json_object("props", "$.k").cast("bigint").alias("page_views"),
        F.col("ts").alias("event_ts"),
        F.col("event_id").alias("_row_id"),
    )


def ops_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    arrivals = F.when(_every("event_id", 67), F.array(F.lit(0), F.lit(LATE_COPY))).otherwise(
        F.array(F.lit(0).cast("bigint")))
    return e.select("*", F.explode(arrivals).alias("later")).select(
        F.col("event_id").alias("ops_event_id"),
        F.when(F.col("event_id") % 2 == 0, "telegram_message").otherwise("daily_plan_run").alias("event_type"),
        (F.col("event_type") != "error").alias("success"),
        F.when(_every("event_id", 61), None).otherwise(money("value")).alias("latency_seconds"),
        F.col("ts").alias("event_ts"),
        (F.col("event_id") + F.col("later")).alias("_row_id"),
    )


# -- gaming and retail -------------------------------------------------------------

def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.when(_every("c_custkey", 97), None).otherwise(F.col("c_custkey")).alias("player_id"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@"),
                 F.lower("c_mktsegment"), F.lit(".example.com")).alias("email"),
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("c_custkey") % 15000).cast("int"))
        .cast("string").alias("date_of_birth"),
        F.col("n_name").alias("region"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 700).cast("int"))
        .cast("string").alias("signup_date"),
        F.when(_every("c_custkey", 11), None).otherwise(_every("c_custkey", 5)).alias("self_excluded"),
    )


def _events_of(spark: SparkSession, sf_dir: str, *types: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts").filter(
        F.col("event_type").isin(*types))


def wagers(spark: SparkSession, sf_dir: str) -> DataFrame:
    stake = F.when(_every("event_id", 71), money(F.lit(0))).otherwise(money("value"))
    return _events_of(spark, sf_dir, "purchase").select(
        F.col("event_id").alias("wager_id"),
        F.when(_every("event_id", 83), None).otherwise(F.col("user_id")).alias("player_id"),
        stake.alias("stake"),
        (stake * (F.col("event_id") % 3).cast("decimal(2,0)")).cast("decimal(18,2)").alias("payout"),
        F.col("ts").alias("wager_ts"),
    )


def deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.when(_every("event_id", 89), money(F.lit(-1))).otherwise(money("value"))
    return _events_of(spark, sf_dir, "signup", "click").select(
        F.col("event_id").alias("deposit_id"), F.col("user_id").alias("player_id"),
        amount.alias("amount"), F.col("ts").alias("deposit_ts"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = F.when(_every("event_id", 73), -5).otherwise(F.floor("value").cast("bigint"))
    return _events_of(spark, sf_dir, "view", "error").select(
        F.col("event_id").alias("session_id"), F.col("user_id").alias("player_id"),
        F.col("ts").alias("start_ts"), minutes.alias("duration_minutes"),
    )


def licensees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    domain = (F.when(_every("c_custkey", 83), "tobacco").when(F.col("c_custkey") % 2 == 0, "liquor")
              .otherwise("cannabis"))
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        F.col("c_custkey").alias("licensee_id"), F.col("c_name").alias("licensee_name"),
        domain.alias("domain"), F.col("n_name").alias("region"),
    )


def retail_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.when(_every("o_custkey", 73), None).otherwise(F.col("o_custkey")).alias("licensee_id"),
        F.when(F.col("l_returnflag") == "A", "cannabis").otherwise("liquor").alias("domain"),
        F.col("o_orderpriority").alias("product_category"),
        F.col("o_orderdate").cast("date").cast("string").alias("order_date"),
        F.when(_every("l_partkey", 67), 0).otherwise(F.floor("l_quantity").cast("bigint")).alias("quantity"),
        F.when(_every("l_suppkey", 79), money(F.lit(-1))).otherwise(money("l_extendedprice")).alias("amount"),
    )


# -- ledger extracts (text only) ---------------------------------------------------

FIRST_DAY = "1999-12-31 00:00:00"
SECOND_DAY = "2002-01-01 00:00:00"


def _copies(*conditions: Column) -> Column:
    """Copy numbers of a row: 0 always, n when the n-th condition holds."""
    return F.explode(F.array_compact(F.array(
        F.lit(0), *[F.when(c, F.lit(i)) for i, c in enumerate(conditions, start=1)])))


def _seconds(key: str) -> Column:
    return F.expr(f"make_dt_interval(0, 0, 0, {key} % 86400)")


def final_status() -> Column:
    """The status an order ends in."""
    return (
        F.when(F.col("o_orderstatus") == "F", "shipped").when(F.col("o_orderstatus") == "P", "paid")
        .when(_every("o_orderkey", 10), "cancelled").otherwise("placed")
    )


def order_extract(spark: SparkSession, sf_dir: str, through: str) -> DataFrame:
    """Newest version of each order visible at `through`, as text.

    Planted: unknown status, unreadable date, keyless copies, conflicting copies, exact copies.
    """
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    cut = F.expr(f"timestamp_ntz'{through}'")
    placed_at = F.col("o_orderdate") + _seconds("o_orderkey")
    closed_at = placed_at + F.expr("interval 2 days")
    versions = (
        o.withColumn("placed_at", placed_at).filter(F.col("placed_at") <= cut)
        .withColumn("closed_at", closed_at)
        .withColumn("closed", (F.col("o_orderstatus") != "O") & (F.col("closed_at") <= cut))
        .select("*", _copies(_every("o_orderkey", 419), _every("o_orderkey", 431),
                             _every("o_orderkey", 433)).alias("copy"))
    )
    status = (F.when(_every("o_orderkey", 401), "refunded").when(F.col("closed"), final_status())
              .otherwise("placed"))
    return versions.select(
        F.when(F.col("copy") == 1, "").otherwise(F.col("o_orderkey").cast("string")).alias("order_id"),
        (F.col("o_custkey") + F.when(F.col("copy") == 2, 1).otherwise(0)).cast("string").alias("customer_id"),
        status.alias("status"),
        F.when(_every("o_orderkey", 409), "N/A")
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("order_date"),
        F.when(F.col("closed"), F.col("closed_at")).otherwise(F.col("placed_at"))
        .cast("string").alias("updated_at"),
        F.when(F.col("closed") & _every("o_orderkey", 97), "true").otherwise("false").alias("is_deleted"),
    )


def line_extract(spark: SparkSession, sf_dir: str, through: str) -> DataFrame:
    """Order lines shipped by `through`, as text; planted: unreadable prices and tombstones."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")
    numbered = (
        li.withColumn("line_no", F.col("l_partkey") * 10 + F.col("l_linenumber"))
        .withColumn("changed_at", F.col("l_shipdate") + _seconds("l_orderkey"))
        .filter(F.col("changed_at") <= F.expr(f"timestamp_ntz'{through}'"))
    )
    return numbered.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("line_no").cast("string").alias("line_no"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.floor("l_quantity").cast("bigint").cast("string").alias("quantity"),
        F.when(_every("line_no", 503), "N/A").otherwise(money("l_extendedprice").cast("string"))
        .alias("unit_price"),
        F.col("changed_at").cast("string").alias("updated_at"),
        F.when(_every("line_no", 211), "true").alias("is_deleted"),
    )


def payment_extract(spark: SparkSession, sf_dir: str, through: str) -> DataFrame:
    """Settlements of paid and shipped orders by `through`, as text.

    Planted: missing payments, double charges, short payments, payments of unknown orders,
    unreadable amounts, and payments that reach the extract only on the second day.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice")
    # Whole cents in 64 bits add up much faster than wide decimals and give the same sum.
    cents = (F.col("l_extendedprice").cast("decimal(9,2)") * 100).cast("bigint")
    totals = li.groupBy("l_orderkey").agg(
        F.sum(F.floor("l_quantity").cast("decimal(9,0)").cast("bigint") * cents).alias("_cents")).select(
        "l_orderkey", (F.col("_cents").cast("decimal(20,0)") * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(29,2)").alias("total"))
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    settled = (
        o.filter("o_orderstatus IN ('F', 'P')")
        .withColumn("settled_at", F.col("o_orderdate") + _seconds("o_orderkey") + F.expr("interval 3 days"))
        .filter(F.col("settled_at") <= F.expr(f"timestamp_ntz'{through}'"))
    )
    if through == FIRST_DAY:
        settled = settled.filter("NOT o_totalprice BETWEEN 20000 AND 30000")
    rows = settled.join(totals, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "*", _copies(_every("o_orderkey", 41), _every("o_orderkey", 59)).alias("copy")
    ).filter("NOT (copy = 0 AND o_totalprice < 20000)")
    owed = F.when(_every("o_orderkey", 43), F.col("total") - 1).otherwise(F.col("total"))
    return rows.select(
        (F.col("o_orderkey") + F.col("copy") * F.lit(LATE_COPY)).cast("string").alias("payment_id"),
        F.when(F.col("copy") == 2, -F.col("o_orderkey") - 1).otherwise(F.col("o_orderkey"))
        .cast("string").alias("order_id"),
        F.when(_every("o_orderkey", 509), "N/A").otherwise(owed.cast("decimal(18,2)").cast("string"))
        .alias("amount"),
        (F.col("o_orderdate") + F.expr("interval 3 days")).cast("date").cast("string").alias("settled_date"),
        F.col("settled_at").cast("string").alias("updated_at"),
        F.when(_every("o_orderkey", 307), "true").otherwise("false").alias("is_deleted"),
    )
