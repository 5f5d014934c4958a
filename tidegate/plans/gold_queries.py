"""Registered gold tables and the report questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidegate.operators.gate import safe_ratio
from tidegate.plans import gaming, marketing, sales
from tidegate.plans.present import plain
from tidegate.session import stage


def gold_monthly_revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(sales.monthly_revenue_by_region(spark, sf_dir))


def gold_customer_lifetime_value(spark, sf_dir):
    return plain(sales.customer_lifetime_value(spark, sf_dir))


def gold_top_products(spark, sf_dir):
    return plain(sales.top_products(spark, sf_dir))


def _campaign_performance(spark, sf_dir):
    # One source only: this flags the leads and nothing else.
    clean = _clean_leads(spark, sf_dir)
    return marketing.campaign_performance(marketing.campaigns_clean(spark, sf_dir), clean)


def _clean_leads(spark, sf_dir):
    from tidegate.operators.quarantine import accepted

    return accepted(marketing.leads_flagged(spark, sf_dir))


def _client_funnel(spark, sf_dir):
    return marketing.client_funnel(marketing.campaigns_clean(spark, sf_dir), _clean_leads(spark, sf_dir))


def _ops_health(spark, sf_dir):
    from tidegate.operators.quarantine import accepted

    return marketing.ops_health(accepted(marketing.ops_events_flagged(spark, sf_dir)))


def gold_campaign_performance(spark, sf_dir):
    return plain(_campaign_performance(spark, sf_dir))


def gold_client_funnel(spark, sf_dir):
    return plain(_client_funnel(spark, sf_dir))


def gold_ops_health(spark, sf_dir):
    return plain(_ops_health(spark, sf_dir))


def gold_player_daily(spark, sf_dir):
    return plain(gaming.player_daily(spark, sf_dir).drop("longest_session", "wager_count"))


def rg_player_flags(spark, sf_dir):
    return plain(gaming.player_flags(spark, sf_dir))


def gold_retail_sales_daily(spark, sf_dir):
    return plain(gaming.retail_sales_daily(
        gaming.clean(spark, sf_dir, "orders"), gaming.clean(spark, sf_dir, "licensees")))


# -- report questions --------------------------------------------------------------

def bi_top_customers(spark, sf_dir):
    """Ten customers with the highest lifetime value."""
    return plain(sales.customer_metrics(spark, sf_dir).select("customer_key", "customer_name", "total_revenue")
                 .orderBy(F.desc("total_revenue"), "customer_key").limit(10))


def bi_top_products(spark, sf_dir):
    """Products ranked ten or better by revenue."""
    return plain(sales.top_products(spark, sf_dir).filter("revenue_rank <= 10")
                 .select("product_key", "product_name", "total_revenue", "revenue_rank"))


def bi_segment_counts(spark, sf_dir):
    """Customers per value segment."""
    return plain(sales.customer_lifetime_value(spark, sf_dir).groupBy("value_segment")
                 .agg(F.count("*").alias("customers")))


def bi_revenue_by_region_year(spark, sf_dir, year: int = 1997):
    """Revenue of each region in one year."""
    gold = sales.monthly_revenue_by_region(spark, sf_dir, f"{year}-01-01 00:00:00", f"{year + 1}-01-01 00:00:00")
    return plain(gold.groupBy("region_name")
                 .agg(F.sum("revenue").alias("revenue")))


def bi_best_cost_per_lead(spark, sf_dir):
    """The campaign with the lowest cost per lead, among campaigns that have leads."""
    gold = _campaign_performance(spark, sf_dir).filter("cost_per_lead IS NOT NULL")
    return plain(gold.select("campaign_id", "cost_per_lead").orderBy("cost_per_lead", "campaign_id").limit(1))


def bi_conversion_by_channel(spark, sf_dir):
    """Conversion per channel from the counts, not as a mean of rates."""
    gold = _campaign_performance(spark, sf_dir).groupBy("channel").agg(
        F.sum("won_count").alias("won"), F.sum("lead_count").alias("leads"))
    return plain(gold.withColumn("conversion_rate", safe_ratio(F.col("won"), F.col("leads"), F.lit(0.0))))


def bi_funnel_last3m(spark, sf_dir):
    """Stage counts per month over the last three months that have leads."""
    gold = stage(_client_funnel(spark, sf_dir), "funnel")  # read twice
    last = F.max("month_date")
    months = gold.agg(F.array(last, F.add_months(last, -1), F.add_months(last, -2)).alias("months"))
    recent = gold.join(months.select(F.explode("months").alias("month_date")), "month_date")
    counts = ("new_count", "qualified_count", "won_count", "lost_count", "total_leads")
    return plain(recent.groupBy("month_date").agg(*[F.sum(c).alias(c) for c in counts]))


def bi_ops_success_month(spark, sf_dir):
    """Success rate of the daily plan by month."""
    from tidegate.operators.quarantine import accepted

    ops = accepted(marketing.ops_events_flagged(spark, sf_dir)).filter("event_type = 'daily_plan_run'")
    month = F.trunc(F.col("event_ts").cast("date"), "month").alias("month_date")
    counted = ops.groupBy(month).agg(F.count("*").alias("runs"), F.count_if("success").alias("successes"))
    return plain(counted.withColumn("success_rate", safe_ratio(F.col("successes"), F.col("runs"), F.lit(0.0))))


def bi_busiest_day(spark, sf_dir):
    """The day with the most messages."""
    return plain(_ops_health(spark, sf_dir).select("event_date", "telegram_messages")
                 .orderBy(F.desc("telegram_messages"), "event_date").limit(1))


QUERIES = {f.__name__: f for f in (
    gold_monthly_revenue_by_region, gold_customer_lifetime_value, gold_top_products, gold_campaign_performance,
    gold_client_funnel, gold_ops_health, gold_player_daily, rg_player_flags, gold_retail_sales_daily,
    bi_top_customers, bi_top_products, bi_segment_counts, bi_revenue_by_region_year, bi_best_cost_per_lead,
    bi_conversion_by_channel, bi_funnel_last3m, bi_ops_success_month, bi_busiest_day)}
