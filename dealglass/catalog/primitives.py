"""The relational building blocks, each over whole domain tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealglass.functions.columns import (
    count_where, day, days_until, dec, half_up, mean, month, on, percent, sum_where, zero)
from dealglass.model import Model
from dealglass.operators import pipeline, revenue, upsell
from dealglass.plans import rollups
from dealglass.plans.ordering import ordered
from dealglass.sources import ingest


def load_stages(m: Model, as_of: dt.date) -> DataFrame:
    """The literal stage rows with the number of deals loaded for each."""
    loaded = m.deals.groupBy("stage_id").agg(F.count(F.lit(1)).alias("deals"))
    return m.deal_stages.join(loaded, "stage_id", "left").withColumn(
        "deals", zero(F.col("deals")))


def resolve_keys(m: Model, as_of: dt.date) -> DataFrame:
    """Incoming rows that name a product: matched, ambiguous and unmatched ones.

    Products not billed annually are known by their full name, the others by
    the short name several share; services are referred to by a name nobody has.
    """
    short = F.regexp_replace("product_name", " #.*$", "")
    known_as = F.when(F.col("billing_type") == "Annual", short).otherwise(F.col("product_name"))
    catalogue = m.products.select("product_id", known_as.alias("known_as"))
    asked = F.when(F.col("is_active"), known_as).otherwise(
        F.concat(F.lit("unlisted "), F.col("product_name")))
    incoming = m.products.select(F.col("product_id").alias("row_id"), asked.alias("name"))
    return ingest.resolve_key(
        incoming, "name", catalogue, "known_as", "product_id",
        spread=F.col("row_id"), out="product_id")


def apply_defaults(m: Model, as_of: dt.date) -> DataFrame:
    """Revenue rows without currency, and without status on large amounts, filled in."""
    status = F.when(F.col("amount") <= 400_000, F.col("payment_status"))
    rows = m.revenue_records.select("revenue_id", "amount", status.alias("payment_status"))
    return ingest.apply_defaults(
        rows, "revenue_records", dt.datetime(as_of.year, as_of.month, as_of.day))


def line_total(m: Model, as_of: dt.date) -> DataFrame:
    return m.deal_products.select(
        "deal_product_id", "quantity", "unit_price", "discount_percent", "total_value")


def filter_active(m: Model, as_of: dt.date) -> DataFrame:
    return m.deals.where(F.col("is_active") & (F.col("deal_value") > 100_000)).select(
        "deal_id", "deal_value", "assigned_rep")


def filter_close_window(m: Model, as_of: dt.date) -> DataFrame:
    close = F.col("expected_close_date")
    return m.deals.where(
        F.col("is_active") & close.between(on(as_of), F.add_months(on(as_of), 3))
    ).select("deal_id", "expected_close_date", "deal_value")


def filter_risk_levels(m: Model, as_of: dt.date) -> DataFrame:
    risky = pipeline.deal_risk_scores(m, as_of).where(
        F.col("risk_level").isin("Critical", "High"))
    return ordered(risky, "-risk_score", "deal_id").select("deal_id", "risk_level", "risk_score")


def join_inner(m: Model, as_of: dt.date) -> DataFrame:
    """Won deals with customer and stage names."""
    won = rollups.staged_deals(m).where("is_won")
    names = m.customers.select("customer_id", "company_name")
    return won.join(names, "customer_id").select(
        "deal_id", "company_name", "stage_name", "deal_value")


def join_left(m: Model, as_of: dt.date) -> DataFrame:
    """All customers with their deal count; null where a customer has no signal."""
    deals = rollups.customer_deals(m).select("customer_id", "deals")
    signals = rollups.customer_signals(m).select("customer_id", "signals")
    return (
        m.customers.select("customer_id")
        .join(deals, "customer_id", "left")
        .join(signals, "customer_id", "left")
    )


def join_left_residual(m: Model, as_of: dt.date) -> DataFrame:
    """All stages with their active deals; the condition filters the right side only."""
    active = m.deals.where("is_active").groupBy("stage_id").agg(
        F.count(F.lit(1)).alias("active_deals"), F.sum("deal_value").alias("active_value"))
    return rollups.stages(m).select("stage_id", "stage_name").join(active, "stage_id", "left")


def join_cross(m: Model, as_of: dt.date) -> DataFrame:
    """Customer × product pairs not owned, counted without forming the pairs."""
    return upsell.upsell_opportunities(m).select(
        "company_name", "missing_product_count", "potential_expansion_value")


def join_anti(m: Model, as_of: dt.date) -> DataFrame:
    """Products that no customer owns through a won deal."""
    sold = rollups.customer_products(m).select("product_id").distinct()
    return m.products.join(sold, "product_id", "left_anti").select("product_id", "unit_price")


def join_semi(m: Model, as_of: dt.date) -> DataFrame:
    """Customers with at least one won deal."""
    winners = rollups.staged_deals(m).where("is_won").select("customer_id").distinct()
    return m.customers.join(winners, "customer_id", "left_semi").select(
        "customer_id", "company_name")


def agg_basic(m: Model, as_of: dt.date) -> DataFrame:
    value = F.col("deal_value")
    return m.deals.groupBy("deal_source").agg(
        F.count(F.lit(1)).alias("deals"),
        F.count("actual_close_date").alias("closed_deals"),
        F.sum(value).alias("total_value"),
        mean(F.sum(value), F.count(value)).alias("avg_value"),
        F.min("expected_close_date").alias("first_close"),
        F.max("expected_close_date").alias("last_close"),
        F.max("created_at").alias("last_created_at"),
    )


def agg_conditional(m: Model, as_of: dt.date) -> DataFrame:
    paid, amount = F.col("payment_status"), F.col("amount")
    return m.revenue_records.groupBy("revenue_type").agg(
        count_where(paid == "Overdue").alias("overdue_records"),
        sum_where(paid == "Paid", amount).alias("paid_amount"),
        sum_where(paid == "Failed", amount).alias("failed_amount"),
        mean(F.sum(F.when(paid == "Pending", amount)), count_where(paid == "Pending")).alias(
            "avg_pending"),
    )


def agg_count_distinct(m: Model, as_of: dt.date) -> DataFrame:
    return m.deals.groupBy(month(F.col("created_at")).alias("created_month")).agg(
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("assigned_rep").alias("reps"),
        F.count(F.lit(1)).alias("deals"),
    )


def agg_weighted(m: Model, as_of: dt.date) -> DataFrame:
    weighted = F.sum(F.col("deal_value") * F.col("probability"))
    return rollups.staged_deals(m).where("is_active").groupBy("deal_source").agg(
        half_up(weighted * dec("0.01")).alias("weighted_value"))


def agg_string_distinct(m: Model, as_of: dt.date) -> DataFrame:
    return upsell.owned_categories(m)


def agg_ratio(m: Model, as_of: dt.date) -> DataFrame:
    won, closed = count_where(F.col("is_won")), count_where(F.col("is_closed"))
    return rollups.staged_deals(m).groupBy("customer_id").agg(
        won.alias("won"), closed.alias("closed"), percent(won, closed).alias("win_rate"))


def window_lag_global(m: Model, as_of: dt.date) -> DataFrame:
    return revenue.with_month_over_month(
        revenue.monthly_revenue_totals(m).select("revenue_month", "total_revenue")
    ).select("revenue_month", "mom_change")


def window_lag_partition(m: Model, as_of: dt.date) -> DataFrame:
    return revenue.revenue_by_month(m).select(
        "revenue_month", "revenue_type", "mom_revenue_change")


def window_running_sum(m: Model, as_of: dt.date) -> DataFrame:
    return revenue.mrr_trend(m).select("revenue_month", "total_mrr", "cumulative_mrr")


def window_share(m: Model, as_of: dt.date) -> DataFrame:
    """Share of each deal source in total deal value, over five grouped rows."""
    total = F.col("total_value")
    grouped = m.deals.groupBy("deal_source").agg(F.sum("deal_value").alias("total_value"))
    return grouped.withColumn(
        "share_percent", percent(total, F.sum(total).over(Window.partitionBy())))


def window_rank(m: Model, as_of: dt.date) -> DataFrame:
    """Rank of each month by number of deals created; months may tie."""
    monthly = m.deals.groupBy(month(F.col("created_at")).alias("created_month")).agg(
        F.count(F.lit(1)).alias("deals"))
    return monthly.withColumn("deal_rank", F.rank().over(Window.orderBy(F.desc("deals"))))


def sort_nulls(m: Model, as_of: dt.date) -> DataFrame:
    """Deals by closing date, open ones last, larger first within a day."""
    rows = m.deals.select("deal_id", "actual_close_date", "deal_value")
    return ordered(rows, "actual_close_date", "-deal_value", "deal_id")


def scalar_nulls(m: Model, as_of: dt.date) -> DataFrame:
    return m.deals.select(
        "deal_id",
        F.coalesce("actual_close_date", "expected_close_date").alias("close_date"),
        F.nullif("days_in_stage", F.lit(0)).alias("days_or_null"),
    )


def scalar_round(m: Model, as_of: dt.date) -> DataFrame:
    value = F.col("deal_value")
    return m.deals.select(
        "deal_id",
        half_up(value * dec("0.075"), 2).alias("fee"),
        half_up(value, 0).alias("whole"),
        half_up(-value * dec("0.5"), 0).alias("negative_half"),
    )


def scalar_dates(m: Model, as_of: dt.date) -> DataFrame:
    close = F.col("expected_close_date")
    return m.deals.select(
        "deal_id",
        month(F.col("created_at")).alias("created_month"),
        days_until(as_of, close).alias("days_overdue"),
        F.date_sub(close, 7).alias("week_before"),
        F.add_months(day(F.col("created_at")), 1).alias("month_later"),
    )


def scalar_casts(m: Model, as_of: dt.date) -> DataFrame:
    return m.deals.select(
        "deal_id",
        F.col("deal_id").cast("string").alias("id_text"),
        day(F.col("created_at")).alias("created_on"),
        half_up(F.col("deal_value"), 0).cast("bigint").alias("whole_value"),
        F.col("deal_name").try_cast("int").alias("not_a_number"),
    )


def scalar_strings(m: Model, as_of: dt.date) -> DataFrame:
    return m.customers.select(
        "customer_id",
        F.concat(F.col("company_name"), F.lit(" - "), F.col("industry")).alias("label"),
        F.regexp_replace("company_name", "^Customer#0*", "C").alias("short_name"),
        F.regexp_replace(F.lit("customers"), "s$", "").alias("singular"),
    )


def stable_ids(m: Model, as_of: dt.date) -> DataFrame:
    key = ingest.stable_id(F.col("deal_name"), F.col("customer_id"), F.col("created_at"))
    return m.deals.select("deal_id", key.alias("stable_id"))
