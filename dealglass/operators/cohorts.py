"""Acquisition cohorts and the six-family cohort table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealglass.functions import labels
from dealglass.functions.columns import count_where, day, mean, month, percent, zero
from dealglass.model import Model
from dealglass.plans import rollups
from dealglass.plans.quantiles import ntile


def cohort_analysis(m: Model) -> DataFrame:
    """Per month of first deal: size, revenue, win rate, revenue share, grade.

    Customers without a deal form the cohort with a null month.
    """
    deals = rollups.customer_deals(m).select(
        "customer_id", "first_deal_date", "won_value", "won_deals", "lost_deals")
    customers = m.customers.select("customer_id").join(deals, "customer_id", "left")
    won_value = F.coalesce("won_value", F.lit(0).cast("decimal(15,2)"))
    cohorts = customers.groupBy(month(F.col("first_deal_date")).alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("cohort_size"),
        F.sum(won_value).alias("cohort_revenue"),
        F.sum(zero(F.col("won_deals"))).alias("total_won_deals"),
        F.sum(zero(F.col("lost_deals"))).alias("total_lost_deals"),
        count_where(won_value == 0).alias("zero_revenue_customers"),
    )
    won, lost = F.col("total_won_deals"), F.col("total_lost_deals")
    revenue, rate = F.col("cohort_revenue"), F.col("cohort_win_rate")
    all_cohorts = F.sum(revenue).over(Window.partitionBy())
    grade = (
        F.when(rate >= 70, labels.COHORT_EXCELLENT)
        .when(rate >= 50, labels.COHORT_GOOD)
        .when(rate >= 30, labels.COHORT_AVERAGE)
        .otherwise(labels.COHORT_POOR)
    )
    return (
        cohorts.withColumn("cohort_win_rate", percent(won, won + lost))
        .select(
            "cohort_month",
            "cohort_size",
            "cohort_revenue",
            mean(revenue, F.col("cohort_size")).alias("avg_revenue_per_customer"),
            "total_won_deals",
            "total_lost_deals",
            "cohort_win_rate",
            "zero_revenue_customers",
            percent(revenue, all_cohorts).alias("revenue_contribution_percent"),
            grade.alias("cohort_performance"),
        )
        .orderBy(F.asc_nulls_last("cohort_month"))
    )


BANDS = ["Low", "Mid", "High"]  # thirds of the customers by annual revenue


def revenue_bands(m: Model) -> DataFrame:
    """Per customer the third by annual revenue; none is least, equal revenues go by id."""
    order = [F.asc_nulls_first("annual_revenue"), F.asc("customer_id")]
    tiled = ntile(m.customers.select("customer_id", "annual_revenue"), 3, order, "tile")
    return tiled.select(
        "customer_id", F.element_at(F.lit(BANDS), F.col("tile")).alias("band"))


def _banded(m: Model, customers: DataFrame, bands: tuple[int, int] | None) -> DataFrame:
    if bands is None:
        return customers.join(revenue_bands(m), "customer_id")
    low, high = bands
    revenue = F.col("annual_revenue")
    return customers.withColumn("band", F.when(revenue >= high, "High").when(
        revenue >= low, "Mid").otherwise("Low"))


def cohort_table(m: Model, bands: tuple[int, int] | None = None) -> DataFrame:
    """Six cohort families in one pass over customers.

    Families: acquisition month, industry, tier, source of the first deal,
    annual-revenue band (thirds of the customers, or by limits) and geography
    (``region`` when the customer table has it, else country).  A customer counts
    as expanded with any Expansion revenue.
    """
    place = "region" if "region" in m.customers.columns else "country"
    deals = (
        rollups.staged_deals(m, "left")
        .groupBy("customer_id")
        .agg(
            F.sum(F.when(F.col("is_won"), F.col("deal_value"))).alias("won_value"),
            F.min(F.struct(day(F.col("created_at")).alias("day"), "deal_id", "deal_source")).alias(
                "first"),
        )
    )
    revenue = rollups.customer_revenue(m).select("customer_id", "expansion_revenue")
    customers = (
        m.customers.select(
            "customer_id", "industry", "customer_tier", "annual_revenue", "status",
            F.col(place).alias("place"))
        .transform(lambda rows: _banded(m, rows, bands))
        .join(deals, "customer_id", "left")
        .join(revenue, "customer_id", "left")
        .select(
            F.date_format(month(F.col("first.day")), "yyyy-MM").alias("Acquisition Month"),
            F.col("industry").alias("Industry"),
            F.col("customer_tier").alias("Customer Tier"),
            F.col("first.deal_source").alias("Deal Source"),
            F.col("band").alias("Revenue Band"),
            F.col("place").alias("Geography"),
            F.coalesce("won_value", F.lit(0).cast("decimal(15,2)")).alias("won_value"),
            (F.col("status") == "Churned").alias("churned"),
            (F.col("expansion_revenue") > 0).alias("expanded"),
        )
    )
    # The cohort families.
    families = ["Acquisition Month", "Industry", "Customer Tier", "Deal Source",
                "Revenue Band", "Geography"]
    n = F.col("total_customers")
    return (
        customers.groupingSets([[F.col(f)] for f in families], *[F.col(f) for f in families])
        .agg(
            F.grouping_id().alias("family_id"),
            F.count(F.lit(1)).alias("total_customers"),
            F.sum("won_value").alias("total_revenue"),
            count_where(F.col("churned")).alias("churned"),
            count_where(F.col("expanded")).alias("expanded"),
        )
        .select(
            _family_name(families).alias("cohort_type"),
            F.coalesce(*[F.col(f) for f in families]).alias("cohort_member"),
            "total_customers",
            "total_revenue",
            mean(F.col("total_revenue"), n).alias("avg_deal_value"),
            percent(F.col("churned"), n).alias("churn_rate"),
            percent(F.col("expanded"), n).alias("expansion_rate"),
        )
    )


def _family_name(families: list[str]):
    """The family a grouping-set row belongs to: the one bit that is not set."""
    full = 2 ** len(families) - 1
    name = F.lit(None).cast("string")
    for i, family in enumerate(families):
        bit = 2 ** (len(families) - 1 - i)
        name = F.when(F.col("family_id") == full - bit, family).otherwise(name)
    return name
