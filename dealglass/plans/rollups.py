"""Shared pre-aggregates.

Each rollup has one row per key, so joining several of them can never multiply
rows, and each is built by a grouped aggregate that combines map-side: a key
holding a third of the table arrives at the shuffle as one partial row per
task.  Nulls from a left join mean "no child rows".
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.functions.columns import count_where, day, sum_where
from dealglass.model import Model

STAGE_COLUMNS = ["stage_id", "stage_name", "stage_order", "probability", "is_closed", "is_won"]


def stages(m: Model) -> DataFrame:
    return m.deal_stages.select(*STAGE_COLUMNS)


def staged_deals(m: Model, how: str = "inner") -> DataFrame:
    """Deals with their stage attributes; Spark broadcasts the stage table by its size.

    ``how="left"`` keeps deals of an unknown stage, as figures per customer do.
    """
    return m.deals.join(stages(m), "stage_id", how)


def closing(deals: DataFrame, start: Column, end: Column | None = None) -> DataFrame:
    """Deals expected to close from ``start`` on (to ``end``, both included).

    Where deals are stored by ``close_month`` only those months are read.
    """
    close = F.col("expected_close_date")
    rows = deals.where(close >= start)
    rows = rows if end is None else rows.where(close <= end)
    if "close_month" in deals.columns:
        rows = rows.where(F.col("close_month") >= F.trunc(start, "MM"))
        rows = rows if end is None else rows.where(F.col("close_month") <= F.trunc(end, "MM"))
    return rows


def is_lost() -> Column:
    return F.col("is_closed") & ~F.col("is_won")


def activity_measures() -> list[Column]:
    outcome, kind = F.col("outcome"), F.col("activity_type")
    return [
        F.count(F.lit(1)).alias("total_activities"),
        F.max("activity_date").alias("last_activity_at"),
        count_where(outcome == "Negative").alias("negatives"),
        count_where(outcome == "No Response").alias("no_responses"),
        count_where(outcome == "Positive").alias("positives"),
        count_where(kind == "Demo").alias("demos"),
        count_where(kind == "Meeting").alias("meetings"),
    ]


ACTIVITY_SUMS = [
    "total_activities", "negatives", "no_responses", "positives", "demos", "meetings"]


def deal_activity(activities: DataFrame) -> DataFrame:
    """Per deal: activity count, last activity and outcome/type counts."""
    return activities.groupBy("deal_id").agg(*activity_measures())


def customer_activity(m: Model) -> DataFrame:
    """Per customer: the same measures.

    Activities that carry no customer of their own are rolled up per deal
    first, so the lookup join sees one row per deal on both sides.
    """
    if "customer_id" in m.activities.columns:
        return m.activities.groupBy("customer_id").agg(*activity_measures())
    owners = m.deals.select("deal_id", "customer_id")
    return (
        deal_activity(m.activities)
        .join(owners, "deal_id")
        .groupBy("customer_id")
        .agg(
            *[F.sum(c).alias(c) for c in ACTIVITY_SUMS],
            F.max("last_activity_at").alias("last_activity_at"),
        )
    )


def deal_measures() -> list[Column]:
    won, value, created = F.col("is_won"), F.col("deal_value"), day(F.col("created_at"))
    return [
        F.count(F.lit(1)).alias("deals"),
        count_where(won).alias("won_deals"),
        count_where(is_lost()).alias("lost_deals"),
        count_where(F.col("is_closed")).alias("closed_deals"),
        sum_where(won, value).alias("won_value"),
        F.min(created).alias("first_deal_date"),
        F.max(created).alias("latest_deal_date"),
    ]


def customer_deals(m: Model) -> DataFrame:
    """Per customer: deal counts by result, won value, first and last creation date."""
    return staged_deals(m, "left").groupBy("customer_id").agg(*deal_measures())


def join_book(rows: DataFrame, m: Model) -> DataFrame:
    """Rows with a customer, and that customer's deal and activity measures.

    Where activities name only their deal, each deal meets its one activity row
    and a single grouping by customer gives both, with one scan of the deals.
    Else the two rollups are joined one after the other, so that a filter on the
    customer reaches the scans of both.
    """
    if "customer_id" in m.activities.columns:
        return rows.join(customer_deals(m), "customer_id", "left").join(
            customer_activity(m), "customer_id", "left")
    book = (
        staged_deals(m, "left")
        .join(deal_activity(m.activities), "deal_id", "left")
        .groupBy("customer_id")
        .agg(
            *deal_measures(),
            *[F.sum(c).alias(c) for c in ACTIVITY_SUMS],
            F.max("last_activity_at").alias("last_activity_at"),
        )
    )
    return rows.join(book, "customer_id", "left")


def customer_revenue(m: Model) -> DataFrame:
    """Per customer: billed amounts by payment status and revenue type."""
    amount, overdue = F.col("amount"), F.col("payment_status") == "Overdue"
    return m.revenue_records.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("records"),
        F.sum(amount).alias("billed"),
        sum_where(overdue, amount).alias("overdue_amount"),
        count_where(overdue).alias("overdue_count"),
        sum_where(F.col("revenue_type") == "Expansion", amount).alias("expansion_revenue"),
        F.sum("mrr_contribution").alias("mrr"),
        F.sum("arr_contribution").alias("arr"),
    )


def signal_measures() -> list[Column]:
    severity, kind = F.col("severity"), F.col("signal_type")
    unresolved = ~F.col("resolved")
    return [
        F.count(F.lit(1)).alias("signals"),
        count_where(severity == "Critical").alias("critical"),
        count_where(severity == "High").alias("high"),
        count_where(unresolved).alias("open_signals"),
        count_where(unresolved & (severity == "Critical")).alias("open_critical"),
        count_where(unresolved & (severity == "High")).alias("open_high"),
        count_where(unresolved & (severity == "Medium")).alias("open_medium"),
        count_where(unresolved & (severity == "Low")).alias("open_low"),
        count_where(kind == "Contract Expiring").alias("expiring"),
        count_where(kind == "Competitor Mention").alias("competitor"),
    ]


def customer_signals(m: Model) -> DataFrame:
    """Per customer: churn signals by severity, state and type."""
    return m.churn_signals.groupBy("customer_id").agg(*signal_measures())


def open_deal_signals(m: Model) -> DataFrame:
    """Per deal: unresolved churn signals by severity."""
    severity = F.col("severity")
    return (
        m.churn_signals.where(~F.col("resolved"))
        .groupBy("deal_id")
        .agg(
            F.count(F.lit(1)).alias("open_signals"),
            count_where(severity == "Critical").alias("open_critical"),
            count_where(severity == "High").alias("open_high"),
        )
    )


def stage_deals(deals: DataFrame, as_of: dt.date) -> DataFrame:
    """Per stage: deal measures, aggregated before the stage attributes are joined."""
    source = F.col("deal_source")
    return deals.groupBy("stage_id").agg(
        F.count(F.lit(1)).alias("deals"),
        F.sum("deal_value").alias("value"),
        F.sum("days_in_stage").alias("stage_days"),
        F.count("days_in_stage").alias("stage_days_known"),
        count_where(F.col("days_in_stage") > 30).alias("stagnant"),
        count_where(F.col("expected_close_date") < F.lit(as_of)).alias("overdue"),
        *[
            count_where(source == name).alias(f"{name.lower()}_deals")
            for name in ("Inbound", "Outbound", "Referral", "Partner", "Renewal")
        ],
    )


def rep_deals(m: Model, as_of: dt.date) -> DataFrame:
    """Per rep: deal counts, won and active value, days to close."""
    won, active, value = F.col("is_won"), F.col("is_active"), F.col("deal_value")
    to_close = F.when(won, F.datediff("actual_close_date", day(F.col("created_at"))))
    return (
        staged_deals(m)
        .groupBy("assigned_rep")
        .agg(
            F.count(F.lit(1)).alias("deals"),
            count_where(won).alias("won"),
            count_where(is_lost()).alias("lost"),
            count_where(F.col("is_closed")).alias("closed"),
            count_where(active).alias("active"),
            sum_where(won, value).alias("won_value"),
            sum_where(active, value).alias("active_value"),
            F.sum(to_close).alias("close_days"),
            F.count(to_close).alias("close_days_known"),
            count_where(active & (F.col("expected_close_date") < F.lit(as_of))).alias("overdue"),
        )
    )


def customer_products(m: Model) -> DataFrame:
    """Per customer and product: value of the lines on won deals.

    The lines are read once; Spark splits the part of a deal that dominates them.
    """
    won = staged_deals(m).where("is_won").select("deal_id", "customer_id")
    lines = m.deal_products.select("deal_id", "product_id", "total_value")
    return (
        lines.join(won, "deal_id")
        .groupBy("customer_id", "product_id")
        .agg(F.sum("total_value").alias("owned_value"))
    )
