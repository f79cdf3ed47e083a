"""Pipeline state, deal risk, deal health, funnel and win/loss."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealglass.functions import labels
from dealglass.functions.columns import (
    count_where, day, days_until, dec, half_up, mean, percent, zero)
from dealglass.model import Model
from dealglass.plans import rollups

SOURCES = ["inbound", "outbound", "referral", "partner", "renewal"]


def _active_stage_measures(m: Model, as_of: dt.date) -> DataFrame:
    active = rollups.stage_deals(m.deals.where("is_active"), as_of)
    return rollups.stages(m).join(active, "stage_id", "left")


def _weighted(value: Column) -> Column:
    return half_up(value * F.col("probability") * dec("0.01"))


def pipeline_summary(m: Model, as_of: dt.date) -> DataFrame:
    """Per stage (empty stages kept): active deals, value, weighted value, stagnation."""
    return (
        _active_stage_measures(m, as_of)
        .select(
            "stage_name",
            "stage_order",
            "probability",
            zero(F.col("deals")).alias("total_deals"),
            F.col("value").alias("total_pipeline_value"),
            _weighted(F.col("value")).alias("weighted_pipeline_value"),
            mean(F.col("value"), F.col("deals")).alias("avg_deal_value"),
            mean(F.col("stage_days"), F.col("stage_days_known")).alias("avg_days_in_stage"),
            zero(F.col("stagnant")).alias("stagnant_deals"),
            zero(F.col("overdue")).alias("overdue_deals"),
        )
        .orderBy("stage_order")
    )


def pipeline_health(m: Model, as_of: dt.date) -> DataFrame:
    """Pipeline summary plus active deals per deal source."""
    return health_of_stages(_active_stage_measures(m, as_of))


def health_of_stages(measures: DataFrame) -> DataFrame:
    """Pipeline health from the measures of each stage's active deals."""
    return (
        measures.select(
            "stage_name",
            "stage_order",
            "probability",
            zero(F.col("deals")).alias("total_deals"),
            F.col("value").alias("total_value"),
            _weighted(F.col("value")).alias("weighted_value"),
            mean(F.col("value"), F.col("deals")).alias("avg_deal_value"),
            mean(F.col("stage_days"), F.col("stage_days_known")).alias("avg_days_in_stage"),
            zero(F.col("stagnant")).alias("stagnant_deals"),
            zero(F.col("overdue")).alias("overdue_deals"),
            *[zero(F.col(f"{s}_deals")).alias(f"{s}_deals") for s in SOURCES],
        )
        .orderBy("stage_order")
    )


def _touched_deals(m: Model, deals: DataFrame, *customer_columns: str) -> DataFrame:
    """Staged deals with customer attributes and their activity rollup.

    Spark splits the part of a customer that dominates the deals; the activity
    rollup has one row per deal.
    """
    names = m.customers.select("customer_id", *customer_columns)
    return deals.join(names, "customer_id").join(rollups.deal_activity(m.activities), "deal_id", "left")


def deal_risk_scores(m: Model, as_of: dt.date) -> DataFrame:
    """Per active deal: activity measures, risk level and weighted risk score."""
    active = rollups.staged_deals(m).where("is_active")
    deals = _touched_deals(m, active, "company_name")
    idle = days_until(as_of, F.col("last_activity_at"))
    overdue = days_until(as_of, F.col("expected_close_date"))
    age, negatives = F.col("days_in_stage"), zero(F.col("negatives"))
    level = (
        F.when(idle > 45, "Critical")
        .when((idle > 30) | (overdue > 14) | (age > 45), "High")
        .when((idle > 14) | (age > 30) | (negatives > 1), "Medium")
        .otherwise("Low")
    )
    score = (
        zero(idle) * dec("0.4") + age * dec("0.3") + zero(overdue) * dec("0.2")
        + negatives.cast("int")
    )
    return deals.select(
        "deal_id",
        "deal_name",
        "company_name",
        "stage_name",
        "deal_value",
        "days_in_stage",
        "expected_close_date",
        "assigned_rep",
        overdue.alias("days_overdue"),
        zero(F.col("total_activities")).alias("total_activities"),
        F.col("last_activity_at").alias("last_activity_date"),
        idle.alias("days_since_last_activity"),
        negatives.alias("negative_signals"),
        zero(F.col("no_responses")).alias("no_response_count"),
        level.alias("risk_level"),
        half_up(score).alias("risk_score"),
    )


def deal_health_score(m: Model, as_of: dt.date, deal_id=None) -> DataFrame:
    """Health score and status per deal, active or not; one deal when an id is given.

    The status bands leave out the negative-outcome term that the score has.
    """
    if deal_id is not None:
        this = F.col("deal_id") == F.lit(deal_id)
        m = m.replace(deals=m.deals.where(this), activities=m.activities.where(this))
    deals = _touched_deals(m, rollups.staged_deals(m), "company_name")
    idle = days_until(as_of, F.col("last_activity_at"))
    negatives = zero(F.col("negatives"))
    base = F.lit(100) - zero(idle) * dec("0.5") - F.col("days_in_stage") * dec("0.3")
    status = (
        F.when(base < 20, "Critical")
        .when(base < 45, "At Risk")
        .when(base < 65, "Needs Attention")
        .otherwise("Healthy")
    )
    return deals.select(
        "deal_id",
        "deal_name",
        "company_name",
        "deal_value",
        "stage_name",
        "days_in_stage",
        idle.alias("days_since_activity"),
        zero(F.col("total_activities")).alias("activity_count"),
        negatives.alias("negative_signals"),
        half_up(base - negatives.cast("int") * 5).alias("health_score"),
        status.alias("health_status"),
    )


def pipeline_scoring(m: Model, as_of: dt.date) -> DataFrame:
    """Per active deal: close-date status, risk score and level, weighted value."""
    active = rollups.staged_deals(m).where("is_active")
    deals = _touched_deals(m, active, "company_name", "customer_tier").join(
        rollups.open_deal_signals(m), "deal_id", "left"
    )
    idle = days_until(as_of, F.col("last_activity_at"))
    overdue = days_until(as_of, F.col("expected_close_date"))
    age = F.col("days_in_stage")
    negatives, silent = zero(F.col("negatives")), zero(F.col("no_responses"))
    critical, high = zero(F.col("open_critical")), zero(F.col("open_high"))
    close_status = (
        F.when(overdue > 0, "OVERDUE").when(overdue > -7, "CLOSING SOON").otherwise("ON TRACK")
    )
    quiet = zero(idle)
    level = (
        F.when((quiet > 45) | (critical > 0), labels.RISK_CRITICAL)
        .when((quiet > 30) | (age > 45) | (high > 0), labels.RISK_HIGH)
        .when((quiet > 14) | (age > 30), labels.RISK_MEDIUM)
        .otherwise(labels.RISK_LOW)
    )
    score = (
        quiet * dec("0.35")
        + age * dec("0.25")
        + zero(overdue) * dec("0.20")
        + negatives.cast("int") * dec("0.8")
        + silent.cast("int") * dec("0.6")
    )
    return deals.select(
        "deal_name",
        "company_name",
        "customer_tier",
        "stage_name",
        "deal_value",
        "expected_close_date",
        "assigned_rep",
        "days_in_stage",
        zero(F.col("total_activities")).alias("total_activities"),
        F.coalesce(day(F.col("last_activity_at")), day(F.col("created_at"))).alias(
            "last_activity_date"),
        F.coalesce(idle, age).alias("days_since_activity"),
        negatives.alias("negative_outcomes"),
        silent.alias("no_responses"),
        zero(F.col("open_signals")).alias("churn_signals"),
        critical.alias("critical_signals"),
        close_status.alias("close_date_status"),
        half_up(score).alias("risk_score"),
        level.alias("risk_level"),
        _weighted(F.col("deal_value")).alias("weighted_value"),
    )


def funnel_velocity(m: Model, as_of: dt.date) -> DataFrame:
    """Per stage over all deals: conversion, loss, stage-to-stage ratio, leak, speed.

    A closed stage without deals still counts one won or lost deal, as an outer
    join row does; its rates are null because the deal total is zero.
    """
    joined = rollups.stages(m).join(rollups.stage_deals(m.deals, as_of), "stage_id", "left")
    no_money = F.lit(0).cast("decimal(15,2)")
    lost = rollups.is_lost()
    base = joined.select(
        "stage_name",
        "stage_order",
        "probability",
        zero(F.col("deals")).alias("total_deals"),
        F.col("value").alias("total_value"),
        mean(F.col("stage_days"), F.col("stage_days_known")).alias("avg_days_in_stage"),
        F.when(F.col("is_won"), F.greatest(zero(F.col("deals")), F.lit(1)))
        .otherwise(0).alias("won_deals"),
        F.when(lost, F.greatest(zero(F.col("deals")), F.lit(1))).otherwise(0).alias("lost_deals"),
        F.coalesce(F.when(F.col("is_won"), F.col("value")), no_money).alias("won_value"),
        F.coalesce(F.when(lost, F.col("value")), no_money).alias("lost_value"),
    )
    previous = F.lag("total_deals").over(Window.orderBy("stage_order"))
    total, pace = F.col("total_deals"), F.col("avg_days_in_stage")
    return base.select(
        "*",
        percent(F.col("won_deals"), total).alias("conversion_rate_percent"),
        percent(F.col("lost_deals"), total).alias("loss_rate_percent"),
        percent(total, previous).alias("stage_to_stage_conversion"),
        percent(F.col("lost_value"), F.col("total_value")).alias("revenue_leak_percent"),
        F.when(pace > 45, "Slow").when(pace > 25, "Moderate").otherwise("Fast").alias(
            "velocity_status"),
    ).orderBy("stage_order")


def win_loss(m: Model) -> DataFrame:
    """Closed deals by outcome, tier, industry and source, with activity averages.

    Outcome is part of the group, so ``win_rate_percent`` is 100 or 0;
    ``segment_win_rate_percent`` is the rate over both outcomes of a segment.
    Deals are combined per customer, outcome and source before the customer
    attributes are joined, so at most ten rows per customer take part.
    """
    closed = rollups.staged_deals(m).where("is_closed")
    touched = closed.join(rollups.deal_activity(m.activities), "deal_id", "left")
    to_close = F.datediff("actual_close_date", day(F.col("created_at")))
    sums = {
        "n": F.count(F.lit(1)),
        "won_n": count_where(F.col("is_won")),
        "value": F.sum("deal_value"),
        "close_days": F.sum(to_close),
        "close_known": F.count(to_close),
        **{c: F.sum(zero(F.col(c))) for c in rollups.ACTIVITY_SUMS},
    }
    outcome = F.when(F.col("is_won"), "Won").otherwise("Lost").alias("outcome")
    per_customer = touched.groupBy("customer_id", outcome, "deal_source").agg(
        *[c.alias(name) for name, c in sums.items()]
    )
    attributes = m.customers.select("customer_id", "customer_tier", "industry")
    grouped = (
        per_customer.join(attributes, "customer_id")
        .groupBy("outcome", "customer_tier", "industry", "deal_source")
        .agg(*[F.sum(name).alias(name) for name in sums])
    )
    n = F.col("n")
    segment = Window.partitionBy("customer_tier", "industry", "deal_source")
    return grouped.select(
        "outcome",
        n.alias("total_deals"),
        mean(F.col("value"), n).alias("avg_deal_value"),
        F.col("value").alias("total_value"),
        mean(F.col("close_days"), F.col("close_known"), 0).alias("avg_days_to_close"),
        mean(F.col("total_activities"), n).alias("avg_activities"),
        mean(F.col("demos"), n).alias("avg_demos"),
        mean(F.col("meetings"), n).alias("avg_meetings"),
        mean(F.col("positives"), n).alias("avg_positive_signals"),
        mean(F.col("negatives"), n).alias("avg_negative_signals"),
        "customer_tier",
        "industry",
        "deal_source",
        percent(F.col("won_n"), n).alias("win_rate_percent"),
        percent(F.sum("won_n").over(segment), F.sum(n).over(segment)).alias(
            "segment_win_rate_percent"),
    ).orderBy("outcome", F.desc_nulls_first("total_value"))
