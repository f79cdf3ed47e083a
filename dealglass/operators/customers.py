"""Customer health, segments, lifetime value, churn risk and segmentation.

Every operator joins customers to per-customer rollups, one row per customer
on both sides.  ``fan_out=True`` gives the figures of joining the child tables
to the customer row by row (each sum multiplied by the row counts of the other
tables); the multiplication is arithmetic on the rollups.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.functions import labels
from dealglass.functions.columns import days_until, dec, half_up, mean, percent, zero
from dealglass.model import Model
from dealglass.plans import rollups
from dealglass.plans.quantiles import ntile


def _cash(col: Column) -> Column:
    return F.coalesce(col, F.lit(0).cast("decimal(15,2)"))


def _rows(col: Column) -> Column:
    """Rows an outer join contributes for a child table: at least one."""
    return F.greatest(zero(col), F.lit(1))


def _times(*counts: Column) -> Column:
    """Product of row counts; null beyond 64 bits, where such a figure means nothing."""
    return reduce(F.try_multiply, counts)


def customer_health(m: Model, as_of: dt.date, fan_out: bool = False) -> DataFrame:
    """Per customer: deals, activities, churn signals, health score and status."""
    base = (
        m.customers.select("customer_id", "company_name", "customer_tier", "industry", "status")
        .transform(rollups.join_book, m)
        .join(rollups.customer_signals(m), "customer_id", "left")
    )
    deal_rows, touch_rows = _rows(F.col("deals")), _rows(F.col("total_activities"))
    signal_rows = _rows(F.col("signals"))
    deal_times = _times(touch_rows, signal_rows) if fan_out else F.lit(1)
    signal_times = _times(deal_rows, touch_rows) if fan_out else F.lit(1)
    idle = days_until(as_of, F.col("last_activity_at"))
    # (condition, score, status), first match wins
    ladder = [
        (F.col("open_critical") > 0, 20, "Critical"),
        (F.col("open_high") > 0, 45, "At Risk"),
        (F.col("open_medium") > 0, 65, "Needs Attention"),
        (idle > 30, 70, "Needs Attention"),
        (F.col("open_low") > 0, 80, "Healthy"),
    ]
    score, status = F.lit(None), F.lit(None)
    for i, (cond, points, text) in enumerate(ladder):
        score = F.when(cond, points) if i == 0 else score.when(cond, points)
        status = F.when(cond, text) if i == 0 else status.when(cond, text)
    return base.select(
        "customer_id",
        "company_name",
        "customer_tier",
        "industry",
        "status",
        zero(F.col("deals")).alias("total_deals"),
        (_cash(F.col("won_value")) * deal_times).alias("total_revenue"),
        mean(F.col("won_value"), F.col("won_deals")).alias("avg_deal_value"),
        zero(F.col("total_activities")).alias("total_activities"),
        F.col("last_activity_at").alias("last_activity_date"),
        idle.alias("days_since_activity"),
        zero(F.col("signals")).alias("total_churn_signals"),
        _times(zero(F.col("critical")), signal_times).alias("critical_signals"),
        _times(zero(F.col("high")), signal_times).alias("high_signals"),
        _times(zero(F.col("open_signals")), signal_times).alias("unresolved_signals"),
        score.otherwise(95).cast("decimal(5,2)").alias("health_score"),
        status.otherwise("Healthy").alias("health_status"),
    )


def customer_segments(m: Model, fan_out: bool = False) -> DataFrame:
    """Per tier, industry and country: customers, revenue, win rate, churn rate, MRR/ARR."""
    deals = rollups.customer_deals(m).select(
        "customer_id", "deals", "won_deals", "closed_deals", "won_value")
    revenue = rollups.customer_revenue(m).select("customer_id", "records", "mrr", "arr")
    base = (
        m.customers.select("customer_id", "customer_tier", "industry", "country", "status")
        .join(deals, "customer_id", "left")
        .join(revenue, "customer_id", "left")
    )
    return segments_of(base, fan_out)


def segments_of(base: DataFrame, fan_out: bool = False) -> DataFrame:
    """Segments from one row per customer: attributes, deal and revenue rollups."""
    one = F.lit(1)
    deal_times = _rows(F.col("records")) if fan_out else one
    revenue_times = _rows(F.col("deals")) if fan_out else one
    row_times = _times(deal_times, revenue_times)
    grouped = base.groupBy("customer_tier", "industry", "country").agg(
        F.count(one).alias("total_customers"),
        F.sum(zero(F.col("deals"))).alias("total_deals"),
        F.sum(_cash(F.col("won_value")) * deal_times).alias("total_revenue"),
        F.try_sum(_times(zero(F.col("won_deals")), deal_times)).alias("won"),
        F.try_sum(_times(zero(F.col("closed_deals")), deal_times)).alias("closed"),
        F.try_sum(F.when(F.col("status") == "Churned", row_times).otherwise(0)).alias(
            "churned_customers"),
        F.try_sum(F.when(F.col("status") == "At-Risk", row_times).otherwise(0)).alias(
            "at_risk_customers"),
        F.sum(F.col("mrr") * revenue_times).alias("total_mrr"),
        F.sum(F.col("arr") * revenue_times).alias("total_arr"),
    )
    return grouped.select(
        "customer_tier",
        "industry",
        "country",
        "total_customers",
        "total_deals",
        "total_revenue",
        mean(F.col("total_revenue"), F.col("won")).alias("avg_deal_value"),
        percent(F.col("won"), F.col("closed")).alias("win_rate_percent"),
        "churned_customers",
        "at_risk_customers",
        percent(F.col("churned_customers"), F.col("total_customers")).alias("churn_rate_percent"),
        "total_mrr",
        "total_arr",
    ).orderBy(F.desc_nulls_first("total_revenue"))


def customer_lifetime_value(
    m: Model, as_of: dt.date, customer_id=None, fan_out: bool = False
) -> DataFrame:
    """Per customer (or one, by id): lifetime revenue, monthly mean, projections, churn risk.

    Months are whole 30-day spans since the first deal; a customer younger than
    that has no monthly figures.
    """
    if customer_id is not None:
        m = _only_customer(m, customer_id)
    revenue = rollups.customer_revenue(m).select("customer_id", "records", "expansion_revenue")
    signals = rollups.customer_signals(m).select("customer_id", "open_signals")
    base = (
        m.customers.select("customer_id", "company_name", "customer_tier", "industry")
        .transform(rollups.join_book, m)
        .join(revenue, "customer_id", "left")
        .join(signals, "customer_id", "left")
    )
    one = F.lit(1)
    deal_rows, touch_rows = _rows(F.col("deals")), _rows(F.col("total_activities"))
    bill_rows, signal_rows = _rows(F.col("records")), _rows(F.col("open_signals"))
    deal_times = _times(touch_rows, bill_rows, signal_rows) if fan_out else one
    bill_times = _times(deal_rows, touch_rows, signal_rows) if fan_out else one
    won = _cash(F.col("won_value")) * deal_times
    age = days_until(as_of, F.col("first_deal_date"))
    # integer division truncates towards zero, also for a first deal after as_of
    months = F.when(age >= 0, F.floor(age / 30)).otherwise(F.ceil(age / 30))
    idle = days_until(as_of, F.col("last_activity_at"))

    def per_month(times: int) -> Column:
        return mean(won.cast("decimal(21,2)") * times, months)

    return base.select(
        "customer_id",
        "company_name",
        "customer_tier",
        "industry",
        won.alias("total_revenue"),
        zero(F.col("deals")).alias("total_deals"),
        F.try_multiply(zero(F.col("won_deals")), deal_times).alias("won_deals"),
        mean(F.col("won_value"), F.col("won_deals")).alias("avg_deal_value"),
        zero(F.col("total_activities")).alias("total_activities"),
        "first_deal_date",
        "latest_deal_date",
        age.alias("customer_age_days"),
        per_month(1).alias("avg_monthly_revenue"),
        per_month(12).alias("projected_annual_value"),
        (_cash(F.col("expansion_revenue")) * bill_times).alias("expansion_revenue"),
        half_up(zero(F.col("open_signals")) * dec("10") + zero(idle) * dec("0.5")).alias(
            "churn_risk_score"),
        per_month(24).alias("clv_estimate"),
    )


def _only_customer(m: Model, customer_id) -> Model:
    """The model restricted to one customer, before anything is aggregated."""
    mine = F.col("customer_id") == F.lit(customer_id)
    deals = m.deals.where(mine)
    if "customer_id" in m.activities.columns:
        activities = m.activities.where(mine)
    else:
        activities = m.activities.join(deals.select("deal_id"), "deal_id", "left_semi")
    return m.replace(
        customers=m.customers.where(mine),
        deals=deals,
        activities=activities,
        revenue_records=m.revenue_records.where(mine),
        churn_signals=m.churn_signals.where(mine),
    )


def churn_risk_ranking(m: Model, as_of: dt.date) -> DataFrame:
    """Per customer: churn risk score from activity, billing and signals, and its level."""
    touches = rollups.customer_activity(m).select(
        "customer_id", "last_activity_at", "negatives")
    revenue = rollups.customer_revenue(m).select(
        "customer_id", "billed", "overdue_amount", "overdue_count", "expansion_revenue")
    signals = rollups.customer_signals(m).select(
        "customer_id", "signals", "open_critical", "open_high", "expiring", "competitor")
    base = (
        m.customers.select("customer_id", "company_name", "customer_tier", "industry", "status")
        .join(touches, "customer_id", "left")
        .join(revenue, "customer_id", "left")
        .join(signals, "customer_id", "left")
    )
    idle = days_until(as_of, F.col("last_activity_at"))
    critical, high = zero(F.col("open_critical")), zero(F.col("open_high"))
    overdue, expiring = zero(F.col("overdue_count")), zero(F.col("expiring"))
    competitor = zero(F.col("competitor"))
    score = zero(idle) * dec("0.25") + (
        critical * 25 + high * 15 + zero(F.col("negatives")) * 8 + overdue * 10
        + competitor * 18 + expiring * 12
    ).cast("decimal(18,0)")
    level = (
        F.when((critical > 0) | (F.col("status") == "Churned"), labels.RISK_CRITICAL)
        .when((high > 0) | (overdue > 0), labels.RISK_HIGH)
        .when((zero(idle) > 30) | (expiring > 0), labels.RISK_MEDIUM)
        .when(_cash(F.col("expansion_revenue")) > 0, labels.CHURN_EXPANDING)
        .otherwise(labels.CHURN_HEALTHY)
    )
    return base.select(
        "company_name",
        "customer_tier",
        "industry",
        "status",
        F.coalesce(idle, F.lit(999)).alias("days_inactive"),
        _cash(F.col("overdue_amount")).alias("overdue_amount"),
        _cash(F.col("billed")).alias("total_revenue"),
        zero(F.col("signals")).alias("total_churn_signals"),
        critical.alias("critical_signals"),
        expiring.alias("expiring_contracts"),
        competitor.alias("competitor_mentions"),
        half_up(score).alias("churn_risk_score"),
        level.alias("churn_risk_level"),
    )


def customer_segmentation(
    m: Model, as_of: dt.date, high_value: int = 1_000_000, mid_value: int = 250_000,
    recent_days: int = 90,
) -> DataFrame:
    """Per customer: a segment from won revenue, recency and status (own definition).

    Thresholds are arguments, so no global ranking of customers is needed.
    """
    base = rollups.join_book(
        m.customers.select("customer_id", "company_name", "customer_tier", "status"), m)
    won = _cash(F.col("won_value"))
    idle = days_until(as_of, F.col("last_activity_at"))
    recent = F.coalesce(idle <= recent_days, F.lit(False))
    band = F.when(won >= high_value, "High").when(won >= mid_value, "Mid").otherwise("Low")
    segment = (
        F.when(F.col("status") == "Churned", "Lost")
        .when(won == 0, "Prospect")
        .when((won >= high_value) & recent, "Champion")
        .when(won >= high_value, "Win Back")
        .when((won >= mid_value) & recent, "Growth")
        .when(recent, "Developing")
        .otherwise("Dormant")
    )
    return base.select(
        "customer_id",
        "company_name",
        "customer_tier",
        won.alias("total_revenue"),
        idle.alias("days_since_activity"),
        band.alias("value_band"),
        segment.alias("segment"),
    )


def customer_tiles(m: Model, as_of: dt.date, tiles: int = 3) -> DataFrame:
    """Per customer: exact tiles by won revenue and by recency, and a segment of both.

    Tile 1 is the least revenue and the longest silence; customers without an activity
    come first.  Equal values go by customer id.
    """
    base = rollups.join_book(
        m.customers.select("customer_id", "company_name", "customer_tier", "status"), m)
    base = base.select(
        "customer_id", "company_name", "customer_tier", "status",
        _cash(F.col("won_value")).alias("total_revenue"),
        days_until(as_of, F.col("last_activity_at")).alias("days_since_activity"))
    by_value = ntile(base, tiles, [F.asc("total_revenue"), F.asc("customer_id")], "value_tile")
    silence = [F.desc_nulls_first("days_since_activity"), F.asc("customer_id")]
    both = ntile(by_value, tiles, silence, "recency_tile")
    best, recent = F.col("value_tile") == tiles, F.col("recency_tile") == tiles
    segment = (
        F.when(F.col("status") == "Churned", "Lost")
        .when(F.col("total_revenue") == 0, "Prospect")
        .when(best & recent, "Champion")
        .when(best, "Win Back")
        .when(recent, "Developing")
        .when(F.col("recency_tile") == 1, "Dormant")
        .otherwise("Growth")
    )
    return both.select(
        "customer_id", "company_name", "customer_tier", "total_revenue", "days_since_activity",
        "value_tile", "recency_tile", segment.alias("segment"))
