"""Monthly revenue, MRR/ARR trend, forecasts and revenue anomalies.

Windows here run over month rows that are already aggregated (per revenue type
or per month), never over raw records.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealglass.functions import labels
from dealglass.functions.columns import (
    count_where, day, dec, half_up, mean, month, on, percent, quotient, sum_where)
from dealglass.model import Model
from dealglass.plans import rollups


def _type_is(name: str) -> Column:
    return F.col("revenue_type") == name


def revenue_by_month(m: Model) -> DataFrame:
    """Per month and revenue type: totals, payment split, month-over-month change."""
    amount, paid = F.col("amount"), F.col("payment_status")
    monthly = m.revenue_records.groupBy(
        month(F.col("revenue_date")).alias("revenue_month"), "revenue_type"
    ).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(amount).alias("total_revenue"),
        F.sum("mrr_contribution").alias("total_mrr"),
        F.sum("arr_contribution").alias("total_arr"),
        sum_where(paid == "Paid", amount).alias("collected_revenue"),
        sum_where(paid == "Overdue", amount).alias("overdue_revenue"),
        sum_where(paid == "Pending", amount).alias("pending_revenue"),
    )
    by_type = Window.partitionBy("revenue_type").orderBy("revenue_month")
    total = F.col("total_revenue")
    change = total - F.col("previous")
    return (
        monthly.withColumn("previous", F.lag(total).over(by_type))
        .select(
            "revenue_month",
            "revenue_type",
            "total_transactions",
            "total_revenue",
            mean(total, F.col("total_transactions")).alias("avg_transaction_value"),
            "total_mrr",
            "total_arr",
            "collected_revenue",
            "overdue_revenue",
            "pending_revenue",
            change.alias("mom_revenue_change"),
            percent(change, F.col("previous")).alias("mom_growth_percent"),
        )
        .orderBy("revenue_month", F.asc_nulls_last("revenue_type"))
    )


def monthly_revenue_totals(m: Model) -> DataFrame:
    """Per month: payers, transactions, revenue, MRR, ARR and the split by type."""
    amount = F.col("amount")
    return m.revenue_records.groupBy(month(F.col("revenue_date")).alias("revenue_month")).agg(
        F.countDistinct("customer_id").alias("paying_customers"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(amount).alias("total_revenue"),
        F.sum("mrr_contribution").alias("total_mrr"),
        F.sum("arr_contribution").alias("total_arr"),
        sum_where(_type_is("New Business"), amount).alias("new_business_revenue"),
        sum_where(_type_is("Expansion"), amount).alias("expansion_revenue"),
        sum_where(_type_is("Renewal"), amount).alias("renewal_revenue"),
        sum_where(_type_is("Churn"), amount).alias("churned_revenue"),
    )


def with_month_over_month(monthly: DataFrame) -> DataFrame:
    """Adds change and growth against the previous existing month."""
    total = F.col("total_revenue")
    change = total - F.col("previous")
    return (
        monthly.withColumn("previous", F.lag(total).over(Window.orderBy("revenue_month")))
        .withColumn("mom_change", change)
        .withColumn("mom_growth_percent", percent(change, F.col("previous")))
        .drop("previous")
    )


def monthly_revenue_summary(m: Model) -> DataFrame:
    """Monthly revenue totals with month-over-month change and growth."""
    return with_month_over_month(monthly_revenue_totals(m)).orderBy("revenue_month")


def mrr_trend(m: Model) -> DataFrame:
    """Per month: MRR by type, change, growth, running total, revenue per payer, trend.

    Revenue of type Churn counts towards total MRR; ``net_mrr`` leaves it out.
    """
    mrr = F.col("mrr_contribution")
    monthly = m.revenue_records.groupBy(month(F.col("revenue_date")).alias("revenue_month")).agg(
        F.sum(mrr).alias("total_mrr"),
        F.sum("arr_contribution").alias("total_arr"),
        sum_where(_type_is("New Business"), mrr).alias("new_mrr"),
        sum_where(_type_is("Expansion"), mrr).alias("expansion_mrr"),
        sum_where(_type_is("Renewal"), mrr).alias("renewal_mrr"),
        sum_where(_type_is("Churn"), mrr).alias("churned_mrr"),
        F.countDistinct("customer_id").alias("paying_customers"),
    )
    by_month = Window.orderBy("revenue_month")
    total, previous = F.col("total_mrr"), F.col("previous")
    trend = (
        F.when(total > previous, labels.TREND_GROWING)
        .when(total < previous, labels.TREND_DECLINING)
        .otherwise(labels.TREND_FLAT)
    )
    return (
        monthly.withColumn("previous", F.lag(total).over(by_month))
        .withColumn("cumulative_mrr", F.sum(total).over(by_month))
        .select(
            "revenue_month",
            "total_mrr",
            "total_arr",
            "new_mrr",
            "expansion_mrr",
            "renewal_mrr",
            "churned_mrr",
            "paying_customers",
            (total - previous).alias("mrr_change"),
            percent(total - previous, previous).alias("mrr_growth_percent"),
            "cumulative_mrr",
            quotient(total, F.col("paying_customers")).alias("arpu"),
            trend.alias("growth_trend"),
            (total - F.col("churned_mrr")).alias("net_mrr"),
        )
        .orderBy("revenue_month")
    )


def overall_win_rate(m: Model) -> DataFrame:
    """One row: won share of closed deals in percent, over all deals."""
    per_stage = m.deals.groupBy("stage_id").agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    won = F.sum(F.when(F.col("is_won"), n).otherwise(0))
    closed = F.sum(F.when(F.col("is_closed"), n).otherwise(0))
    return per_stage.join(rollups.stages(m), "stage_id").agg(
        percent(won, closed).alias("win_rate")
    )


def open_pipeline_by_day(m: Model) -> DataFrame:
    """Per expected closing day: active deals, value, and value times stage probability."""
    return (
        rollups.staged_deals(m)
        .where("is_active")
        .groupBy("expected_close_date")
        .agg(
            F.count(F.lit(1)).alias("active_deals"),
            F.sum("deal_value").alias("total_pipeline"),
            F.sum(F.col("deal_value") * F.col("probability")).alias("weighted"),
        )
    )


# Forecast figures of a month, for the DataFrame operator and the SQL function alike.
FORECAST = {
    "forecast_month": "forecast_month",
    "active_deals": "active_deals",
    "total_pipeline": "total_pipeline",
    "weighted_forecast": "round(weighted * 0.01, 2)",
    "best_case": "round(total_pipeline * 0.90, 2)",
    "worst_case": "round(total_pipeline * 0.40, 2)",
    "historical_win_rate": "historical_win_rate",
    "predicted_revenue":
        "round(total_pipeline * cast(historical_win_rate as decimal(7,2)) * 0.01, 2)",
}


def revenue_forecast(m: Model, as_of: dt.date, months: int = 3) -> DataFrame:
    """Per month of expected close within ``months``: weighted, best, worst, predicted."""
    close = F.col("expected_close_date")
    due = rollups.closing(m.deals, on(as_of), F.add_months(on(as_of), months))
    return (
        open_pipeline_by_day(m.replace(deals=due))
        .groupBy(month(close).alias("forecast_month"))
        .agg(*[F.sum(c).alias(c) for c in ("active_deals", "total_pipeline", "weighted")])
        .withColumn("historical_win_rate", overall_win_rate(m).scalar())
        .selectExpr(*[f"{formula} AS {name}" for name, formula in FORECAST.items()])
        .orderBy("forecast_month")
    )


def rep_forecast(m: Model, as_of: dt.date) -> DataFrame:
    """Per month and rep: weighted pipeline against the rep's own win rate."""
    close, value = F.col("expected_close_date"), F.col("deal_value")
    history = rollups.rep_deals(m, as_of).select(
        "assigned_rep",
        percent(F.col("won"), F.col("closed")).cast("decimal(7,2)").alias("historical_win_rate"),
        mean(F.col("close_days"), F.col("close_days_known"), 0).alias("avg_days_to_close"),
    )
    due = rollups.closing(m.deals, on(as_of))
    pipeline = (
        rollups.staged_deals(m.replace(deals=due))
        .where("is_active")
        .groupBy(month(close).alias("forecast_month"), "assigned_rep")
        .agg(
            F.count(F.lit(1)).alias("deals_in_period"),
            F.sum(value).alias("total_pipeline"),
            half_up(F.sum(value * F.col("probability")) * dec("0.01")).alias("weighted_pipeline"),
        )
    )
    total, weighted = F.col("total_pipeline"), F.col("weighted_pipeline")
    expected = total * F.col("historical_win_rate") * dec("0.01")
    bias = (
        F.when(weighted > expected, "Optimistic")
        .when(weighted < expected, "Conservative")
        .otherwise("On Target")
    )
    return (
        pipeline.join(history, "assigned_rep", "left")
        .select(
            "forecast_month",
            "assigned_rep",
            "deals_in_period",
            "total_pipeline",
            "weighted_pipeline",
            half_up(total * dec("0.90")).alias("best_case"),
            half_up(total * dec("0.40")).alias("worst_case"),
            "historical_win_rate",
            "avg_days_to_close",
            half_up(expected).alias("predicted_revenue"),
            half_up(weighted - expected).alias("forecast_gap"),
            bias.alias("forecast_bias"),
        )
        .orderBy("forecast_month", F.asc_nulls_last("assigned_rep"))
    )


def revenue_anomalies(m: Model, threshold: float = 2.0) -> DataFrame:
    """Z-score of each month's revenue within its revenue type; flags abs(z) above the limit."""
    monthly = m.revenue_records.groupBy(
        month(F.col("revenue_date")).alias("revenue_month"), "revenue_type"
    ).agg(F.sum("amount").alias("total_revenue"))
    months_of_type = Window.partitionBy("revenue_type")
    x = F.col("total_revenue").cast("double")
    spread = F.stddev_samp(x).over(months_of_type)
    z = (x - F.avg(x).over(months_of_type)) / F.nullif(spread, F.lit(0.0))
    return monthly.withColumn("z_score", F.round(z, 4)).withColumn(
        "is_anomaly", F.coalesce(F.abs("z_score") > F.lit(threshold), F.lit(False))
    )


def forecast_accuracy(m: Model) -> DataFrame:
    """Per forecast row: weighted pipeline (70 %) and actual over committed in percent."""
    return m.forecasts.select(
        "forecast_month",
        "assigned_rep",
        "pipeline_value",
        half_up(F.col("pipeline_value") * dec("0.70")).alias("weighted_pipeline"),
        "committed_value",
        "actual_revenue",
        percent(F.col("actual_revenue"), F.col("committed_value")).alias("forecast_accuracy"),
    )


def derive_mrr_arr(records: DataFrame) -> DataFrame:
    """Fills MRR and ARR from amount and billing period.

    Annual amounts spread over twelve months, quarterly over three; one-time
    revenue does not recur.
    """
    amount, period = F.col("amount"), F.col("billing_period")
    nothing = F.lit(0).cast("decimal(15,2)")
    mrr = (
        F.when(period == "Annual", half_up(amount / F.lit(12)))
        .when(period == "Quarterly", half_up(amount / F.lit(3)))
        .when(period == "Monthly", amount)
        .otherwise(nothing)
    )
    arr = (
        F.when(period == "Annual", amount)
        .when(period == "Quarterly", amount * 4)
        .when(period == "Monthly", amount * 12)
        .otherwise(nothing)
    )
    return records.withColumn("mrr_contribution", mrr.cast("decimal(15,2)")).withColumn(
        "arr_contribution", arr.cast("decimal(15,2)")
    )
