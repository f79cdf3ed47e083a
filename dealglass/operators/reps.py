"""Sales rep performance and leaderboard."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealglass.functions import labels
from dealglass.functions.columns import mean, percent
from dealglass.model import Model
from dealglass.plans import rollups


def rep_performance(m: Model, as_of: dt.date, fan_out: bool = False) -> DataFrame:
    """Per rep: won/lost, revenue, win rate, days to close, forecast accuracy.

    ``fan_out=True`` gives the figures of joining deals to forecasts row by
    row: counts and sums are multiplied by the rep's forecast rows.  The
    multiplication is applied to the rollups; the rows are never multiplied.
    """
    accuracy = F.col("forecast_accuracy")
    forecasts = m.forecasts.groupBy("assigned_rep").agg(
        F.count(F.lit(1)).alias("forecast_rows"),
        F.sum(accuracy).alias("accuracy_sum"),
        F.count(accuracy).alias("accuracy_known"),
    )
    reps = rollups.rep_deals(m, as_of).join(forecasts, "assigned_rep", "left")
    times = F.coalesce("forecast_rows", F.lit(1)) if fan_out else F.lit(1)
    return reps.select(
        "assigned_rep",
        (F.col("deals") * times).alias("total_deals"),
        (F.col("won") * times).alias("deals_won"),
        (F.col("lost") * times).alias("deals_lost"),
        (F.col("active") * times).alias("active_deals"),
        (F.col("won_value") * times).alias("total_revenue_won"),
        mean(F.col("won_value"), F.col("won")).alias("avg_won_deal_value"),
        (F.col("active_value") * times).alias("active_pipeline_value"),
        percent(F.col("won"), F.col("closed")).alias("win_rate_percent"),
        mean(F.col("close_days"), F.col("close_days_known"), 0).alias("avg_days_to_close"),
        (F.col("overdue") * times).alias("overdue_deals"),
        mean(F.col("accuracy_sum"), F.col("accuracy_known")).alias("avg_forecast_accuracy"),
    ).orderBy(F.desc_nulls_first("total_revenue_won"))


def rep_leaderboard(m: Model, as_of: dt.date) -> DataFrame:
    """Per rep: win rate, revenue share, revenue rank and performance grade.

    The windows see one row per rep, after aggregation.
    """
    reps = rollups.rep_deals(m, as_of)
    revenue, won = F.col("won_value"), F.col("won")
    decided = F.col("won") + F.col("lost")
    everyone = Window.partitionBy()
    grade = (
        F.when((decided > 0) & (won * 100 >= decided * 70), labels.REP_TOP)
        .when((decided > 0) & (won * 100 >= decided * 50), labels.REP_ON_TRACK)
        .when((decided > 0) & (won * 100 >= decided * 30), labels.REP_COACHING)
        .otherwise(labels.REP_UNDER)
    )
    return reps.select(
        "assigned_rep",
        F.col("deals").alias("total_deals"),
        won.alias("won_deals"),
        F.col("lost").alias("lost_deals"),
        F.col("active").alias("active_deals"),
        revenue.alias("total_revenue"),
        F.col("active_value").alias("active_pipeline"),
        mean(revenue, won).alias("avg_won_value"),
        mean(F.col("close_days"), F.col("close_days_known"), 0).alias("avg_days_to_close"),
        F.col("overdue").alias("overdue_deals"),
        percent(won, decided).alias("win_rate_percent"),
        percent(revenue, F.sum(revenue).over(everyone)).alias("revenue_share_percent"),
        F.rank().over(Window.orderBy(F.desc_nulls_first("won_value"))).alias("revenue_rank"),
        grade.alias("performance_status"),
    ).orderBy("revenue_rank", "assigned_rep")
