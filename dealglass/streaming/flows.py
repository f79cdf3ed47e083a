"""Streaming transformations: a streaming DataFrame in, a streaming DataFrame out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.functions.columns import month, stable_id, sum_where
from dealglass.model import RECORD_KEYS
from dealglass.operators.changes import as_json


def audit_changes(changes: DataFrame) -> DataFrame:
    """Audit rows of a change feed, with their id and the day they belong to.

    ``changes`` has table_name, record_id, action (INSERT, UPDATE or DELETE),
    old_data and new_data (JSON), changed_by and changed_at.  The id covers the
    change and both documents, so a redelivered change has the same one; write
    with ``run.append_new_to`` by ``log_id`` and ``changed_day``.
    """
    log_id = stable_id(
        F.col("table_name"), F.col("record_id"), F.col("action"),
        F.date_format(F.col("changed_at").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS"),
        F.md5("old_data"), F.md5("new_data"))
    return changes.select(
        log_id.alias("log_id"), "table_name", "record_id", "action", "old_data", "new_data",
        "changed_by", "changed_at", F.to_date("changed_at").alias("changed_day"))


def inserted(
    rows: DataFrame, table: str, changed_at: str, changed_by: str
) -> DataFrame:
    """The change feed of a feed of new records."""
    return rows.select(
        F.lit(table).alias("table_name"),
        F.col(RECORD_KEYS[table]).cast("string").alias("record_id"),
        F.lit("INSERT").alias("action"),
        F.lit(None).cast("string").alias("old_data"),
        as_json(F.struct(*rows.columns)).alias("new_data"),
        F.lit(changed_by).alias("changed_by"),
        F.col(changed_at).alias("changed_at"),
    )


def monthly_revenue(records: DataFrame) -> DataFrame:
    """Running monthly totals.

    The state is one row per month, so it needs no watermark and a late record
    still reaches its month.
    """
    amount, kind = F.col("amount"), F.col("revenue_type")
    return records.groupBy(month(F.col("revenue_date")).alias("revenue_month")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(amount).alias("total_revenue"),
        F.sum("mrr_contribution").alias("total_mrr"),
        F.sum("arr_contribution").alias("total_arr"),
        sum_where(kind == "New Business", amount).alias("new_business_revenue"),
        sum_where(kind == "Expansion", amount).alias("expansion_revenue"),
        sum_where(kind == "Renewal", amount).alias("renewal_revenue"),
        sum_where(kind == "Churn", amount).alias("churned_revenue"),
    )


def payers(records: DataFrame) -> DataFrame:
    """Month of each payment, and the payer as a bit of a bitmap of 32,768 customers.

    Customers are whole numbers.  Merge it with ``payer_bits`` and ``same_bits``.
    """
    customer = F.col("customer_id").cast("bigint")
    return records.where(customer.isNotNull()).select(
        month(F.col("revenue_date")).alias("revenue_month"),
        F.bitmap_bucket_number(customer).alias("bucket"),
        F.bitmap_bit_position(customer).alias("bit"))


def payer_bits(rows: DataFrame) -> DataFrame:
    return rows.groupBy("revenue_month", "bucket").agg(
        F.bitmap_construct_agg("bit").alias("bits"))


def same_bits(rows: DataFrame) -> DataFrame:
    """Bitmaps of a month and bucket as one; a payment that comes twice sets the same bit."""
    return rows.groupBy("revenue_month", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def paying_customers(bits: DataFrame, unit: str = "month") -> DataFrame:
    """Distinct payers per month, quarter or year, exact, from the bitmaps of the months."""
    period = F.to_date(F.date_trunc(unit, "revenue_month")).alias(f"revenue_{unit}")
    whole = bits.groupBy(period, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return whole.groupBy(f"revenue_{unit}").agg(
        F.sum(F.bitmap_count("bits")).alias("paying_customers"))


def guarded(signals: DataFrame, deals: DataFrame, churn_signals: DataFrame) -> DataFrame:
    """Inactivity signals of known deals without an open one, with their customer.

    ``deals`` and ``churn_signals`` are stored tables, read anew for each batch.
    """
    kind, closed = F.col("signal_type") == "No Activity", F.col("resolved")
    alerted = churn_signals.where(kind & ~closed).select(
        "deal_id", F.lit(True).alias("_open")).distinct()
    owners = deals.select("deal_id", "customer_id")
    return (
        signals.join(owners, "deal_id")
        .join(alerted, "deal_id", "left")
        .where(F.col("_open").isNull())
        .drop("_open")
    )


def inactivity(activities: DataFrame, idle_days: int = 30, delay: str = "1 day") -> DataFrame:
    """A "No Activity" signal for each gap of more than ``idle_days`` in a deal.

    Activities are taken per day; a session that closes half a day after the
    last allowed idle day holds gaps of ``idle_days`` together and splits longer
    ones, also when a clock change makes a day an hour shorter.  A gap is
    emitted once the watermark passes it, even when the deal was touched again
    in the meantime.  An activity that comes later than ``delay`` is not counted,
    so it can leave a gap that was none; ``run.append_to`` tells how many did.
    For files in any order of dates use ``touches`` and ``gaps``.
    """
    on_day = F.date_trunc("day", F.col("activity_date").cast("timestamp"))
    return _signals(
        activities.select("deal_id", on_day.alias("activity_day"))
        .withWatermark("activity_day", delay)
        .groupBy("deal_id", _session(idle_days))
        .agg(F.max("activity_day").cast("date").alias("last_day"),
             F.count(F.lit(1)).alias("activities")),
        idle_days)


def _session(idle_days: int) -> Column:
    return F.session_window("activity_day", f"{idle_days} days 12 hours").alias("quiet")


def _signals(sessions: DataFrame, idle_days: int) -> DataFrame:
    """``last_day`` is an aggregate, not the session's end: a filter on a grouping key
    would be moved below the merge of sessions and hide the touches that end a gap."""
    last_day = F.col("last_day")
    return sessions.select(
        "deal_id",
        F.lit("No Activity").alias("signal_type"),
        F.lit("Medium").alias("severity"),
        last_day.alias("last_activity_date"),
        F.date_add(last_day, idle_days + 1).alias("detected_on"),
        F.lit(False).alias("resolved"),
        "activities",
    )


def touches(activities: DataFrame) -> DataFrame:
    """Deal and day of each activity; sum it with ``run.sum_to`` by those two."""
    return activities.select(
        "deal_id", F.to_date("activity_date").alias("activity_day"),
        F.lit(1).cast("long").alias("activities")).where("activity_day is not null")


def gaps(per_day: DataFrame, idle_days: int = 30, delay_days: int = 1) -> DataFrame:
    """The signals of ``inactivity`` from the sums of ``touches``, whatever their order.

    A gap is reported once the newest day of all is ``delay_days`` past it; one that
    a later activity fills is gone from the next result.
    """
    sessions = per_day.withColumn("activity_day", F.col("activity_day").cast("timestamp")).groupBy(
        "deal_id", _session(idle_days)).agg(
            F.max("activity_day").cast("date").alias("last_day"),
            F.sum("activities").alias("activities"))
    return _signals(sessions, idle_days).where(F.col("detected_on") <= _mark(per_day, delay_days))


def _mark(per_day: DataFrame, delay_days: int) -> Column:
    return per_day.agg(F.date_sub(F.max("activity_day"), delay_days)).scalar()


def typed(activities: DataFrame) -> DataFrame:
    """Day and type of each activity; sum it with ``run.sum_to`` by those two."""
    return activities.select(
        F.to_date("activity_date").alias("activity_day"), "activity_type",
        F.lit(1).cast("long").alias("activities"),
        F.coalesce((F.col("outcome") == "Positive").cast("long"), F.lit(0)).alias("positives"),
    ).where("activity_day is not null")


def closed_days(per_day: DataFrame, delay_days: int = 1) -> DataFrame:
    """The sums of ``typed`` for the days that ended ``delay_days`` before the newest."""
    return per_day.where(F.date_add("activity_day", 1) <= _mark(per_day, delay_days))


def activity_daily(activities: DataFrame, delay: str = "1 day") -> DataFrame:
    """Activity counts per day and type; days are final once the watermark passes them.

    Rows later than ``delay`` are not counted; for files in any order of dates use
    ``typed`` and ``closed_days``.
    """
    return (
        activities.select(
            F.col("activity_date").cast("timestamp").alias("at"), "activity_type", "outcome")
        .withWatermark("at", delay)
        .groupBy(F.window("at", "1 day").alias("day"), "activity_type")
        .agg(
            F.count(F.lit(1)).alias("activities"),
            F.count(F.when(F.col("outcome") == "Positive", 1)).alias("positives"),
        )
        .select(F.col("day.start").cast("date").alias("activity_day"), "activity_type",
                "activities", "positives")
    )
