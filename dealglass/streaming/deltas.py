"""Stored results refreshed by signed changes instead of recomputed.

A change carries the image of its record before and after; the old image counts with sign -1,
the new one with +1.  Each flow turns the changes into keys and signed numbers, and
``run.sum_to`` adds them up per batch, so the sums do not depend on how the feed was cut or
ordered.  The feed must hold each change once: read it from the audit table, which does.

A minimum cannot be taken back by subtraction, so it is kept as an index: values with their
signed counts, of which the least with a positive count is the minimum.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealglass.functions.columns import day, month
from dealglass.model import Model
from dealglass.operators import customers, pipeline
from dealglass.operators.history import from_image
from dealglass.plans import rollups


def images(changes: DataFrame, table: str, schema: StructType) -> DataFrame:
    """The rows of a table before (sign -1) and after (sign 1) each change."""
    rows = changes.where(F.col("table_name") == table)
    both = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("old_data").alias("image")),
        F.struct(F.lit(1).alias("sign"), F.col("new_data").alias("image")))
    each = rows.select(F.inline(both)).where("image is not null")
    return each.select("sign", from_image(F.col("image"), schema).alias("row")).select(
        "sign", "row.*")


def _signed(value: Column) -> Column:
    return F.coalesce(value * F.col("sign"), F.lit(0))


def _money(value: Column) -> Column:
    return _signed(value).cast("decimal(15,2)")


def _sums(rows: DataFrame, *columns: str) -> DataFrame:
    """Sums in the type that a sum of money has."""
    return rows.withColumns({c: F.col(c).cast("decimal(25,2)") for c in columns})


def _if(condition: Column) -> Column:
    return F.when(condition, F.col("sign")).otherwise(0).cast("long")


def _stages(m: Model) -> DataFrame:
    return F.broadcast(rollups.stages(m))  # seven rows


def stage_sums(changes: DataFrame, deals: StructType, as_of: dt.date) -> DataFrame:
    """Signed measures of active deals, to be summed by stage_id."""
    active = images(changes, "deals", deals).where("is_active")
    source, days = F.col("deal_source"), F.col("days_in_stage")
    return active.select(
        "stage_id",
        F.col("sign").cast("long").alias("deals"),
        _money(F.col("deal_value")).alias("value"),
        _signed(days).cast("long").alias("stage_days"),
        _if(days.isNotNull()).alias("stage_days_known"),
        _if(days > 30).alias("stagnant"),
        _if(F.col("expected_close_date") < F.lit(as_of)).alias("overdue"),
        *[_if(source == s.title()).alias(f"{s}_deals") for s in pipeline.SOURCES])


def pipeline_health(m: Model, sums: DataFrame) -> DataFrame:
    """``pipeline.pipeline_health`` from the sums of ``stage_sums``."""
    held = _sums(sums.where("deals > 0"), "value").withColumn(
        "stage_days", F.when(F.col("stage_days_known") > 0, F.col("stage_days")))
    return pipeline.health_of_stages(rollups.stages(m).join(held, "stage_id", "left"))


def deal_sums(changes: DataFrame, deals: StructType, m: Model) -> DataFrame:
    """Signed measures of deals, to be summed by customer_id."""
    rows = images(changes, "deals", deals).join(_stages(m), "stage_id", "left")
    won = F.col("is_won")
    return rows.select(
        "customer_id",
        F.col("sign").cast("long").alias("deals"),
        _if(won).alias("won_deals"),
        _if(F.col("is_closed")).alias("closed_deals"),
        _money(F.when(won, F.col("deal_value"))).alias("won_value"))


def revenue_sums(changes: DataFrame, records: StructType) -> DataFrame:
    """Signed measures of revenue records, to be summed by customer_id."""
    return images(changes, "revenue_records", records).select(
        "customer_id", F.col("sign").cast("long").alias("records"),
        _money(F.col("mrr_contribution")).alias("mrr"),
        _money(F.col("arr_contribution")).alias("arr"))


ATTRIBUTES = ["customer_id", "customer_tier", "industry", "country", "status"]


def customer_images(changes: DataFrame, schema: StructType) -> DataFrame:
    """Signed states of customers, to be summed by ``ATTRIBUTES``."""
    return images(changes, "customers", schema).select(
        *ATTRIBUTES, F.col("sign").cast("long").alias("n"))


def customer_segments(states: DataFrame, deals: DataFrame, revenue: DataFrame) -> DataFrame:
    """``customers.customer_segments`` from the three summed flows."""
    billed = _sums(revenue.where("records > 0"), "mrr", "arr")
    owned = _sums(deals.where("deals > 0"), "won_value")
    base = (
        states.where("n > 0").select(*ATTRIBUTES)
        .join(owned, "customer_id", "left")
        .join(billed, "customer_id", "left"))
    return customers.segments_of(base)


def deal_days(changes: DataFrame, deals: StructType) -> DataFrame:
    """Index for the first deal of a customer, to be summed by customer_id and deal_day."""
    return images(changes, "deals", deals).select(
        "customer_id", day(F.col("created_at")).alias("deal_day"),
        F.col("sign").cast("long").alias("n"))


def first_deals(index: DataFrame) -> DataFrame:
    """Per customer the first day that still has a deal."""
    return index.where("n > 0").groupBy("customer_id").agg(
        F.min("deal_day").alias("first_deal_date"))


def cohort_sizes(index: DataFrame) -> DataFrame:
    """Customers per month of their first deal."""
    return first_deals(index).groupBy(month(F.col("first_deal_date")).alias("cohort_month")).agg(
        F.count(F.lit(1)).alias("cohort_size"))
