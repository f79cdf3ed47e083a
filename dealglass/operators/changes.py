"""Audit trail from two snapshots, and inactivity detection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.functions.columns import days_until, moment, stable_id
from dealglass.model import RECORD_KEYS, Model
from dealglass.plans import rollups


def as_json(row: Column) -> Column:
    """A struct as a JSON document; nulls are written, not dropped."""
    return F.to_json(
        row, {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    )


def audit_id(table: str, at: Column) -> Column:
    """Stable log id, so a repeated run writes the same rows again."""
    return stable_id(F.lit(table), F.col("record_id"), F.col("action"), at)


def _aligned(rows: DataFrame, other: DataFrame) -> list[Column]:
    """Columns of both snapshots by name; null where this one lacks a column."""
    mine = set(rows.columns)
    added = [f for f in other.schema.fields if f.name not in mine]
    return [*rows.columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in added]]


def audit_log_diff(
    before: DataFrame, after: DataFrame, table: str, changed_by: str, changed_at: dt.datetime
) -> DataFrame:
    """One audit row per inserted, updated or deleted record between two snapshots.

    The record key comes from an explicit map, since table and key names do not
    follow one pattern.  Keys are unique, so the full outer join cannot skew;
    rows are compared as typed columns and only changed ones become JSON.  A
    column that one snapshot lacks is null there.
    """
    key = RECORD_KEYS[table]
    both = [*before.columns, *[c for c in after.columns if c not in before.columns]]
    old = before.select(*_aligned(before, after)).select(
        F.col(key).alias("_key"), F.struct(*both).alias("old"))
    new = after.select(*_aligned(after, before)).select(
        F.col(key).alias("_key"), F.struct(*both).alias("new"))
    action = (
        F.when(F.col("old").isNull(), "INSERT")
        .when(F.col("new").isNull(), "DELETE")
        .otherwise("UPDATE")
    )
    at = moment(changed_at)
    return (
        old.join(new, "_key", "full_outer")
        .where(~F.col("old").eqNullSafe(F.col("new")))
        .select(
            F.lit(table).alias("table_name"),
            F.col("_key").cast("string").alias("record_id"),
            action.alias("action"),
            as_json(F.col("old")).alias("old_data"),
            as_json(F.col("new")).alias("new_data"),
            F.lit(changed_by).alias("changed_by"),
            at.alias("changed_at"),
        )
        .select(audit_id(table, at).alias("log_id"), "*")
    )


def detect_inactivity(
    m: Model, as_of: dt.date, detected_at: dt.datetime, active_only: bool = False
) -> DataFrame:
    """New "No Activity" signals: deals idle for over 30 days without an open one.

    A deal without any activity counts as idle for 999 days.
    """
    deals = m.deals.where("is_active") if active_only else m.deals
    last = rollups.deal_activity(m.activities).select("deal_id", "last_activity_at")
    alerted = (
        m.churn_signals.where(~F.col("resolved") & (F.col("signal_type") == "No Activity"))
        .select("deal_id")
        .distinct()
    )
    idle = F.coalesce(days_until(as_of, F.col("last_activity_at")), F.lit(999))
    severity = F.when(idle > 60, "Critical").when(idle > 45, "High").otherwise("Medium")
    return (
        deals.select("deal_id", "customer_id")
        .join(last, "deal_id", "left")
        .where(idle > 30)
        .join(alerted, "deal_id", "left_anti")
        .select(
            stable_id(F.lit("No Activity"), F.col("deal_id"), F.lit(as_of)).alias("signal_id"),
            "customer_id",
            "deal_id",
            F.lit("No Activity").alias("signal_type"),
            severity.alias("severity"),
            moment(detected_at).alias("detected_at"),
            F.lit(False).alias("resolved"),
        )
    )
