"""The change feed of the model over order-processing tables: who changed when, day by day.

Each record comes with all its changes at once, from its own row, so the feed is one
projection of each table.  A deal is inserted when it is made, updated when it closes and, if
lost, deleted some years later; ``orders.deals_as_of`` gives the same states.
"""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.functions.columns import moment
from dealglass.model import RECORD_KEYS, Model
from dealglass.operators.changes import as_json

FOUNDED = dt.datetime(1992, 1, 1)  # customers have no date of their own
RESOLVED_AFTER = 30  # days from a signal to its resolution


def _image(row: DataFrame, **changed: Column) -> Column:
    return F.struct(*[changed.get(c, F.col(c)).alias(c) for c in row.columns])


def _event(action: str, at: Column, old: Column | None, new: Column | None) -> Column:
    def document(image: Column | None) -> Column:
        return F.lit(None).cast("string") if image is None else as_json(image)

    return F.struct(
        F.lit(action).alias("action"), document(old).alias("old_data"),
        document(new).alias("new_data"), at.cast("timestamp_ntz").alias("changed_at"))


def _feed(rows: DataFrame, table: str, events: list[Column], by: str) -> DataFrame:
    """The events of all rows; one whose time is null does not happen."""
    each = rows.select(
        F.lit(table).alias("table_name"),
        F.col(RECORD_KEYS[table]).cast("string").alias("record_id"),
        F.inline(F.array(*events)))
    return each.where(F.col("changed_at").isNotNull()).select(
        "table_name", "record_id", "action", "old_data", "new_data",
        F.lit(by).alias("changed_by"), "changed_at")


def deal_changes(deals: DataFrame, purge_years: int = 5, by: str = "loader") -> DataFrame:
    closes = F.col("actual_close_date").isNotNull()
    opened = _image(
        deals, stage_id=F.when(closes, 5).otherwise(F.col("stage_id")),
        is_active=closes | F.col("is_active"),
        actual_close_date=F.lit(None).cast("date"))
    closed = _image(deals)
    months = 12 * purge_years
    later = F.add_months("actual_close_date", months)
    # the first day from which the close lies so many months back, also for the 29th of February
    purged = F.when(F.add_months(later, -months) < F.col("actual_close_date"),
                    F.date_add(later, 1)).otherwise(later)
    return _feed(deals, "deals", [
        _event("INSERT", F.col("created_at"), None, opened),
        _event("UPDATE", F.col("actual_close_date"), opened, closed),
        _event("DELETE", F.when(F.col("stage_id") == 7, purged), closed, None),
    ], by)


def signal_changes(signals: DataFrame, by: str = "loader") -> DataFrame:
    raised = _image(signals, resolved=F.lit(False))
    done = F.col("detected_at") + F.make_dt_interval(F.lit(RESOLVED_AFTER))
    return _feed(signals, "churn_signals", [
        _event("INSERT", F.col("detected_at"), None, raised),
        _event("UPDATE", F.when(F.col("resolved"), done), raised, _image(signals)),
    ], by)


def inserts(rows: DataFrame, table: str, at: Column, by: str = "loader") -> DataFrame:
    return _feed(rows, table, [_event("INSERT", at, None, _image(rows))], by)


def changes(m: Model, until: dt.date | None = None) -> DataFrame:
    """The feed of the four audited tables, up to the end of a day if one is given."""
    feed = functools.reduce(DataFrame.unionByName, [
        inserts(m.customers, "customers", moment(FOUNDED)),
        deal_changes(m.deals),
        inserts(m.revenue_records, "revenue_records", F.col("revenue_date")),
        signal_changes(m.churn_signals),
    ])
    if until is None:
        return feed
    return feed.where(F.col("changed_at").cast("date") <= F.lit(until))
