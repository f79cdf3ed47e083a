"""The past from the audit log: tables as they stood, and how long a deal was in its stage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealglass.functions.columns import moment

JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "mode": "FAILFAST"}


def from_image(document: Column, schema: StructType) -> Column:
    """A row from its JSON image; a null image gives null, a broken one an error."""
    return F.from_json(document, schema, JSON)


def _order() -> Column:
    """Place of a change among those of its record: by time, then by kind."""
    kind = F.when(F.col("action") == "INSERT", 0).when(F.col("action") == "UPDATE", 1).otherwise(2)
    return F.struct("changed_at", kind.alias("kind"), "new_data")


def replay(log: DataFrame, table: str, schema: StructType, at: dt.datetime) -> DataFrame:
    """The rows of an audited table as they stood at a time, that time included.

    The last image of each record counts, one partial row per record and task, so a record
    with very many changes does no harm; deleted records are gone.  Rows delivered again
    change nothing.  Of changes at the same time an update comes after the insert and before
    the delete, and of two updates the later image by text counts.
    """
    rows = log.where((F.col("table_name") == table) & (F.col("changed_at") <= moment(at)))
    last = rows.groupBy("record_id").agg(
        F.max_by(F.struct("action", "new_data"), _order()).alias("last"))
    held = last.where(F.col("last.action") != "DELETE")
    return held.select(from_image(F.col("last.new_data"), schema).alias("row")).select("row.*")


def stage_starts(log: DataFrame, deals: StructType) -> DataFrame:
    """When each deal came to a stage: deal_id, since, stage_id (null once it is deleted).

    Both images of a change are in its row, so a change that leaves the stage as it was is
    told without looking at the row before.
    """
    some = StructType([f for f in deals.fields if f.name in ("deal_id", "stage_id")])
    old, new = (from_image(F.col(c), some) for c in ("old_data", "new_data"))
    rows = log.where(F.col("table_name") == "deals").select(
        "changed_at", old.alias("old"), new.alias("new"))
    return rows.where(~F.col("old.stage_id").eqNullSafe(F.col("new.stage_id"))).select(
        F.coalesce("new.deal_id", "old.deal_id").alias("deal_id"),
        F.col("changed_at").alias("since"), F.col("new.stage_id").alias("stage_id"))


def as_of_join(
    probes: DataFrame, facts: DataFrame, key: str, at: str, since: str, unit: str = "month"
) -> DataFrame:
    """Each probe with the last fact of its key at or before its time, or nulls.

    Probes and facts are sorted together per key and ``unit`` of time, and each probe takes
    the last fact before it; what a unit inherits from earlier ones is found on one row per
    key and unit.  So the rows of a hot key are split by time, nothing is paired by range, and
    each row is shuffled once.  Of facts at the same time the greatest row counts.  Columns
    of the facts other than the key follow those of the probes.
    """
    values = [c for c in facts.columns if c != key]
    kinds = [F.lit(None).cast(facts.schema[c].dataType).alias(c) for c in values]
    fact = F.struct(F.col(since).alias("_at"), *[F.col(c) for c in values])
    row = F.struct(*[F.col(c) for c in probes.columns])
    none = F.lit(None).cast(facts.select(fact.alias("f")).schema["f"].dataType)
    left = probes.select(
        F.col(key).alias("_key"), F.col(at).alias("_time"), F.lit(1).alias("_side"),
        row.alias("_row"), none.alias("_fact"))
    right = facts.where(F.col(since).isNotNull()).select(
        F.col(key).alias("_key"), F.col(since).alias("_time"), F.lit(0).alias("_side"),
        F.lit(None).cast(left.schema["_row"].dataType).alias("_row"), fact.alias("_fact"))
    both = left.unionByName(right).withColumn("_unit", F.date_trunc(unit, "_time"))
    within = (
        Window.partitionBy("_key", "_unit").orderBy("_time", "_side", "_fact")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = both.withColumn("_here", F.last("_fact", ignorenulls=True).over(within))
    units = both.groupBy("_key", "_unit").agg(F.max("_fact").alias("_last"))
    before = Window.partitionBy("_key").orderBy("_unit").rowsBetween(
        Window.unboundedPreceding, -1)
    units = units.select(
        "_key", "_unit", F.last("_last", ignorenulls=True).over(before).alias("_earlier"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"u.{c}")) for c in ("_key", "_unit")]
    joined = found.where("_side = 1").alias("p").join(units.alias("u"), same, "left")
    best = F.coalesce(F.col("p._here"), F.col("u._earlier"))
    known = F.col("p._key").isNotNull() & F.col("p._time").isNotNull()
    return joined.select("p._row.*", F.when(known, best).alias("_fact")).select(
        *probes.columns,
        *[F.coalesce(F.col(f"_fact.{c}"), k).alias(c) for c, k in zip(values, kinds)])


def deal_stage_age(activities: DataFrame, log: DataFrame, deals: StructType) -> DataFrame:
    """For each activity the stage its deal was in at that time and the whole days in it.

    No stage and no age before the deal was made and once it is deleted.
    """
    placed = as_of_join(
        activities.select("activity_id", "deal_id", "activity_date"),
        stage_starts(log, deals), "deal_id", "activity_date", "since")
    in_stage = F.col("stage_id").isNotNull()
    return placed.select(
        "activity_id", "deal_id", "activity_date", "stage_id",
        F.when(in_stage, F.datediff("activity_date", "since")).alias("days_in_stage"))
