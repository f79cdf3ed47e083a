"""Every registered query: name to a function of (spark, folder of tables)."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealglass import views
from dealglass.catalog import primitives
from dealglass.model import UNIQUE_KEYS, Model
from dealglass.operators import (
    changes, cohorts, customers, history, pipeline, quality, rejects, reps, revenue, upsell)
from dealglass.session import shared_folder
from dealglass.sources import history as history_feed
from dealglass.sources import layout, orders, tables
from dealglass.streaming import deltas, flows, idle, pending, run

Query = Callable[[SparkSession, str], DataFrame]
ModelQuery = Callable[[Model, dt.date], DataFrame]

# Annual-revenue limits of the low/mid/high bands on these tables.
BANDS = (3000, 7000)
RUN_AT = dt.datetime(2001, 6, 1)
SNAPSHOT_BEFORE = dt.date(2000, 1, 1)
# The ends of the days that the audit log is replayed to.
REPLAY_AT = {
    "customers": dt.datetime(2000, 1, 1, 23, 59, 59),
    "deals": dt.datetime(2000, 1, 1, 23, 59, 59),
    "revenue_records": dt.datetime(2000, 1, 1, 23, 59, 59),
    "churn_signals": dt.datetime(2024, 2, 14, 23, 59, 59),
}
SIGNALS_BEFORE = dt.datetime(2024, 1, 15)


def plain(df: DataFrame) -> DataFrame:
    """Engine-neutral column types, so two engines can compare results exactly:
    whole numbers as bigint, decimals as double, dates and times as text."""
    out = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            col = col.cast("bigint")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            col = F.date_format(col.cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss")
        out.append(col.alias(field.name))
    return df.select(*out)


ANALYTICS: dict[str, ModelQuery] = {
    "pipeline_summary": pipeline.pipeline_summary,
    "deal_risk_scores": pipeline.deal_risk_scores,
    "revenue_by_month": lambda m, d: revenue.revenue_by_month(m),
    "rep_performance": reps.rep_performance,
    "rep_performance_asis": lambda m, d: reps.rep_performance(m, d, fan_out=True),
    "customer_health": customers.customer_health,
    "customer_health_asis": lambda m, d: customers.customer_health(m, d, fan_out=True),
    "monthly_revenue_summary": lambda m, d: revenue.monthly_revenue_summary(m),
    "pipeline_health": pipeline.pipeline_health,
    "customer_segments": lambda m, d: customers.customer_segments(m),
    "customer_segments_asis": lambda m, d: customers.customer_segments(m, fan_out=True),
    "deal_health_score": pipeline.deal_health_score,
    "revenue_forecast": revenue.revenue_forecast,
    "customer_lifetime_value": customers.customer_lifetime_value,
    "customer_lifetime_value_asis": lambda m, d: customers.customer_lifetime_value(
        m, d, fan_out=True),
    "pipeline_scoring": pipeline.pipeline_scoring,
    "funnel_velocity": pipeline.funnel_velocity,
    "rep_forecast": revenue.rep_forecast,
    "mrr_trend": lambda m, d: revenue.mrr_trend(m),
    "cohort_analysis": lambda m, d: cohorts.cohort_analysis(m),
    "churn_risk_ranking": customers.churn_risk_ranking,
    "win_loss": lambda m, d: pipeline.win_loss(m),
    "rep_leaderboard": reps.rep_leaderboard,
    "upsell_opportunities": lambda m, d: upsell.upsell_opportunities(m),
    "owned_products": lambda m, d: upsell.owned_products(m),
    "revenue_anomalies": lambda m, d: revenue.revenue_anomalies(m),
    "customer_segmentation": customers.customer_segmentation,
    "cohort_table": lambda m, d: cohorts.cohort_table(m, BANDS),
    "cohort_table_thirds": lambda m, d: cohorts.cohort_table(m),
    "customer_tiles": customers.customer_tiles,
    "forecast_accuracy": lambda m, d: revenue.forecast_accuracy(m),
    "derive_mrr_arr": lambda m, d: m.revenue_records.select(
        "revenue_id", "billing_period", "amount", "mrr_contribution", "arr_contribution"),
    "audit_log_diff": lambda m, d: changes.audit_log_diff(
        orders.deals_as_of(m, SNAPSHOT_BEFORE), orders.deals_as_of(m, d), "deals", "loader",
        RUN_AT),
    "detect_inactivity": lambda m, d: changes.detect_inactivity(m, d, RUN_AT),
    "scan_customers": lambda m, d: m.customers,
    "dq_domain": lambda m, d: quality.check_domains(m),
    "dq_range": lambda m, d: quality.check_ranges(
        m, {("customers", "annual_revenue"): "annual_revenue >= 0"}),
    "dq_length": lambda m, d: quality.check_lengths(m),
    "dq_not_null": lambda m, d: quality.check_not_null(m),
    "dq_unique": lambda m, d: quality.check_unique(m, more={
        "customers": [["company_name"]],
        "deals": [["customer_id", "created_at"]],
        "deal_products": [["deal_id", "product_id"]],
        "forecasts": [["assigned_rep", "forecast_month"]],
    }, results={
        "monthly_revenue_summary": (revenue.monthly_revenue_summary(m), ["revenue_month"]),
        "pipeline_health": (pipeline.pipeline_health(m, d), ["stage_name"]),
        "customer_segments": (
            customers.customer_segments(m), ["customer_tier", "industry", "country"]),
    }),
    "dq_orphans": lambda m, d: quality.check_orphans(m),
    "dq_deal_customer": lambda m, d: quality.check_deal_customer(m),
}

PRIMITIVES: dict[str, ModelQuery] = {
    f.__name__: f
    for f in (
        primitives.load_stages, primitives.resolve_keys, primitives.apply_defaults,
        primitives.line_total, primitives.filter_active, primitives.filter_close_window,
        primitives.filter_risk_levels, primitives.join_inner, primitives.join_left,
        primitives.join_left_residual, primitives.join_cross, primitives.join_anti,
        primitives.join_semi, primitives.agg_basic, primitives.agg_conditional,
        primitives.agg_count_distinct, primitives.agg_weighted, primitives.agg_string_distinct,
        primitives.agg_ratio, primitives.window_lag_global, primitives.window_lag_partition,
        primitives.window_running_sum, primitives.window_share, primitives.window_rank,
        primitives.sort_nulls, primitives.scalar_nulls, primitives.scalar_round,
        primitives.scalar_dates, primitives.scalar_casts, primitives.scalar_strings,
        primitives.stable_ids,
    )
}


def scalar_json(spark: SparkSession, folder: str) -> DataFrame:
    """A field of a JSON document, by path and through a variant value."""
    events = orders.read(spark, folder, "events")
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.variant_get(F.parse_json("props"), "$.k", "int").alias("k_number"),
        F.get_json_object("props", "$.missing").alias("missing"),
    )


def mv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly summary written as a table and read back."""
    summary = revenue.monthly_revenue_summary(orders.model(spark, folder))
    return tables.materialize(summary, shared_folder(spark, "monthly-summary"))


FILES_PER_BATCH = 1000


def _feed(session: SparkSession, folder: str, table: str) -> DataFrame:
    return run.read_stream(session, folder, table, orders.FILE_SCHEMAS[table], FILES_PER_BATCH)


def _changes(m: Model) -> DataFrame:
    """Changes of the four audited tables from an earlier state to the given one."""
    day = F.lit(SNAPSHOT_BEFORE)
    signals, records = m.churn_signals, m.revenue_records
    earlier = {
        "customers": m.customers.where(F.lit(False)),
        "deals": orders.deals_as_of(m, SNAPSHOT_BEFORE),
        "revenue_records": records.where(F.col("revenue_date") <= day),
        "churn_signals": signals.where(F.col("detected_at") < F.lit(SIGNALS_BEFORE)).withColumn(
            "resolved", F.lit(False)),
    }
    now = {**m.tables(), "deals": orders.deals_as_of(m, orders.AS_OF)}
    each = [
        changes.audit_log_diff(before, now[table], table, "loader", RUN_AT).drop("log_id")
        for table, before in earlier.items()]
    return functools.reduce(DataFrame.unionByName, each)


def stream_audit(spark: SparkSession, folder: str) -> DataFrame:
    """A change feed of four tables, delivered twice, into the audit table."""
    session = run.stream_session(spark)
    feed = shared_folder(spark, "change-feed")
    found = _changes(orders.model(session, folder))
    for _ in range(2):
        found.write.mode("append").parquet(f"{feed}/changes.parquet")
    changed = run.read_stream(session, feed, "changes", found.schema)
    table = run.append_new_to(
        flows.audit_changes(changed), shared_folder(spark, "stream-audit"), "log_id",
        "changed_day")
    return table.drop("changed_day")


def inactivity_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Activities to signals to audit rows, appended to stored tables in two runs."""
    m = orders.model(spark, folder)
    signals, audit = shared_folder(spark, "signals"), shared_folder(spark, "signal-audit")
    for _ in range(2):
        tables.append(
            changes.detect_inactivity(m, orders.AS_OF, RUN_AT), signals, ["signal_id"])
        stored = spark.read.parquet(signals)
        found = flows.audit_changes(
            flows.inserted(stored, "churn_signals", "detected_at", "loader"))
        tables.append(found, audit, ["log_id"], ["changed_day"])
    return spark.read.schema(found.schema).parquet(audit).drop("changed_day")


def _revenue_feed(session: SparkSession, folder: str) -> DataFrame:
    return orders.revenue_records(_feed(session, folder, "orders"))


def stream_monthly_revenue(spark: SparkSession, folder: str) -> DataFrame:
    session = run.stream_session(spark)
    records = _revenue_feed(session, folder)
    totals = run.upsert_by(
        flows.monthly_revenue(records), "revenue_month", shared_folder(spark, "stream-monthly"))
    payers = flows.paying_customers(_payer_bits(spark, records))
    both = totals.join(payers, "revenue_month", "left").withColumn(
        "paying_customers", F.coalesce("paying_customers", F.lit(0)))
    return revenue.with_month_over_month(both)


def _payer_bits(spark: SparkSession, records: DataFrame) -> DataFrame:
    return run.merge_to(
        flows.payers(records), shared_folder(spark, "stream-payers"), flows.payer_bits,
        flows.same_bits)


def stream_quarter_payers(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct payers per quarter, merged from the bitmaps of the months."""
    records = _revenue_feed(run.stream_session(spark), folder)
    return flows.paying_customers(_payer_bits(spark, records), "quarter")


def _audit(
    spark: SparkSession, session: SparkSession, folder: str, *names: str
) -> tuple[Model, DataFrame]:
    """The model, and the audit table of the changes of some tables up to ``AS_OF`` as a stream.

    The feed comes in two files, with a row in three delivered again in the second.
    """
    m = orders.model(session, folder)
    feed = shared_folder(spark, "history-feed")
    found = history_feed.changes(m, orders.AS_OF).where(F.col("table_name").isin(*names))
    found.write.parquet(f"{feed}/changes.parquet")
    again = F.pmod(F.xxhash64("table_name", "record_id", "action"), F.lit(3)) == 0
    found.where(again).write.mode("append").parquet(f"{feed}/changes.parquet")
    changed = run.read_stream(session, feed, "changes", found.schema)
    rows = flows.audit_changes(changed).withColumn(
        "changed_month", F.trunc("changed_day", "MM")).drop("changed_day")
    out = shared_folder(spark, "history-audit")
    run.append_new_to(rows, out, "log_id", "changed_month")
    return m, run.table_stream(session, out, rows.schema)


def stream_pipeline_health(spark: SparkSession, folder: str) -> DataFrame:
    """Pipeline health kept up to date by signed changes of deals."""
    session = run.stream_session(spark)
    m, feed = _audit(spark, session, folder, "deals")
    sums = run.sum_to(
        deltas.stage_sums(feed, m.deals.schema, orders.AS_OF),
        shared_folder(spark, "stage-sums"), ["stage_id"])
    return deltas.pipeline_health(m, sums)


def stream_customer_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Customer segments kept up to date by signed changes of three tables."""
    session = run.stream_session(spark)
    m, feed = _audit(spark, session, folder, "customers", "deals", "revenue_records")

    def summed(rows: DataFrame, keys: list[str]) -> DataFrame:
        return run.sum_to(rows, shared_folder(spark, "segment-sums"), keys)

    return deltas.customer_segments(
        summed(deltas.customer_images(feed, m.customers.schema), deltas.ATTRIBUTES),
        summed(deltas.deal_sums(feed, m.deals.schema, m), ["customer_id"]),
        summed(deltas.revenue_sums(feed, m.revenue_records.schema), ["customer_id"]))


def stream_cohort_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Customers by month of their first deal that is not deleted, from an index of days."""
    session = run.stream_session(spark)
    m, feed = _audit(spark, session, folder, "deals")
    index = run.sum_to(
        deltas.deal_days(feed, m.deals.schema),
        shared_folder(spark, "deal-days"), ["customer_id", "deal_day"])
    return deltas.cohort_sizes(index)


def deal_stage_age(m: Model, as_of: dt.date) -> DataFrame:
    """Stage and days in it at each activity, from the log of changes."""
    return history.deal_stage_age(
        m.activities, history_feed.deal_changes(m.deals), m.deals.schema)


def _replayed(table: str) -> ModelQuery:
    def query(m: Model, as_of: dt.date) -> DataFrame:
        rows = m.tables()[table]
        return history.replay(history_feed.changes(m), table, rows.schema, REPLAY_AT[table])

    return query


def stream_inactivity(spark: SparkSession, folder: str) -> DataFrame:
    session = run.stream_session(spark)
    touches = orders.activities(_feed(session, folder, "lineitem"))
    found = idle.signals(touches, shared_folder(spark, "stream-inactivity"))
    m = orders.model(session, folder)
    return flows.guarded(found, m.deals, m.churn_signals)


def stream_activity_daily(spark: SparkSession, folder: str) -> DataFrame:
    session = run.stream_session(spark)
    touches = orders.activities(_feed(session, folder, "lineitem"))
    per_day = run.sum_to(
        flows.typed(touches), shared_folder(spark, "stream-daily"),
        ["activity_day", "activity_type"])
    return flows.closed_days(per_day)


def stream_daily_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Activities per day and type in three batches: those on time, and those that were late."""
    session = run.stream_session(spark)
    feed, out = shared_folder(spark, "thirds"), shared_folder(spark, "daily-windows")
    lines = orders.read(spark, folder, "lineitem")
    keys = ["activity_day", "activity_type"]

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("activities").alias("on_time"))

    def again(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.sum("on_time").alias("on_time"))

    for third in range(3):  # one delivery after the other, in as many files as it was written by
        part = lines.where(F.pmod("l_orderkey", F.lit(3)) == third)
        part.write.mode("append").parquet(f"{feed}/lineitem.parquet")
        stream = run.read_stream(session, feed, "lineitem", orders.FILE_SCHEMAS["lineitem"], None)
        merged, late = run.merge_on_time(
            flows.typed(orders.activities(stream)), out, "activity_day", summed, again)
    too_late = late.groupBy(*keys).agg(F.sum("activities").alias("late"))
    both = merged.join(too_late, keys, "full_outer")
    return both.select(*keys, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("on_time", "late")])


def stream_pending_signals(spark: SparkSession, folder: str) -> DataFrame:
    """Signals that come before half of the deals: resolved later, or reported without a deal."""
    session = run.stream_session(spark)
    m = orders.model(session, folder)
    signals = orders.churn_signals(_feed(session, folder, "events"))
    out = shared_folder(spark, "pending")
    pending.resolve(signals, lambda: m.deals.where("deal_id % 2 = 0"), out, "deal_id")
    for _ in range(pending.PATIENCE - 1):
        found = pending.settle(session, signals.schema, lambda: m.deals, out, "deal_id")
    return found.resolved.select("signal_id", "deal_id", F.lit("resolved").alias("state")).unionByName(
        found.orphans.select("signal_id", "deal_id", F.lit("orphan").alias("state")))


def _stored(query: ModelQuery) -> ModelQuery:
    def over_stored(m: Model, as_of: dt.date) -> DataFrame:
        folder = shared_folder(m.deals.sparkSession, "layout")
        return query(layout.stored(m, folder, buckets=8), as_of)

    return over_stored


def _called(call: str) -> Query:
    """A table function by its SQL name, in a session of its own."""
    def query(spark: SparkSession, folder: str) -> DataFrame:
        session = spark.newSession()
        session.conf.set("spark.sql.session.timeZone", "UTC")
        views.register(orders.model(session, folder), orders.AS_OF)
        return session.sql(f"SELECT * FROM {call}")

    return query


CALLS = {
    "sql_deal_health_score": _called("get_deal_health_score(17)"),
    "sql_customer_lifetime_value": _called("get_customer_lifetime_value(17)"),
    "sql_revenue_forecast": _called("get_revenue_forecast()"),
    "sql_revenue_forecast_6": _called("get_revenue_forecast(6)"),
}
MORE_RANGES = {
    ("customers", "annual_revenue"): "annual_revenue >= 0",
    ("deals", "days_in_stage"): "days_in_stage <= 60",
}
SPLIT = ["customers", "deals", "products", "revenue_records", "churn_signals"]


def _splits(m: Model) -> dict[str, rejects.Split]:
    folder = shared_folder(m.deals.sparkSession, "split")
    return {t: rejects.split(m.tables()[t], t, f"{folder}/{t}", MORE_RANGES) for t in SPLIT}


def dq_rejects(m: Model, as_of: dt.date) -> DataFrame:
    """Rejected rows of five tables by their key, with the rules they break."""
    return functools.reduce(DataFrame.unionByName, [
        found.rejected.select(
            F.lit(table).alias("table_name"),
            F.col(UNIQUE_KEYS[table][0][0]).cast("string").alias("record_id"),
            F.array_join("reasons", "; ").alias("reasons"))
        for table, found in _splits(m).items()])


def dq_split(m: Model, as_of: dt.date) -> DataFrame:
    """Rows read, good and rejected per table: read and rejected as observed, good as stored."""
    return functools.reduce(DataFrame.unionByName, [
        found.good.agg(
            F.lit(table).alias("table_name"), F.lit(found.rows).alias("rows_read"),
            F.count(F.lit(1)).alias("good_rows"),
            F.lit(found.rejected_rows).alias("rejected_rows"))
        for table, found in _splits(m).items()])


OTHERS: dict[str, Query] = {
    f.__name__: f
    for f in (
        scalar_json, mv_roundtrip, inactivity_audit, stream_audit, stream_monthly_revenue,
        stream_quarter_payers, stream_inactivity, stream_activity_daily, stream_pipeline_health,
        stream_customer_segments, stream_cohort_sizes, stream_daily_windows,
        stream_pending_signals,
    )
}
HISTORY: dict[str, ModelQuery] = {
    "deal_stage_age": deal_stage_age,
    "stored_rep_forecast": _stored(revenue.rep_forecast),
    "stored_revenue_forecast": _stored(revenue.revenue_forecast),
    "stored_customer_segments": _stored(lambda m, d: customers.customer_segments(m)),
    "dq_rejects": dq_rejects,
    "dq_split": dq_split,
    **{f"audit_replay_{table}": _replayed(table) for table in REPLAY_AT},
}


def _over_model(query: ModelQuery) -> Query:
    return lambda spark, folder: plain(query(orders.model(spark, folder), orders.AS_OF))


def _over_files(query: Query) -> Query:
    return lambda spark, folder: plain(query(spark, folder))


def all_queries() -> dict[str, Query]:
    named = {name: _over_model(q) for name, q in {**ANALYTICS, **PRIMITIVES, **HISTORY}.items()}
    named.update({name: _over_files(q) for name, q in {**OTHERS, **CALLS}.items()})
    return named
