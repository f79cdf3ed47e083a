import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from dealglass.catalog import queries
from dealglass.catalog.oracle import all_sql
from dealglass.session import shared_folder
from dealglass.streaming import flows, run

ACTIVITY = ("activity_id int, deal_id string, activity_type string, activity_date timestamp_ntz, "
            "outcome string")
DAY0 = dt.datetime(2024, 1, 1, 15)


def day(n):
    return DAY0 + dt.timedelta(days=n)


@pytest.fixture
def feed(spark):
    """Writes batches of activities; each call adds one file set."""
    folder = shared_folder(spark, "test-feed")

    def add(*rows):
        spark.createDataFrame(
            [(i, deal, "Call", day(n), "Positive") for i, (deal, n) in enumerate(rows)], ACTIVITY
        ).coalesce(1).write.mode("append").parquet(f"{folder}/activities.parquet")

    return folder, add


def activities(session, folder):
    return run.read_stream(session, folder, "activities", ACTIVITY)


def test_gaps_become_signals(spark, feed):
    folder, add = feed
    session = run.stream_session(spark)
    out = shared_folder(spark, "test-inactivity")

    def signals():
        stream = flows.inactivity(activities(session, folder))
        rows = run.append_to(stream, out).collect()
        return sorted((r.deal_id, (r.detected_on - DAY0.date()).days) for r in rows)

    # a: 30 idle days are allowed, 31 are not; b: silent from day 0; z moves the clock
    add(("a", 0), ("a", 30), ("a", 61), ("b", 0), ("z", 62))
    assert signals() == [("a", 61), ("b", 31)]
    # the stream goes on from its checkpoint: nothing is reported twice
    add(("z", 95),)
    assert signals() == [("a", 61), ("a", 92), ("b", 31), ("z", 93)]


def test_days_close_with_the_watermark(spark, feed):
    folder, add = feed
    session = run.stream_session(spark)
    add(("a", 0), ("a", 0), ("b", 1), ("a", 3))
    out = run.append_to(
        flows.activity_daily(activities(session, folder)), shared_folder(spark, "test-daily"))
    rows = {(r.activity_day - DAY0.date()).days: r.activities for r in out.collect()}
    assert rows == {0: 2, 1: 1}                      # day 3 is still open


def test_months_are_upserted(spark):
    folder, out = shared_folder(spark, "test-revenue"), shared_folder(spark, "test-months")
    schema = ("revenue_id int, revenue_type string, amount decimal(15,2), revenue_date date, "
              "mrr_contribution decimal(15,2), arr_contribution decimal(15,2)")
    session = run.stream_session(spark)

    def load(*rows):
        from decimal import Decimal as D

        spark.createDataFrame(
            [(i, "Renewal", D(v), dt.date(2024, m, 5), D(0), D(0))
             for i, (m, v) in enumerate(rows)], schema
        ).write.mode("append").parquet(f"{folder}/revenue.parquet")
        stream = flows.monthly_revenue(run.read_stream(session, folder, "revenue", schema))
        table = run.upsert_by(stream, "revenue_month", out)
        return {r.revenue_month.month: int(r.total_revenue) for r in table.collect()}

    assert load((1, 10), (2, 20)) == {1: 10, 2: 20}
    assert load((1, 5), (3, 7)) == {1: 15, 2: 20, 3: 7}      # a late record reaches its month


def test_redelivered_records_are_audited_once(spark):
    folder = shared_folder(spark, "test-audit")
    schema = "signal_id int, customer_id int, detected_at timestamp_ntz"
    rows = [(1, 5, day(0)), (1, 5, day(0)), (2, None, day(0))]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/signals.parquet")
    session = run.stream_session(spark)
    out = shared_folder(spark, "test-audit-out")

    def audited():
        feed = run.read_stream(session, folder, "signals", schema)
        stream = flows.audit_changes(flows.inserted(feed, "churn_signals", "detected_at", "me"))
        return run.append_new_to(stream, out, "log_id", "changed_day")

    got = audited()
    assert sorted(r.record_id for r in got.collect()) == ["1", "2"]
    two = got.where(F.col("record_id") == "2").first()
    assert '"customer_id":null' in two.new_data
    # a later batch: one row delivered again, one older than all before, one new
    more = [(1, 5, day(0)), (3, 6, day(-30)), (4, 6, day(2))]
    spark.createDataFrame(more, schema).write.mode("append").parquet(f"{folder}/signals.parquet")
    assert sorted(r.record_id for r in audited().collect()) == ["1", "2", "3", "4"]


def test_audit_keeps_all_kinds_of_changes(spark):
    folder = shared_folder(spark, "test-changes")
    schema = ("table_name string, record_id string, action string, old_data string, "
              "new_data string, changed_by string, changed_at timestamp_ntz")
    rows = [("deals", "1", "INSERT", None, "{}", "me", day(0)),
            ("deals", "1", "UPDATE", "{}", '{"a":1}', "me", day(1)),
            ("deals", "1", "UPDATE", '{"a":1}', '{"a":2}', "me", day(1)),
            ("deals", "1", "DELETE", '{"a":2}', None, "me", day(2))]
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/changes.parquet")
    session = run.stream_session(spark)
    feed = run.read_stream(session, folder, "changes", schema, files_per_batch=1)
    got = run.append_new_to(
        flows.audit_changes(feed), shared_folder(spark, "test-changes-out"), "log_id",
        "changed_day")
    assert sorted((r.action, r.old_data, r.new_data) for r in got.collect() if r.old_data) == [
        ("DELETE", '{"a":2}', None), ("UPDATE", '{"a":1}', '{"a":2}'), ("UPDATE", "{}", '{"a":1}')]
    assert got.count() == 4


def test_late_rows_are_told(spark, feed):
    folder, add = feed
    session = run.stream_session(spark)
    out, late = shared_folder(spark, "test-late"), []
    for rows in ([("a", 40)], [("b", 50)], [("a", 3)]):
        add(*rows)
        run.append_to(flows.activity_daily(activities(session, folder)), out, late.append)
    assert late == [0, 0, 1]


def test_one_batch_or_many(spark, feed):
    folder, add = feed
    session = run.stream_session(spark)
    for n in (0, 10, 45, 46, 100):
        add(("a", n), ("b", 2 * n))
    results = []
    for files in (1, 1000):
        stream = flows.inactivity(
            run.read_stream(session, folder, "activities", ACTIVITY, files), delay="365 days")
        results.append(sorted(map(str, run.append_to(
            stream, shared_folder(spark, "test-batches")).collect())))
    assert results[0] == results[1]


def test_inactivity_of_a_deal_with_an_open_signal(spark):
    signals = spark.createDataFrame([("d1",), ("d2",), ("d3",), ("d9",)], "deal_id string")
    deals = spark.createDataFrame(
        [("d1", "c1"), ("d2", "c2"), ("d3", "c3")], "deal_id string, customer_id string")
    held = spark.createDataFrame(
        [("d1", "No Activity", False), ("d1", "No Activity", False), ("d2", "No Activity", True),
         ("d3", "Downgrade Request", False)],
        "deal_id string, signal_type string, resolved boolean")
    got = flows.guarded(signals, deals, held).collect()
    assert sorted((r.deal_id, r.customer_id) for r in got) == [("d2", "c2"), ("d3", "c3")]


@pytest.mark.parametrize("name", ["stream_inactivity", "stream_activity_daily"])
def test_registered_streams_do_not_depend_on_batches(spark, monkeypatch, name):
    """Lines in files of no date order, one file per batch, against the SQL on all of them."""
    source = "/root/testdata/sf0.001"
    folder = shared_folder(spark, "test-cuts")
    for table in ("customer", "orders", "part", "events", "nation", "region", "supplier"):
        spark.read.parquet(f"{source}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    newest_first = lines.repartitionByRange(4, F.col("l_shipdate").desc()).cache()
    for part in range(4):
        newest_first.where(F.spark_partition_id() == part).coalesce(1).write.mode("append").parquet(
            f"{folder}/lineitem.parquet")
    monkeypatch.setattr(queries, "FILES_PER_BATCH", 1)
    assert differences(queries.all_queries()[name](spark, folder), duck(source), all_sql()[name]) == []


def test_repeated_batches_and_late_files_are_summed_once(spark, feed):
    folder, add = feed
    session, out = run.stream_session(spark), shared_folder(spark, "test-sums")

    def signals():
        stream = flows.touches(activities(session, folder))
        per_day = run.sum_to(stream, out, ["deal_id", "activity_day"])
        rows = flows.gaps(per_day).collect()
        return sorted((r.deal_id, (r.detected_on - DAY0.date()).days, r.activities) for r in rows)

    add(("a", 0), ("a", 40), ("z", 80))
    assert signals() == [("a", 31, 1), ("a", 71, 1)]
    add(("a", 20), ("a", 40))                        # late: fills the first gap
    assert signals() == [("a", 71, 4)]


def test_late_rows_of_all_batches_are_told(spark, feed):
    folder, add = feed
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        session = run.stream_session(spark)
        session.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
        for n in (200, 100, 90, 80, 70, 60):
            add(("a", n))
        late = []
        stream = flows.activity_daily(
            run.read_stream(session, folder, "activities", ACTIVITY, 1))
        run.append_to(stream, shared_folder(spark, "test-late-all"), late.append)
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert late == [4]  # rows are compared with the watermark before the last batch


def test_stream_sessions_carry_the_settings_of_the_caller(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(key, "12345")
    try:
        session = run.stream_session(spark)
    finally:
        spark.conf.unset(key)
    assert session.conf.get(key) == "12345" and spark.conf.get(key) != "12345"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in session.conf.get("spark.sql.streaming.stateStore.providerClass")
