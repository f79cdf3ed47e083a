"""Replay, as-of lookups and results refreshed by signed changes, against recomputation."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from dealglass.model import Model
from dealglass.operators import customers, history, pipeline
from dealglass.operators.changes import as_json
from dealglass.session import shared_folder
from dealglass.sources import history as feed
from dealglass.sources import orders, tables
from dealglass.streaming import deltas, flows, run

T0 = dt.datetime(2024, 1, 1)
FOLDER = "/root/testdata/sf0.001"


def at(days, hours=0):
    return T0 + dt.timedelta(days=days, hours=hours)


# ------------------------------------------------------------------ as-of join

def brute_as_of(probes, facts):
    out = []
    for n, key, t in probes:
        found = [(s, v) for k, s, v in facts if k == key and key is not None
                 and s is not None and t is not None and s <= t]
        best = max(found, key=lambda f: (f[0], f[1] is not None, f[1] or ""), default=(None, None))
        out.append((n, key, t, *best))
    return sorted(out, key=str)


@pytest.mark.parametrize("unit", ["month", "day", "year"])
def test_as_of_join(spark, unit):
    rng = random.Random(unit)
    keys = ["a", "b", "hot", "none", None]
    probes = [(n, rng.choice(keys), rng.choice([None, at(rng.randrange(120), rng.randrange(3))]))
              for n in range(60)]
    probes += [(100 + n, "hot", at(n % 110)) for n in range(80)]
    facts = [(rng.choice(["a", "b", "hot", "lone", None]), at(rng.randrange(120)),
              rng.choice([None, f"v{n}"])) for n in range(40)] + [("a", None, "x")]
    left = spark.createDataFrame(probes, "n int, k string, t timestamp_ntz")
    right = spark.createDataFrame(facts, "k string, since timestamp_ntz, v string")
    got = history.as_of_join(left, right, "k", "t", "since", unit)
    assert got.columns == ["n", "k", "t", "since", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_as_of(probes, facts)


def test_as_of_join_splits_a_hot_key_and_pairs_nothing(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = spark.range(12_000).select(
            F.lit("hot").alias("k"),
            (F.lit(T0) + F.make_dt_interval((F.col("id") % 1200).cast("int"))).cast(
                "timestamp_ntz").alias("t"))
        facts = days.select("k", F.col("t").alias("since")).where("day(t) = 1").distinct()
        found = history.as_of_join(days, facts, "k", "t", "since")
        found.explain()
        plan = capsys.readouterr().out
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        sizes = [r.n for r in days.groupBy(F.date_trunc("month", "t")).agg(
            F.count("*").alias("n")).collect()]
        assert max(sizes) < 320 and found.count() == 12_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# ------------------------------------------------------------------ replay

DEAL = ("deal_id int, customer_id int, stage_id int, deal_value decimal(15,2), "
        "expected_close_date date, created_at timestamp_ntz, deal_source string, "
        "days_in_stage int, is_active boolean")
SOURCES = ["Inbound", "Outbound", "Referral", "Partner", "Renewal", None]


def some_deal(rng, key):
    stage = rng.randrange(1, 8)
    return (key, rng.randrange(6), stage, D(rng.randrange(100, 9999)).scaleb(-2),
            rng.choice([None, dt.date(2024, rng.randrange(1, 13), 5)]), at(rng.randrange(200)),
            rng.choice(SOURCES), rng.choice([None, rng.randrange(60)]), stage < 6)


def random_changes(rng, n=120):
    """(record, action, old, new, time) of a table with inserts, updates and deletes."""
    held, out = {}, []
    for k in range(n):
        key = rng.randrange(25)
        old = held.get(key)
        if old is None:
            held[key] = some_deal(rng, key)
            out.append((key, "INSERT", None, held[key], at(k)))
        elif rng.random() < 0.3:
            del held[key]
            out.append((key, "DELETE", old, None, at(k)))
        else:
            held[key] = some_deal(rng, key)
            out.append((key, "UPDATE", old, held[key], at(k)))
    return out


def log_of(spark, found):
    schema = (f"record_id int, action string, old struct<{DEAL}>, "
              f"new struct<{DEAL}>, changed_at timestamp_ntz")
    rows = spark.createDataFrame(found, schema)
    return rows.select(
        F.lit("deals").alias("table_name"), F.col("record_id").cast("string"), "action",
        as_json(F.col("old")).alias("old_data"), as_json(F.col("new")).alias("new_data"),
        F.lit("me").alias("changed_by"), "changed_at")


def states(found, until):
    held = {}
    for key, _, _, new, when in found:
        if when <= until:
            held[key] = new
    return sorted(map(str, (v for v in held.values() if v is not None)))


def schema_of(spark):
    return spark.createDataFrame([], DEAL).schema


def test_replay_to_any_day(spark):
    found = random_changes(random.Random(1))
    log = log_of(spark, found + found[::3])  # some rows are delivered again
    for day in (0, 17, 60, 119, 500):
        got = history.replay(log, "deals", schema_of(spark), at(day))
        assert sorted(str(tuple(r)) for r in got.collect()) == states(found, at(day))


def test_replay_of_changes_at_one_time(spark):
    a, b = (some_deal(random.Random(k), 1) for k in (1, 2))
    same = [(1, "UPDATE", a, b, T0), (1, "INSERT", None, a, T0), (2, "DELETE", a, None, T0),
            (2, "INSERT", None, a, T0)]
    got = history.replay(log_of(spark, same), "deals", schema_of(spark), T0).collect()
    assert [tuple(r) for r in got] == [b]


def test_feed_equals_snapshots(spark):
    m = orders.model(spark, FOLDER)
    log = feed.deal_changes(m.deals)
    for day in (dt.date(1996, 2, 29), dt.date(2000, 1, 1), dt.date(2001, 2, 28), dt.date(2003, 7, 7)):
        end = dt.datetime.combine(day, dt.time(23, 59, 59))
        got = history.replay(log, "deals", m.deals.schema, end)
        want = orders.deals_as_of(m, day).select(*got.columns)
        assert got.exceptAll(want).count() == 0 == want.exceptAll(got).count()


# ------------------------------------------------------------------ refreshed results

STAGES = [(1, "A", 1, D(10), False, False), (6, "Won", 6, D(100), True, True),
          (7, "Lost", 7, D(0), True, False)] + [
    (k, f"S{k}", k, D(50), False, False) for k in (2, 3, 4, 5)]


def stage_table(spark):
    return spark.createDataFrame(
        STAGES, "stage_id int, stage_name string, stage_order int, probability decimal(5,2), "
        "is_closed boolean, is_won boolean")


@pytest.fixture
def audited(spark):
    """A change feed in shuffled files of a few rows, and the deals at its end."""
    rng = random.Random(8)
    found = random_changes(rng, 160)
    folder = shared_folder(spark, "test-deltas")
    mixed = rng.sample(found, len(found))
    for k in range(0, len(mixed), 40):
        log_of(spark, mixed[k:k + 40]).coalesce(1).write.mode("append").parquet(
            f"{folder}/changes.parquet")
    held = {}
    for key, _, _, new, _ in found:
        held[key] = new
    deals = spark.createDataFrame([v for v in held.values() if v], DEAL)
    session = run.stream_session(spark)

    def stream():
        return run.read_stream(session, folder, "changes", log_of(spark, found[:1]).schema, 1)

    return stream, deals


def test_pipeline_health_by_changes(spark, audited):
    stream, deals = audited
    m = Model(deal_stages=stage_table(spark), deals=deals)
    as_of = dt.date(2024, 6, 1)
    for compact in (2, 100):
        sums = run.sum_to(
            deltas.stage_sums(stream(), deals.schema, as_of), shared_folder(spark, "t-stages"),
            ["stage_id"], compact)
        got = deltas.pipeline_health(m, sums)
        want = pipeline.pipeline_health(m, as_of)
        assert got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_first_deals_by_index(spark, audited):
    stream, deals = audited
    index = run.sum_to(deltas.deal_days(stream(), deals.schema), shared_folder(spark, "t-index"),
                       ["customer_id", "deal_day"], 3)
    got = {r.customer_id: r.first_deal_date for r in deltas.first_deals(index).collect()}
    want = deals.groupBy("customer_id").agg(F.min(F.to_date("created_at")).alias("d")).collect()
    assert got == {r.customer_id: r.d for r in want}


def test_segments_by_changes(spark, audited):
    stream, deals = audited
    rows = [(k, "SMB" if k % 2 else None, "x", "US", "Churned" if k == 3 else "Active")
            for k in range(7)]
    people = spark.createDataFrame(rows, "customer_id int, customer_tier string, industry string, "
                                         "country string, status string")
    moved = people.withColumn("industry", F.lit("before"))
    kinds = "revenue_id int, customer_id int, revenue_type string, amount decimal(15,2), " \
            "revenue_date date, payment_status string, mrr_contribution decimal(15,2), " \
            "arr_contribution decimal(15,2)"
    bills = spark.createDataFrame(
        [(k, k % 4, "Renewal", D(5), dt.date(2024, 1, 2), "Paid", D(k), None if k == 2 else D(k))
         for k in range(9)], kinds)
    m = Model(deal_stages=stage_table(spark), deals=deals, customers=people, revenue_records=bills)

    def document(df):
        return as_json(F.struct(*df.columns))

    joined = people.select("customer_id", document(people).alias("new_data")).join(
        moved.select("customer_id", document(moved).alias("old_data")), "customer_id")
    first = moved.select("customer_id", document(moved).alias("new_data"),
                         F.lit(None).cast("string").alias("old_data"))
    of_people = joined.unionByName(first).select(F.lit("customers").alias("table_name"), "old_data", "new_data")
    of_bills = bills.select(F.lit("revenue_records").alias("table_name"),
                            F.lit(None).cast("string").alias("old_data"),
                            document(bills).alias("new_data"))
    folder = shared_folder(spark, "test-segments")
    of_people.unionByName(of_bills).repartition(3).write.parquet(f"{folder}/more.parquet")
    session = run.stream_session(spark)

    def more():
        return run.read_stream(session, folder, "more", of_people.schema, 1)

    got = deltas.customer_segments(
        run.sum_to(deltas.customer_images(more(), people.schema), shared_folder(spark, "t-c"),
                   deltas.ATTRIBUTES),
        run.sum_to(deltas.deal_sums(stream(), deals.schema, m), shared_folder(spark, "t-d"),
                   ["customer_id"], 2),
        run.sum_to(deltas.revenue_sums(more(), bills.schema), shared_folder(spark, "t-r"),
                   ["customer_id"]))
    want = customers.customer_segments(m)
    assert got.dtypes == want.dtypes
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_merge_goes_on_after_compaction(spark):
    folder, out = shared_folder(spark, "test-merge"), shared_folder(spark, "test-merge-out")
    session = run.stream_session(spark)
    schema = "k string, n long"
    total = {}
    for step in range(6):
        rows = [("a", step), (f"b{step % 2}", 1), (None, 2)]
        for k, n in rows:
            total[k] = total.get(k, 0) + n
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(
            f"{folder}/rows.parquet")
        got = run.sum_to(run.read_stream(session, folder, "rows", schema), out, ["k"], 2)
        assert {r.k: r.n for r in got.collect()} == total
    bases = session.read.parquet(f"{out}/marks")
    assert bases.count() == 3


def test_nothing_to_merge(spark):
    folder = shared_folder(spark, "test-merge-none")
    spark.createDataFrame([], "k string, n long").write.parquet(f"{folder}/rows.parquet")
    session = run.stream_session(spark)
    stream = run.read_stream(session, folder, "rows", "k string, n long")
    assert run.sum_to(stream, shared_folder(spark, "test-none-out"), ["k"]).collect() == []


def test_payers_are_distinct_whatever_comes_twice(spark):
    folder = shared_folder(spark, "test-payers")
    schema = "customer_id bigint, revenue_date date"
    rng = random.Random(5)
    rows = [(rng.choice([1, 2, 40_000, 40_001, 2**40, None]), dt.date(2024, rng.randrange(1, 8), 3))
            for _ in range(60)]
    for k in range(3):
        spark.createDataFrame(rows[k * 15:] + rows[:9], schema).coalesce(1).write.mode(
            "append").parquet(f"{folder}/paid.parquet")
    session = run.stream_session(spark)
    bits = run.merge_to(
        flows.payers(run.read_stream(session, folder, "paid", schema, 1)),
        shared_folder(spark, "test-bits"), flows.payer_bits, flows.same_bits, 2)
    for unit, of in (("month", lambda d: d.month), ("quarter", lambda d: (d.month + 2) // 3)):
        want = {}
        for who, day in rows:
            if who is not None:
                want.setdefault(of(day), set()).add(who)
        got = {of(r[0]): r.paying_customers for r in flows.paying_customers(bits, unit).collect()}
        assert got == {k: len(v) for k, v in want.items()}


def test_append_writes_few_files_a_day(spark):
    """Rows of many days from many tasks: files by day, not by day and task."""
    path = shared_folder(spark, "test-append")
    rows = spark.range(0, 2000, 1, 8).select(
        "id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 40).cast("int")).alias("day"))
    tables.append(rows, path, ["id"], ["day"])
    tables.append(rows, path, ["id"], ["day"])
    held = spark.read.parquet(path)
    assert held.count() == 2000
    files = held.select(F.input_file_name()).distinct().count()
    assert files <= 40 + 8
