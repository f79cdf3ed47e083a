"""Late rows, waiting children and rejected rows: nothing is lost, whatever the batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from dealglass.catalog import queries
from dealglass.catalog.oracle import all_sql
from dealglass.operators import quality, rejects
from dealglass.session import shared_folder
from dealglass.sources import orders
from dealglass.streaming import pending, run

FOLDER = "/root/testdata/sf0.001"
DAY0 = dt.date(2024, 1, 1)


# ------------------------------------------------------------------ late rows

def brute_windows(batches, delay):
    """On-time counts per day and late rows, batch by batch."""
    newest, on_time, late = None, {}, []
    for rows in batches:
        for day, n in rows:
            if day is not None and newest is not None and day + 1 <= newest - delay:
                late.append((day, n))
            else:
                on_time[day] = on_time.get(day, 0) + n
        newest = max([d for d, _ in rows if d is not None] + ([newest] if newest is not None else []),
                     default=newest)
    return on_time, sorted(late)


@pytest.mark.parametrize("cut", [1, 2, 5])
def test_on_time_and_late_make_the_input(spark, cut):
    rng = random.Random(cut)
    rows = [(rng.choice([None, *range(k, k + 12)]), 1 + k % 3) for k in range(40)]
    batches = [rows[i::cut] for i in range(cut)]
    folder = shared_folder(spark, "test-late")
    for part in batches:
        dated = [(d if d is None else DAY0 + dt.timedelta(d), n) for d, n in part]
        spark.createDataFrame(dated, "day date, n long").coalesce(1).write.mode("append").parquet(
            f"{folder}/rows.parquet")
    session = run.stream_session(spark)

    def summed(df):
        return df.groupBy("day").agg(F.sum("n").alias("n"))

    merged, late = run.merge_on_time(
        run.read_stream(session, folder, "rows", "day date, n long", 1),
        shared_folder(spark, "test-late-out"), "day", summed, summed, 2, 3)
    on_time, too_late = brute_windows(batches, 2)

    def number(day):
        return None if day is None else (day - DAY0).days

    assert {number(r.day): r.n for r in merged.collect()} == on_time
    assert sorted((number(r.day), r.n) for r in late.collect()) == too_late
    assert sum(on_time.values()) + sum(n for _, n in too_late) == sum(n for _, n in rows)


# ------------------------------------------------------------------ waiting children

def test_children_wait_for_their_parent(spark):
    folder, out = shared_folder(spark, "test-children"), shared_folder(spark, "test-pending")
    session = run.stream_session(spark)
    schema = "id int, parent string"
    parents = []

    def come(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(
            f"{folder}/children.parquet")

    def table():
        return session.createDataFrame([(p,) for p in parents], "parent string")

    def resolve():
        stream = run.read_stream(session, folder, "children", schema, 1)
        return ids(pending.resolve(stream, table, out, "parent", patience=2))

    def ids(found):
        return [sorted(r.id for r in part.collect())
                for part in (found.resolved, found.orphans, found.waiting)]

    parents.append("a")
    come((1, "a"), (2, "b"), (3, "none"), (4, None))
    assert resolve() == [[1, 4], [], [2, 3]]
    parents.append("b")
    come((5, "a"), (6, "c"))
    assert resolve() == [[1, 2, 4, 5], [3], [6]]      # 2 one batch later; 3 reported
    assert resolve() == [[1, 2, 4, 5], [3], [6]]      # nothing new: started again, nothing twice
    parents.append("c")
    settled = pending.settle(session, session.createDataFrame([], schema).schema, table, out,
                             "parent", 2)
    assert ids(settled) == [[1, 2, 4, 5, 6], [3], []]
    come((7, "none"), (8, "c"))
    assert resolve() == [[1, 2, 4, 5, 6, 8], [3], [7]]


def test_a_round_that_is_repeated_changes_nothing(spark):
    out = shared_folder(spark, "test-repeat")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, parent string")
    known = spark.createDataFrame([("a",)], "parent string")
    for _ in range(2):
        pending._round(rows, lambda: known, out, "parent", 2, 0)
    found = pending._outcome(spark, out, rows.schema)
    assert [r.id for r in found.resolved.collect()] == [1]
    assert [r.id for r in found.waiting.collect()] == [2]
    for _ in range(2):
        pending._round(rows.limit(0), lambda: known, out, "parent", 2, 1)
    found = pending._outcome(spark, out, rows.schema)
    assert [r.id for r in found.orphans.collect()] == [2] and found.waiting.count() == 0


# ------------------------------------------------------------------ rejected rows

def test_split_of_odd_rows(spark):
    schema = "customer_id int, company_name string, customer_tier string, status string, reasons int"
    rows = [(1, "A", "SMB", "Active", 7), (2, None, "Huge", "Gone", 7), (None, "B" * 151, None, None, 7),
            (3, "C", None, None, None), (3, "C", None, None, None)]
    found = rejects.split(spark.createDataFrame(rows, schema), "customers",
                          shared_folder(spark, "test-split"))
    assert sorted(r.customer_id for r in found.good.collect()) == [1, 3, 3]
    said = {r.customer_id: r.reasons for r in found.rejected.collect()}
    assert said == {
        2: ["customer_tier: domain", "status: domain", "company_name: not null"],
        None: ["company_name: at most 150 characters", "customer_id: not null"]}
    assert (found.rows, found.rejected_rows) == (5, 2)
    assert found.violations["status", "domain"] == 1


def test_split_of_nothing(spark):
    empty = spark.createDataFrame([], "customer_id int, company_name string")
    found = rejects.split(empty, "customers", shared_folder(spark, "test-split-none"))
    assert found.good.count() == found.rejected.count() == found.rows == 0


@pytest.mark.parametrize("table", queries.SPLIT)
def test_counts_equal_the_counting_checks(spark, table):
    m = orders.model(spark, FOLDER)
    rows = m.tables()[table]
    found = rejects.split(rows, table, shared_folder(spark, "test-split-counts"),
                          queries.MORE_RANGES)
    assert found.good.count() + found.rejected.count() == rows.count() == found.rows
    assert found.rejected.count() == found.rejected_rows
    checks = [quality.check_domains(m), quality.check_ranges(m, queries.MORE_RANGES),
              quality.check_lengths(m), quality.check_not_null(m)]
    counted = {(r.column_name, r.rule): r.violations
               for check in checks for r in check.where(F.col("table_name") == table).collect()}
    assert counted == found.violations
    assert found.good.columns == rows.columns


def test_deliveries_of_many_files_are_batches(spark, monkeypatch):
    """Each third is written by all tasks that read it, and is still one batch."""
    folder = shared_folder(spark, "test-thirds")
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").repartition(5).write.parquet(
        f"{folder}/lineitem.parquet")
    made = {}
    monkeypatch.setattr(queries, "shared_folder", lambda session, purpose: made.setdefault(
        purpose, shared_folder(session, purpose)))
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))  # a task a file
    try:
        got = queries.all_queries()["stream_daily_windows"](spark, folder)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    feed = spark.read.parquet(f"{made['thirds']}/lineitem.parquet")
    files = feed.groupBy(F.col("l_orderkey") % 3).agg(
        F.count_distinct(F.col("_metadata.file_path")).alias("files")).collect()
    assert [r.files > 1 for r in files] == [True] * 3
    batches = spark.read.parquet(f"{made['daily-windows']}/newest")
    assert sorted(r.batch for r in batches.select("batch").collect()) == [0, 1, 2]
    assert differences(got, duck(FOLDER), all_sql()["stream_daily_windows"]) == []
