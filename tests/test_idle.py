"""Idle deals by timers, against sessions formed from all days at once."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from compare import differences, duck
from dealglass.catalog import queries
from dealglass.catalog.oracle import all_sql
from dealglass.session import shared_folder
from dealglass.streaming import idle, run
from test_streaming import DAY0, activities, feed  # noqa: F401


def stretches(days, idle_days=30):
    """Last day and number of activities of each stretch of a sorted list of days."""
    out = []
    for d in sorted(days):
        if out and d - out[-1][0] <= idle_days:
            out[-1] = (d, out[-1][1] + 1)
        else:
            out.append((d, 1))
    return out


def test_stretches_in_any_order():
    rng = random.Random(3)
    for _ in range(300):
        days = [rng.randrange(400) for _ in range(rng.randrange(1, 30))]
        spans, rest = [], list(days)
        while rest:
            cut = rng.randrange(1, len(rest) + 1)
            spans = idle.joined(spans, [(d, 1) for d in rest[:cut]], 30)
            rest = rest[cut:]
        assert [(last, n) for _, last, n, _ in spans] == stretches(days)
        mark = rng.randrange(500)
        assert [s[3] for s in idle.told(spans, mark, 30)] == [
            last + 31 <= mark for last, _ in stretches(days)]


def standing(spark, session, folder, out):
    rows = idle.signals(activities(session, folder), out, groups=4).collect()
    return sorted((r.deal_id, (r.detected_on - DAY0.date()).days, r.activities) for r in rows)


def test_timers_fire_and_are_rearmed(spark, feed):  # noqa: F811
    folder, add = feed
    session, out = run.stream_session(spark), shared_folder(spark, "test-timers")
    # a: 30 idle days are allowed, 31 are not; b: silent from day 0; z moves the clock
    add(("a", 0), ("a", 30), ("a", 61), ("b", 0), ("z", 62))
    assert standing(spark, session, folder, out) == [("a", 61, 2), ("b", 31, 1)]
    add(("a", 62))  # re-armed: the stretch that began on day 61 goes on
    add(("z", 93))
    assert standing(spark, session, folder, out) == [("a", 61, 2), ("b", 31, 1)]
    add(("z", 94))
    assert standing(spark, session, folder, out) == [
        ("a", 61, 2), ("a", 93, 2), ("b", 31, 1), ("z", 93, 1)]


def test_late_activities_take_signals_back(spark, feed):  # noqa: F811
    folder, add = feed
    session, out = run.stream_session(spark), shared_folder(spark, "test-late-touch")
    add(("a", 0), ("a", 60), ("z", 200))
    assert standing(spark, session, folder, out) == [("a", 31, 1), ("a", 91, 1)]
    add(("a", 30))  # closes the gap between the two
    assert standing(spark, session, folder, out) == [("a", 91, 3)]
    add(("a", 90), ("b", 5))  # moves the signal; an old deal that was not known
    assert standing(spark, session, folder, out) == [("a", 121, 4), ("b", 36, 1)]
    add(("a", 0))  # the same day again
    assert standing(spark, session, folder, out) == [("a", 121, 5), ("b", 36, 1)]


def test_nothing_and_nulls(spark, feed):  # noqa: F811
    folder, add = feed
    session, out = run.stream_session(spark), shared_folder(spark, "test-null-touch")
    rows = [(1, None, "Call", DAY0, "x"), (2, "a", "Call", None, "x")]
    schema = "activity_id int, deal_id string, activity_type string, activity_date timestamp_ntz, outcome string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/activities.parquet")
    add(("a", 0), ("z", 40))
    assert standing(spark, session, folder, out) == [("a", 31, 1)]


def test_state_is_a_row_per_deal(spark, feed):  # noqa: F811
    folder, add = feed
    session, out = run.stream_session(spark), shared_folder(spark, "test-state")
    for k in range(3):
        add(*[(deal, 40 * k + j % 20) for deal in "abcdef" for j in range(50)])
    standing(spark, session, folder, out)
    state = (session.read.format("statestore").option("stateVarName", "deals")
             .option("flattenCollectionTypes", "true").load(f"{out}/out/checkpoint"))
    deals = [r[0]["deal_id"] for r in state.select("list_element").collect()]
    assert sorted(deals) == list("abcdef")


@pytest.mark.parametrize("order", ["newest first", "by key"])
def test_equal_to_sql_whatever_the_batches(spark, monkeypatch, order):
    source = "/root/testdata/sf0.01"
    folder = shared_folder(spark, "test-idle-cuts")
    for table in ("customer", "orders", "part", "events", "nation", "region", "supplier"):
        spark.read.parquet(f"{source}/{table}.parquet").write.parquet(f"{folder}/{table}.parquet")
    lines = spark.read.parquet(f"{source}/lineitem.parquet")
    by = F.col("l_shipdate").desc() if order == "newest first" else F.col("l_partkey")
    parts = lines.repartitionByRange(3, by).cache()
    for part in range(3):
        parts.where(F.spark_partition_id() == part).coalesce(1).write.mode("append").parquet(
            f"{folder}/lineitem.parquet")
    monkeypatch.setattr(queries, "FILES_PER_BATCH", 1)
    found = queries.all_queries()["stream_inactivity"](spark, folder)
    assert differences(found, duck(source), all_sql()["stream_inactivity"]) == []


def test_no_filter_below_the_merge_of_sessions(spark, capsys):
    from dealglass.streaming import flows

    days = spark.createDataFrame(
        [("a", dt.date(2024, 9, 26), 1), ("a", dt.date(2024, 10, 23), 1),
         ("z", dt.date(2024, 11, 4), 1)], "deal_id string, activity_day date, activities long")
    found = flows.gaps(days)
    assert found.collect() == []
    found.explain()
    plan = capsys.readouterr().out
    merge = plan.index("MergingSessions" if "MergingSessions" in plan else "Session")
    assert "Filter (date_add" not in plan[merge:]


class Held:
    """A state variable of a group in memory."""

    def __init__(self, empty):
        self.value, self.writes = empty, 0

    def get(self):
        return self.value

    def put(self, value):
        self.value, self.writes = value, self.writes + 1

    def update(self, value):
        self.value = value


class Handle:
    def __init__(self):
        self.states, self.timers = {}, set()

    def getListState(self, name, schema):
        return self.states.setdefault(name, Held([]))

    def getValueState(self, name, schema):
        return self.states.setdefault(name, Held(None))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


class Clock:
    def __init__(self, day):
        self.day = day

    def getCurrentWatermarkInMs(self):
        return self.day * idle.DAY_MS


@pytest.mark.parametrize("ids", [[7, 8, 9, 2**40], ["a", "b", "", "é"]])
def test_a_group_step_by_step(ids):
    """Rows of arrays and timers in any order, against stretches formed from all days at once."""
    rng = random.Random(5)
    for _ in range(40):
        handle, timers = Handle(), idle.IdleTimers(30, "string")
        timers.init(handle)
        days, signs, mark = {i: [] for i in ids}, {}, 0
        for _ in range(rng.randrange(1, 8)):
            mark += rng.randrange(60)
            writes = handle.getListState("deals", "").writes
            if handle.timers and rng.random() < 0.4:
                handle.timers.clear()
                handle.getValueState("armed", "").value = (
                    None, handle.getValueState("armed", "").value[1])
                out = timers.handleExpiredTimer(None, Clock(mark), None)
                assert handle.getListState("deals", "").writes == writes  # no deal is written
            else:
                rows = [[(rng.choice(ids), rng.randrange(300), rng.randrange(1, 4))
                         for _ in range(rng.randrange(1, 12))] for _ in range(2)]
                for i, d, n in sum(rows, []):
                    days[i] += [d] * n
                frame = pd.DataFrame([
                    (*map(list, zip(*row)), mark) for row in rows],
                    columns=["deals", "days", "counts", "mark"])
                # the clock of the rows tells at once; the watermark may lag behind
                out = timers.handleInputRows(None, iter([frame]), Clock(mark // 2))
            for r in pd.concat(list(out)).itertuples():
                key = (r.deal_id, r.last, r.activities)
                signs[key] = signs.get(key, 0) + r.sign
            want = {(i, last, n) for i in ids for last, n in stretches(days[i]) if last + 31 <= mark}
            assert {k for k, s in signs.items() if s} == want and set(signs.values()) <= {0, 1}
            waiting = [last for i in ids for last, _ in stretches(days[i]) if last + 31 > mark]
            assert handle.timers == ({(min(waiting) + 31) * idle.DAY_MS - 1} if waiting else set())
            assert sorted(map(str, (d for d, _ in handle.getListState("deals", "").value))) == sorted(
                str(i) for i in ids if days[i])


def test_deals_reach_python_by_arrays(spark, feed):  # noqa: F811
    folder, add = feed
    session, out = run.stream_session(spark), shared_folder(spark, "test-arrays")
    add(*[(f"d{k}", k % 90) for k in range(900)])
    idle.signals(activities(session, folder), out, groups=4)
    stored = session.read.parquet(f"{out}/in/arrivals")
    assert stored.count() == 4 and stored.agg(F.sum(F.size("deals"))).first()[0] == 900
