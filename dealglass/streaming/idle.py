"""Idle deals from a feed of activities: keyed state with event-time timers.

Two streams, each of which reads every row once:

``arrive`` sums the activities of a batch per deal and day and stores them with the clock of
that batch, the newest activity day that had arrived by then.  The clock never goes back, so
it can carry the watermark: a row of any age is on time, whatever the order of the files.
Deals are dealt by hash to ``groups``, and the sums of a group are stored as arrays of some
hundred entries, since rows reach Python one by one.

``IdleTimers`` keeps one row of state per deal, its stretches of activity (first day, last
day, activities).  Each group has one timer, for its first stretch that is not told yet:
Python is called per group, not per deal, and a call reads the rows of its group only and
works on all of them at once, as arrays.  A folder keeps the number of groups it began with.
Activities re-arm the timer; when it fires, a deal was idle for too long, and the signal goes
out.  Stretches are told up to a day that is kept per group, so a timer moves that day and
writes no deal again; a stretch that is over by the clock of its own batch is told at once.
Activities that come late may lengthen a stretch or join two: the stretches before and after
are compared, signals that no longer hold are taken back (sign -1) and those that hold now
are given.  ``standing`` sums the signs.

A deal's state has one entry per gap of its life, that is at most one per ``idle_days``
days, however many activities it has.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from dealglass.streaming import run

DAY_MS = 86_400_000
EPOCH = dt.date(1970, 1, 1)
GROUPS = 512
ENTRIES = 512  # days of deals in a stored row, on average
STATE = "deal_id {key}, spans binary"  # three 64-bit numbers a stretch, as Span without told
OUTPUT = "deal_id {key}, last int, activities bigint, sign int"
ARRIVALS = ("`group` int, deals array<{key}>, days array<int>, counts array<bigint>, "
            "clock timestamp")

Span = tuple[int, int, int, bool]  # first day, last day, activities, told


def merged(deal: np.ndarray, spans: np.ndarray, idle_days: int) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of many deals (numbered from 0), where close ones have become one.

    ``spans`` has a row of first day, last day and activities for each entry of ``deal``.
    The result is in order of deal and first day.
    """
    order = np.lexsort((spans[:, 0], deal))
    deal, spans = deal[order], spans[order]
    # The latest end so far within the deal: days take 32 bits, deals the bits above.
    until = np.maximum.accumulate((deal << 33) + spans[:, 1]) - (deal << 33)
    begins = np.ones(len(deal), bool)
    begins[1:] = (deal[1:] != deal[:-1]) | (spans[1:, 0] - until[:-1] > idle_days)
    at = np.flatnonzero(begins)
    if not len(at):
        return deal, spans
    whole = np.column_stack([
        spans[at, 0], np.maximum.reduceat(spans[:, 1], at), np.add.reduceat(spans[:, 2], at)])
    return deal[at], whole


def joined(spans: list[Span], days: list[tuple[int, int]], idle_days: int) -> list[Span]:
    """The stretches of one deal after more days of activity, none of them told yet."""
    rows = [s[:3] for s in spans] + [(d, d, n) for d, n in days]
    found = merged(np.zeros(len(rows), np.int64), np.array(rows, np.int64).reshape(-1, 3),
                   idle_days)[1]
    return [(*span, False) for span in found.tolist()]


def told(spans: list[Span], mark: int, idle_days: int) -> list[Span]:
    """The stretches, told where the day after the allowed ones is not beyond ``mark``."""
    return [(a, b, n, b + idle_days + 1 <= mark) for a, b, n, _ in spans]


def changed(
    deal_before: np.ndarray, before: np.ndarray, deal: np.ndarray, after: np.ndarray,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deal, stretch and sign of what was told before and no longer holds, and the reverse."""
    deals = np.concatenate([deal_before, deal])
    spans = np.concatenate([before, after])
    sign = np.repeat([-1, 1], [len(deal_before), len(deal)])
    order = np.lexsort((sign, spans[:, 2], spans[:, 1], spans[:, 0], deals))
    deals, spans, sign = deals[order], spans[order], sign[order]
    same = np.zeros(len(deals) + 1, bool)  # equal to the row above; each comes once a side
    same[1:-1] = (deals[1:] == deals[:-1]) & (spans[1:] == spans[:-1]).all(axis=1)
    alone = ~(same[:-1] | same[1:])
    return deals[alone], spans[alone], sign[alone]


class IdleTimers(StatefulProcessor):
    """Signals of a group of deals; see the module."""

    def __init__(self, idle_days: int, key: str):
        self.idle_days = idle_days
        self.schema = STATE.format(key=key)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.deals = handle.getListState("deals", self.schema)
        # The timer, and the day up to which stretches are told.
        self.armed = handle.getValueState("armed", "at bigint, mark bigint")

    def handleInputRows(
        self, key, rows: Iterator[pd.DataFrame], timerValues
    ) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True)
        ids = np.concatenate([np.asarray(x) for x in new["deals"]])
        days, counts = (
            np.concatenate([np.asarray(x, np.int64) for x in new[c]]) for c in ("days", "counts"))
        return self._step(
            ids, np.column_stack([days, days, counts]), int(new["mark"].max()), timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        return self._step(np.array([]), np.empty((0, 3), np.int64), None, timerValues)

    def close(self) -> None:
        pass

    def _step(
        self, ids: np.ndarray, new: np.ndarray, clock: int | None, timer_values
    ) -> Iterator[pd.DataFrame]:
        at, told_to = self.armed.get() or (None, None)
        marks = (timer_values.getCurrentWatermarkInMs() // DAY_MS, clock, told_to)
        mark = max(m for m in marks if m is not None)
        held = list(self.deals.get())
        flat = np.frombuffer(b"".join(spans for _, spans in held), np.int64).reshape(-1, 3)
        known = np.repeat(np.arange(len(held)), [len(spans) // 24 for _, spans in held])
        if len(new):
            named = pd.Series([deal for deal, _ in held] + ids.tolist())
            codes, uniques = pd.factorize(named)
            codes = codes.astype(np.int64)  # those held come first, in their order
            deal, spans = merged(
                np.concatenate([known, codes[len(held):]]), np.concatenate([flat, new]),
                self.idle_days)
        else:
            deal, spans, uniques = known, flat, pd.Index([deal for deal, _ in held])
        over = spans[:, 1] + self.idle_days + 1 <= mark
        if told_to is None:
            was = np.zeros(len(flat), bool)
        else:
            was = flat[:, 1] + self.idle_days + 1 <= told_to
        which, what, sign = changed(known[was], flat[was], deal[over], spans[over])
        if len(new):
            self._keep(uniques.tolist(), deal, spans)
        waiting = spans[~over, 1]
        self._arm(
            (int(waiting.min()) + self.idle_days + 1) * DAY_MS - 1 if len(waiting) else None,
            at, mark, told_to)
        return iter([pd.DataFrame({
            "deal_id": uniques.take(which), "last": what[:, 1].astype(np.int32),
            "activities": what[:, 2], "sign": sign.astype(np.int32)})])

    def _keep(self, names: list, deal: np.ndarray, spans: np.ndarray) -> None:
        """A row per deal; ``spans`` are in order of the deals, each of which has one at least."""
        flat = np.ascontiguousarray(spans).tobytes()
        ends = (24 * np.searchsorted(deal, np.arange(len(names) + 1))).tolist()
        self.deals.put([(name, flat[a:b]) for name, a, b in zip(names, ends, ends[1:])])

    def _arm(self, wanted: int | None, armed: int | None, mark: int, told_to: int | None) -> None:
        """One timer, for the stretch that can be told first."""
        if wanted != armed:
            if armed is not None:
                self.handle.deleteTimer(armed)
            if wanted is not None:
                self.handle.registerTimer(wanted)
        if (wanted, mark) != (armed, told_to):
            self.armed.update((wanted, mark))


def arrive(activities: DataFrame, folder: str, groups: int = GROUPS) -> DataFrame:
    """Runs a stream of activities; returns the stored sums per deal and day as a stream."""
    path = f"{folder}/arrivals"
    session = activities.sparkSession
    schema = ARRIVALS.format(key=dict(activities.dtypes)["deal_id"])

    def newest(batch_id: int) -> dt.datetime | None:
        try:
            held = session.read.schema(f"{schema}, batch bigint").parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return held.where(F.col("batch") < batch_id).agg(F.max("clock")).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        last, rows = batch.agg(F.max("day"), F.count(F.lit(1))).first()
        if last is None:
            return
        own = dt.datetime.combine(EPOCH + dt.timedelta(last), dt.time())
        clock = max(filter(None, (own, newest(batch_id))))
        parts = -(-rows // (groups * ENTRIES))
        dealt = F.xxhash64("deal_id")
        days = batch.groupBy("deal_id", "day").agg(F.count(F.lit(1)).alias("n")).select(
            F.pmod(dealt, F.lit(groups)).cast("int").alias("group"),
            F.pmod(F.xxhash64("day", dealt), F.lit(parts)).alias("part"), "deal_id", "day", "n")
        # Brought together first: the arrays are not grown before the shuffle and sent then.
        together = days.repartition("group", "part").groupBy("group", "part").agg(
            F.collect_list(F.struct("deal_id", "day", "n")).alias("sums"))
        together.select(
            "group", F.col("sums.deal_id").alias("deals"), F.col("sums.day").alias("days"),
            F.col("sums.n").alias("counts"), F.lit(clock).alias("clock"),
        ).write.mode("overwrite").partitionBy("clock").parquet(f"{path}/batch={batch_id}")

    touched = activities.select("deal_id", F.unix_date(F.to_date("activity_date")).alias("day"))
    run.each_batch(touched.where("deal_id is not null and day is not null"), write, folder)
    return session.readStream.schema(schema).parquet(path)


def signals(
    activities: DataFrame, folder: str, idle_days: int = 30, delay: str = "1 day",
    groups: int = GROUPS,
) -> DataFrame:
    """Runs both streams over what has arrived; returns the signals that stand.

    A stretch is told once the newest day of all is ``delay`` past the day on which the deal
    has been idle for more than ``idle_days``.  Going on from the same folder reads only
    what is new.
    """
    key = dict(activities.dtypes)["deal_id"]
    mark = F.unix_date(F.to_date(F.col("clock") - F.expr(f"interval '{delay}'")))
    changes = (
        arrive(activities, f"{folder}/in", groups).withColumn("mark", mark)
        .withWatermark("clock", delay)
        .groupBy("group")
        .transformWithStateInPandas(
            statefulProcessor=IdleTimers(idle_days, key), outputStructType=OUTPUT.format(key=key),
            outputMode="Append", timeMode="EventTime")
    )
    return standing(run.append_to(changes, f"{folder}/out", run.refuse_late), idle_days)


def standing(changes: DataFrame, idle_days: int = 30) -> DataFrame:
    """The signals whose signs add up to one, as ``flows.inactivity`` gives them."""
    held = changes.groupBy("deal_id", "last", "activities").agg(F.sum("sign").alias("sign"))
    held = held.withColumn("last_activity_date", F.date_from_unix_date("last"))
    return held.where("sign > 0").select(
        "deal_id",
        F.lit("No Activity").alias("signal_type"),
        F.lit("Medium").alias("severity"),
        "last_activity_date",
        F.date_add("last_activity_date", idle_days + 1).alias("detected_on"),
        F.lit(False).alias("resolved"),
        "activities",
    )
