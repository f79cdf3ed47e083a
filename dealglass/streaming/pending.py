"""Children that come before their parent: they wait, and are reported if it never comes.

Each round takes the new children and those still waiting and looks their parents up in the
table of parents as it is then.  A child whose parent is there is resolved; one that has
waited ``patience`` rounds is reported as an orphan, once; the others wait on.  A round is a
batch of the stream of children, or a call of ``settle`` when only parents have come.

A round writes to the folder of its number and leaves its mark last, so a round that is
repeated after a failure replaces what it had begun.  What a round reads is the new children
and those that wait, never all that came.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from dealglass.streaming import run

PATIENCE = 3
BETWEEN = 1_000_000  # rounds of ``settle`` that fit between two batches
Parents = Callable[[], DataFrame]


@dataclass
class Outcome:
    resolved: DataFrame
    orphans: DataFrame
    waiting: DataFrame


def _read(session: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return session.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return session.createDataFrame([], schema)


def _last_round(session: SparkSession, folder: str, below: int | None = None) -> int:
    marks = _read(session, f"{folder}/marks", StructType().add("round", LongType()))
    if below is not None:
        marks = marks.where(F.col("round") < below)
    last = marks.agg(F.max("round")).first()[0]
    return -1 if last is None else last


def _round(
    children: DataFrame, parents: Parents, folder: str, key: str, patience: int, number: int
) -> None:
    session = children.sparkSession
    held = StructType([*children.schema.fields]).add("_tries", IntegerType())
    before = _last_round(session, folder, number)
    waiting = _read(session, f"{folder}/waiting/round={before}", held)
    known = parents().select(F.col(key)).where(F.col(key).isNotNull()).distinct()
    known = known.withColumn("_known", F.lit(True))
    rows = children.withColumn("_tries", F.lit(0)).unionByName(waiting).join(known, key, "left")
    there = F.col("_known").isNotNull() | F.col(key).isNull()
    spent = F.col("_tries") + 1 >= patience
    state = F.when(there, "resolved").when(spent, "orphans").otherwise("waiting")
    rows = rows.withColumn("_state", state).withColumn("_tries", F.col("_tries") + 1).persist()
    for name, columns in (("resolved", children.columns), ("orphans", children.columns),
                          ("waiting", [*children.columns, "_tries"])):
        part = rows.where(F.col("_state") == name).select(*columns)
        part.write.mode("overwrite").parquet(f"{folder}/{name}/round={number}")
    rows.unpersist()
    session.createDataFrame([(number,)], "round bigint").write.mode("append").parquet(
        f"{folder}/marks")


def _outcome(session: SparkSession, folder: str, schema: StructType) -> Outcome:
    last = _last_round(session, folder)
    rounds = StructType([*schema.fields]).add("round", LongType())

    def of(name: str) -> DataFrame:
        return _read(session, f"{folder}/{name}", rounds).where(F.col("round") <= last).drop("round")

    return Outcome(of("resolved"), of("orphans"),
                   _read(session, f"{folder}/waiting/round={last}", schema))


def resolve(
    children: DataFrame, parents: Parents, folder: str, key: str, patience: int = PATIENCE
) -> Outcome:
    """Runs a stream of children over what has arrived.

    ``parents`` gives the table of parents anew for each round; ``key`` has one name in both.
    A child without a key has no parent to wait for and is resolved.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        _round(batch, parents, folder, key, patience, batch_id * BETWEEN)

    run.each_batch(children, write, folder)
    return _outcome(children.sparkSession, folder, children.schema)


def settle(
    session: SparkSession, schema: StructType, parents: Parents, folder: str, key: str,
    patience: int = PATIENCE,
) -> Outcome:
    """One more round for the children that wait, without new ones."""
    number = _last_round(session, folder) + 1
    _round(session.createDataFrame([], schema), parents, folder, key, patience, number)
    return _outcome(session, folder, schema)
