"""Running a stream over the files that are there now, into a Parquet table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, LongType, StructType

from dealglass.sources.tables import append

# Session options for stateful streams.  Day windows are cut at midnight UTC, so
# times without a zone are read as UTC.  State is kept on disk and checkpointed by
# its changes.  Sessions of one key are merged inside each input partition before
# the shuffle, so that a key with many rows does not send all of them to one task.
STREAM_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


COMPACT_AFTER = 16  # batches that are stored apart at most, at the end of a run
Merge = Callable[[DataFrame], DataFrame]


def stream_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster with the streaming options; the caller's stays as is."""
    session = spark.newSession()
    own = {k: v for k, v in spark.conf.getAll.items()
           if k.startswith("spark.sql.") and spark.conf.isModifiable(k)}
    for key, value in {**own, **STREAM_SETTINGS}.items():
        session.conf.set(key, value)
    return session


def read_stream(
    session: SparkSession, folder: str, table: str, schema: str | StructType,
    files_per_batch: int | None = 1000,
) -> DataFrame:
    """A table's Parquet files as a stream, at most ``files_per_batch`` in a batch.

    With ``None`` all files that are there when a run starts make one batch.  The trailing
    pattern lets the table be a folder or a single file.
    """
    reader = session.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder.rstrip('/')}/{table}.parquet*")


def late_rows(query: StreamingQuery) -> int:
    """Waits for a stream; returns the rows that came after the watermark had passed them.

    Spark keeps the progress of the last batches only, so it is read while they run.
    """
    late: dict[int, int] = {}
    done = False
    while not done:
        done = query.awaitTermination(0.2)
        for p in query.recentProgress:
            dropped = sum(state.numRowsDroppedByWatermark for state in p.stateOperators)
            late[p.batchId] = max(dropped, late.get(p.batchId, 0))
    return sum(late.values())


def append_to(
    stream: DataFrame, folder: str, on_late: Callable[[int], None] | None = None
) -> DataFrame:
    """Runs an append stream until its input is used up; returns the written table.

    ``on_late`` is told how many rows were too late to count.
    """
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .option("path", f"{folder}/data")
        .trigger(availableNow=True)
        .start()
    )
    late = late_rows(query)
    if on_late is not None:
        on_late(late)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/data")


def refuse_late(late: int) -> None:
    """For streams in which no row can be late: rows that were would be lost."""
    if late:
        raise RuntimeError(f"{late} rows came after the watermark")


def each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], folder: str
) -> None:
    """Runs a stream until its input is used up, handing each batch and its number to ``write``."""
    (
        stream.writeStream.outputMode("append")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def append_new_to(stream: DataFrame, folder: str, key: str, partition: str) -> DataFrame:
    """Runs a stream whose rows are appended once per ``key``; returns the table.

    There is no state and no watermark: a row of any age is written to its
    partition unless that partition has its key, also when a batch is repeated
    or a row is delivered again in a later one.
    """
    path = f"{folder}/data"

    def write(batch: DataFrame, _batch_id: int) -> None:
        append(batch, path, [key], [partition])

    each_batch(stream, write, folder)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def table_stream(session: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The table that ``append_new_to`` keeps in ``folder``, as a stream: each key once."""
    return session.readStream.schema(schema).parquet(f"{folder}/data")


def upsert_by(stream: DataFrame, key: str, folder: str) -> DataFrame:
    """Runs an aggregating stream whose changed groups replace their partition.

    A batch holds the full totals of the groups it changed, so writing it again
    after a failure gives the same table.
    """
    path = f"{folder}/data"
    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(_replace_partitions(key, path))
        .option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def merge_to(
    stream: DataFrame, folder: str, first: Merge, again: Merge, compact_after: int = COMPACT_AFTER,
    sift: Callable[[DataFrame, int], DataFrame] | None = None,
) -> DataFrame:
    """Runs a stream whose batches are merged by key; returns the merged rows of all batches.

    ``first`` groups the rows of a batch, ``again`` merges rows so grouped, in any order and
    any number.  A batch stores its groups in the folder of its number, which a repeated batch
    replaces.  There is no state and no watermark: a row of any age counts, so the result does
    not depend on how the input was cut into batches.  After ``compact_after`` batches what is
    stored is merged into one table, from which later runs go on, so what a run reads is the
    result and a bounded number of batches, not all that ever came.  ``sift`` may take rows
    out of a batch before it is grouped.
    """
    session = stream.sparkSession
    schema = first(stream).schema

    def held(name: str, columns: StructType) -> DataFrame | None:
        try:
            return session.read.schema(columns).parquet(f"{folder}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
        return None

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if sift is None else sift(batch, batch_id)
        first(rows).write.mode("overwrite").parquet(f"{folder}/data/batch={batch_id}")

    each_batch(stream, write, folder)
    # A base counts once its mark is written, which is the last step of making it.
    marks = held("marks", StructType().add("upto", LongType()))
    upto = -1 if marks is None else marks.agg(F.max("upto")).first()[0]
    batches = held("data", StructType([*schema.fields]).add("batch", LongType()))
    if batches is None:
        return again(session.createDataFrame([], schema))
    fresh = batches.where(F.col("batch") > upto)
    parts = fresh.drop("batch")
    if upto >= 0:
        parts = parts.unionByName(session.read.schema(schema).parquet(f"{folder}/base/upto={upto}"))
    merged = again(parts)
    numbers = fresh.agg(F.max("batch"), F.count_distinct("batch")).first()
    if numbers[1] >= compact_after:
        to_schema = merged.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        base = f"{folder}/base/upto={numbers[0]}"
        to_schema.write.mode("overwrite").parquet(base)
        session.createDataFrame([(numbers[0],)], "upto bigint").write.mode("append").parquet(
            f"{folder}/marks")
        merged = again(session.read.schema(schema).parquet(base))
    return merged


def sum_to(
    stream: DataFrame, folder: str, keys: list[str], compact_after: int = COMPACT_AFTER
) -> DataFrame:
    """Runs a stream of keys and numbers; returns the sums per key over all batches."""
    numbers = [c for c in stream.columns if c not in keys]

    def summed(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in numbers])

    return merge_to(stream, folder, summed, summed, compact_after)


def merge_on_time(
    stream: DataFrame, folder: str, day: str, first: Merge, again: Merge, delay_days: int = 1,
    compact_after: int = COMPACT_AFTER,
) -> tuple[DataFrame, DataFrame]:
    """As ``merge_to`` for windows of a day; returns the merged rows and the rows that were late.

    A row is late if its day had ended ``delay_days`` before the newest day of the batches
    before its own.  Late rows are kept as they came, so on time and late make up the input.
    Rows without a day are on time.
    """
    session = stream.sparkSession
    marks = StructType().add("newest", DateType()).add("batch", LongType())
    late_schema = StructType([*stream.schema.fields]).add("batch", LongType())

    def sift(batch: DataFrame, batch_id: int) -> DataFrame:
        newest = None
        if batch_id:
            held = session.read.schema(marks).parquet(f"{folder}/newest")
            newest = held.where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        over = F.date_add(F.col(day), 1) <= F.date_sub(F.lit(newest).cast("date"), delay_days)
        late = F.coalesce(over, F.lit(False))
        batch.where(late).write.mode("overwrite").parquet(f"{folder}/late/batch={batch_id}")
        batch.agg(F.max(day).alias("newest")).write.mode("overwrite").parquet(
            f"{folder}/newest/batch={batch_id}")
        return batch.where(~late)

    merged = merge_to(stream, folder, first, again, compact_after, sift)
    try:
        rows = session.read.schema(late_schema).parquet(f"{folder}/late").drop("batch")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = session.createDataFrame([], stream.schema)
    return merged, rows


def _replace_partitions(key: str, path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, _batch_id: int) -> None:
        (
            batch.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(key)
            .parquet(path)
        )

    return write
