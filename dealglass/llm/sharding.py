"""Sharding by fixed virtual slots and a versioned slot-to-shard map.

A record's slot never changes: a hash of its id and text, modulo ``SLOTS``. The
map from slots to shards is a small stored table with a version. Version 1 deals the
slots in turn, before any bytes are known. ``rebalance`` makes the next version from the
current one by moving only the slots that a shard holds beyond its share, so most records
stay where they are; ``shard_records`` stores the version that the sizes of its records
ask for beside the ones before it, and places the records by it. ``SlotMap`` names the
folder; a later run that gives the same one goes on from its last version.

The map has ``SLOTS`` rows whatever the size of the data, so it is one row's
array while it is computed and a broadcast when it is applied.

A null text has no bytes (every record counts one byte more than its text); null
ids hash as a value of their own. Repeated rows are records of their own: those that one
part of the input holds are numbered there, and from the second on the number enters the
hash, so a row that is repeated very often is spread over all slots, while at most one
row of each part shares a slot with the first. Records of a slot are dealt to ``SPLITS``
parts so that no task gets all of them. Empty tables give an empty result. Other columns
are ignored by ``shard_records``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from dealglass.llm.common import store
from dealglass.session import shared_folder

SLOTS = 4096
SPLITS = 16
SHARDS = 16


def _dealt(items: Column, loads: Column) -> Column:
    """Array of (slot, shard): items (bytes, slot), in order, to the lightest shard."""
    start = F.struct(
        loads.alias("loads"), F.array().cast("array<struct<slot:int,shard:int>>").alias("out"))

    def step(done, item):
        lightest = (F.array_position(done["loads"], F.array_min(done["loads"])) - 1).cast("int")
        grown = F.transform(
            done["loads"],
            lambda load, i: load + F.when(i == lightest, item["bytes"]).otherwise(F.lit(0)))
        pair = F.struct(item["slot"].alias("slot"), lightest.alias("shard"))
        return F.struct(
            grown.alias("loads"), F.concat(done["out"], F.array(pair)).alias("out"))

    return F.aggregate(items, start, step)["out"]


def slot_sizes(records: DataFrame) -> DataFrame:
    """(slot, bytes) for every slot, used or not; at most ``SLOTS`` rows."""
    every = records.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("slot"))
    used = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    sized = every.join(used, every["slot"] == used["virtual_slot"], "left")
    return sized.select("slot", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def _by_size(sizes: DataFrame) -> DataFrame:
    pairs = F.collect_list(F.struct("bytes", "slot"))
    return sizes.agg(F.sort_array(pairs, asc=False).alias("items"))


def even_map(spark: SparkSession, shards: int = SHARDS) -> DataFrame:
    """Version 1, by number of slots: (version, slot, shard)."""
    slot = F.col("id").cast("int")
    return spark.range(SLOTS).select(
        F.lit(1).alias("version"), slot.alias("slot"), (slot % shards).alias("shard"))


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A map from sizes alone: slots, largest first, each to the lightest shard."""
    none = F.array_repeat(F.lit(0).cast("long"), shards)
    dealt = _by_size(sizes).select(F.explode(_dealt(F.col("items"), none)).alias("d"))
    return dealt.select(F.lit(1).alias("version"), "d.slot", "d.shard")


def rebalance(current: DataFrame, sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version for new sizes or more shards (0 to ``shards`` - 1).

    A shard keeps its slots, largest first, up to an equal share of all bytes;
    the rest, and slots of shards that no longer exist, are dealt anew to the
    lightest shards: a new shard takes nearly all of it, the last small slots
    level the loads.
    """
    share = F.sum("bytes").over(W.partitionBy()) / shards
    held = current.join(sizes, "slot")
    so_far = F.sum("bytes").over(
        W.partitionBy("shard").orderBy(F.desc("bytes"), "slot").rowsBetween(
            W.unboundedPreceding, 0))
    held = held.withColumn("stays", (so_far <= share) & (F.col("shard") < shards))
    version = (F.max("version") + 1).alias("version")
    pairs = F.sort_array(F.collect_list(
        F.when(~F.col("stays"), F.struct("bytes", "slot"))), asc=False)
    loads = F.array(*[
        F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("bytes")).otherwise(0))
        for s in range(shards)])
    stays = F.collect_list(F.when(F.col("stays"), F.struct("slot", "shard")))
    one = held.agg(version, pairs.alias("items"), loads.alias("loads"), stays.alias("stays"))
    moved = _dealt(F.col("items"), F.col("loads"))
    dealt = one.select("version", F.explode(F.concat("stays", moved)).alias("d"))
    return dealt.select("version", "d.slot", "d.shard")


class SlotMap:
    """The versions of a map, each in a folder of its own under one name."""

    SCHEMA = "version int, slot int, shard int"

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or shared_folder(spark, "slot-map")

    def versions(self) -> DataFrame:
        """All stored rows; a version counts once all of its slots are there."""
        try:
            held = self.spark.read.schema(self.SCHEMA).parquet(self.folder)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.SCHEMA)
        whole = held.groupBy("version").agg(F.count_distinct("slot").alias("n")).where(
            F.col("n") == SLOTS).select("version")
        return held.join(whole, "version", "left_semi").select("version", "slot", "shard")

    def add(self, slot_map: DataFrame, version: int) -> DataFrame:
        """Stores a version; one that a failed run left half is replaced."""
        path = f"{self.folder}/version={version}"
        slot_map.select("slot", "shard").write.mode("overwrite").parquet(path)
        return self.version(version)

    def version(self, number: int) -> DataFrame:
        """One version, read from its own folder."""
        path = f"{self.folder}/version={number}"
        held = self.spark.read.schema("slot int, shard int").parquet(path)
        return held.select(F.lit(number).alias("version"), "slot", "shard")

    def current(self) -> tuple[DataFrame, int] | None:
        last = self.versions().agg(F.max("version")).first()[0]
        return None if last is None else (self.version(last), last)


def records(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Slim records, stored: doc_id, size, text_crc32, virtual_slot, part."""
    col, key = F.col(f"`{text}`"), F.col(f"`{doc_id}`")
    slim = docs.select(
        key.alias("doc_id"),
        (F.coalesce(F.octet_length(col), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
        F.crc32(col.cast("binary")).alias("text_crc32"),
        F.xxhash64(key.cast("string"), col).alias("hash"),
        F.spark_partition_id().alias("source_part"),
    )
    same = W.partitionBy("hash", "doc_id", "text_crc32", "source_part").orderBy("size")
    slim = slim.withColumn("number", F.row_number().over(same) - 1)
    hashed = F.when(F.col("number") == 0, F.col("hash")).otherwise(F.xxhash64("hash", "number"))
    return store(slim.select(
        "doc_id", "size", "text_crc32",
        F.pmod(hashed, F.lit(SLOTS)).cast("int").alias("virtual_slot"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SPLITS)).cast("int").alias("part"),
    ), "records")


def place(recs: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Adds ``shard`` and ``slot``, the record's place within its shard from 0."""
    fill = recs.groupBy("virtual_slot", "part").agg(F.count("*").alias("n"))
    fill = fill.join(
        F.broadcast(slot_map.select(F.col("slot").alias("virtual_slot"), "shard")), "virtual_slot")
    before = W.partitionBy("shard").orderBy("virtual_slot", "part").rowsBetween(
        W.unboundedPreceding, -1)
    fill = fill.select(
        "virtual_slot", "part", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    own = W.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = recs.withColumn("n", F.row_number().over(own) - 1)
    # At most SLOTS * SPLITS rows of four numbers: about 2 MB.
    return numbered.join(F.broadcast(fill), ["virtual_slot", "part"]).withColumn(
        "slot", (F.col("base") + F.col("n")).cast("long"))


def shard_records(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text",
    slot_map: SlotMap | None = None,
) -> DataFrame:
    """One row per record: size, checksum, virtual slot, shard and place in it, map version."""
    versions = slot_map or SlotMap(docs.sparkSession)
    recs = records(docs, doc_id, text)
    sizes = slot_sizes(recs)
    current, number = versions.current() or (
        versions.add(even_map(docs.sparkSession, shards), 1), 1)
    edited = versions.add(rebalance(current, sizes, shards), number + 1)
    return place(recs, edited).select(
        "doc_id", "size", "text_crc32", "virtual_slot", "shard", "slot",
        F.lit(number + 1).alias("map_version"))
