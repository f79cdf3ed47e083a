"""Domain tables and results at rest."""

from __future__ import annotations

import datetime as dt
from functools import partial, reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dealglass.model import SCHEMAS, Model, ddl


def read_table(spark: SparkSession, table: str, path: str, fmt: str = "parquet") -> DataFrame:
    """A domain table with its declared schema; csv files need a header line."""
    reader = spark.read.format(fmt).schema(ddl(table))
    return reader.option("header", "true").load(path) if fmt == "csv" else reader.load(path)


def read_model(spark: SparkSession, folder: str, tables: list[str] | None = None) -> Model:
    """A model over ``folder/<table>`` for the named tables (default: all)."""
    base = folder.rstrip("/")
    names = tables or list(SCHEMAS)
    return Model(**{t: partial(read_table, spark, t, f"{base}/{t}") for t in names})


def materialize(
    result: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    as_of: dt.date | None = None,
) -> DataFrame:
    """Writes a result as Parquet, replacing an earlier one, and reads it back.

    A stored result keeps the date it was computed for; ``as_of`` adds it as a column.
    """
    spark = result.sparkSession
    if as_of is not None:
        result = result.withColumn("as_of", F.lit(as_of))
    writer = result.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(result.schema).parquet(path)


def write_bucketed(
    df: DataFrame, table: str, key: str, buckets: int, path: str,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Saves a catalog table at ``path``, bucketed and sorted by ``key``; returns it.

    Two tables with the same bucket count on their join key join without a shuffle.  The
    rows come to one task a bucket, so a partition holds one file a bucket.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def compact(spark: SparkSession, path: str, schema: StructType, by: str, most: int = 4) -> int:
    """Rewrites the partitions of a Parquet table that hold more than ``most`` files.

    Appending leaves a file a task and run.  The rows of crowded partitions are first copied
    to a folder beside the table, then replace their partitions, of which the others are not
    touched; a run that fails in between is simply run again.  Returns the partitions rewritten.
    """
    rows = spark.read.schema(schema).parquet(path)
    named = rows.select(by, F.col("_metadata.file_path").alias("file"))
    files = named.groupBy(by).agg(F.count_distinct("file").alias("files"))
    crowded = [r[by] for r in files.where(F.col("files") > most).collect()]  # partition values
    if crowded:
        copy = f"{path.rstrip('/')}-compacting"
        some = F.col(by).isin([v for v in crowded if v is not None])
        if None in crowded:
            some = some | F.col(by).isNull()
        rows.where(some).hint("rebalance", by).write.mode("overwrite").parquet(copy)
        held = spark.read.schema(schema).parquet(copy)
        held.hint("rebalance", by).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    return len(crowded)


def append(
    rows: DataFrame, path: str, key: list[str], partition_by: list[str] | None = None
) -> None:
    """Adds those rows to a stored table whose key it does not hold yet.

    Running a job again therefore changes nothing.  Of a partitioned table only
    the partitions of the new rows are looked at, so the key must belong to one
    partition (an id and the day it was made).  Of repeated new rows one is kept.
    """
    by = partition_by or []
    try:
        held = rows.sparkSession.read.schema(rows.schema).parquet(path).select(*{*key, *by})
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        held = None
    writer = new_rows(rows, held, key, by).write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def new_rows(
    rows: DataFrame, held: DataFrame | None, key: list[str], by: list[str]
) -> DataFrame:
    """One row per key that ``held`` lacks; with ``by`` in few tasks per partition.

    Whole rows are shuffled once: to ranges of partition and key, in which repeated rows and
    the keys held meet and from which the partitions are written.  A large partition is many
    ranges.
    """
    if not by:
        new = rows.dropDuplicates(key)
        if held is None:
            return new
        same = reduce(and_, [new[c].eqNullSafe(held[c]) for c in key])
        return new.join(held, same, "left_anti").select(*rows.columns)
    one = [*by, *[c for c in key if c not in by]]
    found = rows.withColumn("_held", F.lit(False))
    if held is not None:
        held = held.join(rows.select(*by).distinct(), by, "left_semi").select(*one)
        found = found.unionByName(
            held.withColumn("_held", F.lit(True)), allowMissingColumns=True)
    rest = [F.first(c).alias(c) for c in rows.columns if c not in one]
    each = found.repartitionByRange(*one).groupBy(*one).agg(F.max("_held").alias("_held"), *rest)
    return each.where(~F.col("_held")).select(*rows.columns)
