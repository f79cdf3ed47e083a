"""Exact ranks and n-tiles of all rows, without one task that sees them all.

Rows are range-partitioned in the wanted order and stored with the number of their part; the
counts of the parts, of which there are as many as shuffle partitions, give each part's first
rank by prefix sums, and a window within each part gives the rest.  Ties follow the last
order column, which must be unique, so that a value with very many rows is split like any
other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealglass.session import shared_folder


def numbered(rows: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, Column]:
    """The rows with their rank from 1 as column ``name``, and the number of rows as a scalar.

    The range bounds come from a sample, so the parts are stored: a task that is run again
    reads the same ones.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_folder(spark, "ranked")
    rows.repartitionByRange(parts, *order).withColumn(
        "_part", F.spark_partition_id()).write.parquet(path)
    held = spark.read.parquet(path)
    counts = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # The window has dealt the rows by part already, so only the counts are moved to meet them.
    ranked = held.withColumn("_within", within).join(first, "_part").withColumn(
        name, (F.col("_first") + F.col("_within")).cast("long")).drop("_part", "_first", "_within")
    return ranked, held.agg(F.count(F.lit(1))).scalar()


def ntile(rows: DataFrame, tiles: int, order: list[Column], name: str) -> DataFrame:
    """The rows with their tile from 1 to ``tiles``: sizes differ by one, the first are larger."""
    if tiles < 1:
        raise ValueError("at least one tile")
    ranked, total = numbered(rows, order, name)
    size = F.expr(f"`_total` div {tiles}")
    larger = F.col("_total") % tiles  # so many tiles have one row more
    rank = F.col(name) - 1
    border = larger * (size + 1)
    tile = F.when(rank < border, F.floor(rank / (size + 1))).otherwise(
        larger + F.floor((rank - border) / F.greatest(size, F.lit(1))))
    return ranked.withColumn("_total", total).withColumn(name, (tile + 1).cast("int")).drop("_total")
