"""Joining a large fact to a large dimension when one key may dominate the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keys are counted by hash bucket: a few thousand groups, whatever the number of keys.
BUCKETS = 16_384
# A bucket with more than 1/256 of the rows (64 times the average) is hot, so
# there are always fewer than 256 of them.
HOT_SHARE = 256
# A bucket below this many rows cannot hold up a task.
HOT_ROWS = 100_000


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(BUCKETS)).cast("int")


def hot_buckets(facts: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """One row with a map: hot hash bucket of ``key`` to the slices its rows need.

    A slice is about one shuffle partition's share of the table, so all hot
    buckets together get no more slices than the session has partitions, plus
    one each.  Counting combines map-side into at most ``BUCKETS`` rows, and
    exact counts decide, so a recomputed task sees the same map.
    """
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = (
        facts.where(F.col(key).isNotNull())
        .groupBy(_bucket(key).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    summary = counts.agg(
        F.sum("n").alias("total"), F.collect_list(F.struct("bucket", "n")).alias("buckets"))

    def slices(b: Column) -> Column:
        return F.ceil(b["n"] * partitions / F.col("total")).cast("int") + 1

    hot = F.filter("buckets", lambda b: (b["n"] >= min_rows) & (b["n"] * HOT_SHARE > F.col("total")))
    return summary.select(
        F.map_from_entries(F.transform(hot, lambda b: F.struct(b["bucket"], slices(b)))).alias("hot")
    )


def salted_join(
    facts: DataFrame,
    dim: DataFrame,
    key: str,
    spread: Column,
    how: str = "inner",
    count_on: DataFrame | None = None,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join ``facts`` to a dimension that is unique on ``key``.

    Rows whose key falls in a hot bucket are spread over the bucket's slices by
    a hash of ``spread``, and the dimension rows of that bucket (one in
    ``BUCKETS``) are repeated per slice; everything else has slice 0.  Each fact
    row meets its dimension row exactly once, so the result equals the plain
    join whatever the map says.  Rows without a key match nothing and are always
    spread over all partitions.  ``count_on`` names a base table to count keys
    on when ``facts`` itself is expensive to compute.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    if facts.schema[key].dataType != dim.schema[key].dataType:
        raise ValueError(f"cast {key} to one type on both sides")
    hot = hot_buckets(facts if count_on is None else count_on, key, min_rows).scalar()
    slices = F.coalesce(F.try_element_at(hot, _bucket(key)), F.lit(1))
    # Slices are hashed to partitions, so many of them fall evenly.
    everywhere = 32 * int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = F.when(F.col(key).isNull(), everywhere).otherwise(slices)
    left = facts.withColumn(
        "_slice", F.coalesce(F.pmod(F.xxhash64(spread), wanted).cast("int"), F.lit(0)))
    right = dim.withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    return left.join(right, [key, "_slice"], how).drop("_slice")
