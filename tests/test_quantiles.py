"""Exact ranks and tiles by parts, against ranks of all rows at once."""

import random

import pytest
from pyspark.sql import functions as F

from dealglass.plans.quantiles import ntile, numbered


def brute(values, tiles):
    """Tile of each (value, id), by sorting; nulls first, ties by id."""
    order = sorted(values, key=lambda v: (v[0] is not None, v[0] or 0, v[1]))
    out, at = {}, 0
    for tile in range(1, tiles + 1):
        size = len(order) // tiles + (tile <= len(order) % tiles)
        out.update({v[1]: tile for v in order[at:at + size]})
        at += size
    return out


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 1001])
@pytest.mark.parametrize("tiles", [1, 3, 10])
def test_tiles(spark, n, tiles):
    rng = random.Random(n * tiles)
    values = [(rng.choice([None, 5, 5, 5, rng.randrange(50)]), k) for k in range(n)]
    rows = spark.createDataFrame(values, "v int, id int").repartition(3)
    got = ntile(rows, tiles, [F.asc_nulls_first("v"), F.asc("id")], "tile")
    assert {r.id: r.tile for r in got.collect()} == brute(values, tiles)


def test_ranks_of_one_value_are_split(spark, capsys):
    rows = spark.range(20_000).select("id", F.lit(1).alias("v"))
    ranked, total = numbered(rows, [F.asc("v"), F.asc("id")], "rank")
    assert ranked.where("rank <> id + 1").count() == 0
    assert ranked.select(total).first()[0] == 20_000
    parts = spark.read.parquet(ranked.inputFiles()[0].rpartition("/")[0]).groupBy("_part").count()
    assert max(r["count"] for r in parts.collect()) < 12_000
    ranked.explain()
    lines = capsys.readouterr().out.splitlines()
    below = [lines[k + 1] for k, line in enumerate(lines) if "SinglePartition" in line]
    assert below and all("HashAggregate" in line for line in below)  # counts, never rows


def test_no_tile(spark):
    with pytest.raises(ValueError):
        ntile(spark.range(3), 0, [F.asc("id")], "t")
