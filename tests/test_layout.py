"""The stored layout by its plans, and compaction."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from dealglass.operators import customers, revenue
from dealglass.plans import rollups
from dealglass.session import shared_folder
from dealglass.sources import layout, orders, tables

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def models(spark):
    m = orders.model(spark, FOLDER)
    return m, layout.stored(m, shared_folder(spark, "test-layout"), 4)


def plan(df, capsys):
    df.explain()
    return capsys.readouterr().out


def rows(df):
    return sorted(map(str, df.collect()))


def test_customers_join_without_a_shuffle(spark, models, capsys):
    _, held = models
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sums = held.deals.groupBy("customer_id").agg(F.sum("deal_value"))
        bills = held.revenue_records.groupBy("customer_id").agg(F.sum("amount"))
        both = held.customers.join(sums, "customer_id", "left").join(bills, "customer_id", "left")
        text = plan(both, capsys)
        assert "Exchange" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_forecasts_read_the_months_they_need(models, capsys):
    m, held = models
    for result in (revenue.revenue_forecast(held, orders.AS_OF),
                   revenue.rep_forecast(held, orders.AS_OF)):
        filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(result, capsys))
        assert any("close_month" in f and "2001-06-01" in f for f in filters)
    window = rollups.closing(
        held.deals, F.lit(orders.AS_OF), F.add_months(F.lit(orders.AS_OF), 3))
    months = {r.close_month for r in window.select("close_month").distinct().collect()}
    assert months <= {dt.date(2001, k, 1) for k in (6, 7, 8, 9)} and months
    assert rows(revenue.revenue_forecast(held, orders.AS_OF)) == rows(
        revenue.revenue_forecast(m, orders.AS_OF))


def test_same_results(models):
    m, held = models
    assert rows(customers.customer_segments(held)) == rows(customers.customer_segments(m))
    assert rows(customers.customer_health(held, orders.AS_OF)) == rows(
        customers.customer_health(m, orders.AS_OF))


def test_compaction(spark):
    path = shared_folder(spark, "test-compact")
    schema = "id bigint, day date"
    for k in range(6):
        part = spark.range(k * 10, k * 10 + 10).select(
            "id", F.when(F.col("id") % 5 < 3, F.lit(dt.date(2024, 1, 1))).when(
                F.lit(k == 0), F.lit(dt.date(2024, 1, 2))).alias("day"))
        part.coalesce(1).write.mode("append").partitionBy("day").parquet(path)
    from pyspark.sql.types import _parse_datatype_string
    fields = _parse_datatype_string(schema)
    before = spark.read.schema(fields).parquet(path)
    want = rows(before)
    other = {r[0] for r in before.where("day = '2024-01-02'").select(F.input_file_name()).distinct().collect()}
    assert tables.compact(spark, path, fields, "day", 4) == 2   # the first day and no day
    after = spark.read.schema(fields).parquet(path)
    assert rows(after) == want
    named = after.select("day", F.input_file_name().alias("file")).distinct()
    files = {r[0]: r[1] for r in named.groupBy("day").count().collect()}
    assert files[dt.date(2024, 1, 1)] == 1 and files[None] == 1
    assert {r[0] for r in after.where("day = '2024-01-02'").select(
        F.input_file_name()).distinct().collect()} == other
    assert tables.compact(spark, path, fields, "day", 4) == 0
