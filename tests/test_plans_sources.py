import datetime as dt
import json
import os
import subprocess
import sys
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from dealglass import views
from dealglass.model import Model, ddl, required_columns
from dealglass.operators import changes, pipeline, quality, revenue
from dealglass.plans.ordering import ordered
from dealglass.plans.skew import BUCKETS, hot_buckets, salted_join
from dealglass.session import shared_folder
from dealglass.sources import ingest, orders, tables
from fixtures import AS_OF, at, by

NOW = dt.datetime(2024, 3, 31, 12)


@pytest.fixture(scope="module")
def skewed(spark):
    """10,000 rows, a third of them on key 7, some without a key."""
    return spark.range(10_000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") < 3400, 7).when(F.col("id") < 3500, F.lit(None))
        .otherwise(F.col("id") % 500).cast("int").alias("key"))


def test_hot_buckets_hold_the_dominating_key(spark, skewed):
    hot = hot_buckets(skewed, "key", min_rows=1000).first()["hot"]
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(7)), F.lit(BUCKETS))).first()[0]
    assert list(hot) == [bucket]
    assert hot[bucket] == 3                         # a third of four partitions, and one more
    assert hot_buckets(skewed, "key").first()["hot"] == {}
    assert hot_buckets(skewed.limit(0), "key").first()["hot"] == {}
    even = spark.range(100_000).withColumnRenamed("id", "key")
    assert hot_buckets(even, "key", min_rows=1).first()["hot"] == {}


def test_salted_join_needs_one_key_type(spark, skewed):
    with pytest.raises(ValueError):
        salted_join(skewed, spark.range(5).withColumnRenamed("id", "key"), "key", F.lit(1))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("min_rows", [1, 1000, 10**9])
def test_salted_join_equals_plain_join(spark, skewed, how, min_rows):
    dim = spark.range(0, 450).select(
        F.col("id").cast("int").alias("key"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    want = skewed.join(dim, "key", how)
    got = salted_join(skewed, dim, "key", F.col("row_id"), how, min_rows=min_rows)
    assert sorted(got.columns) == sorted(want.columns)
    columns = ["row_id", "key", "name"]
    assert got.select(columns).exceptAll(want.select(columns)).count() == 0
    assert got.count() == want.count()


def test_salted_join_spreads_the_hot_key(spark, skewed):
    dim = spark.range(500).select(F.col("id").cast("int").alias("key"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(skewed, dim, "key", F.col("row_id"), min_rows=1000)
        tasks = joined.where("key = 7").select(F.spark_partition_id().alias("p"))
        assert tasks.distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_rows_without_a_key_are_spread(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") >= 30_000, F.col("id")).alias("key"))
    dim = spark.range(30_000, 40_000).withColumnRenamed("id", "key")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = salted_join(rows, dim, "key", F.col("row_id"), "left")
        tasks = joined.where("key is null").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(tasks) == 4 and max(r["count"] for r in tasks) < 15_000
    assert sum(r["count"] for r in tasks) == 30_000


def test_ids_tell_nulls_and_separators_apart(spark):
    keys = [("a", None, "c"), ("a", "c", None), ("a|c", None, None), ("a", "", "c"), ("a", "|", "c")]
    rows = spark.createDataFrame(keys, "x string, y string, z string")
    ids = rows.select(ingest.stable_id(F.col("x"), F.col("y"), F.col("z")).alias("i"))
    assert ids.distinct().count() == len(keys)


def test_missing_columns_get_their_declared_type(spark):
    rows = spark.createDataFrame([(1,)], "id int")
    assert dict(ingest.apply_defaults(rows, "deal_products", NOW).dtypes)[
        "discount_percent"] == "decimal(5,2)"
    types = dict(ingest.apply_defaults(rows, "cohorts", NOW).dtypes)
    assert (types["total_revenue"], types["total_customers"]) == ("decimal(15,2)", "int")


def test_audit_of_an_added_column(small):
    after = small.customers.withColumn("phone", F.lit("1"))
    got = changes.audit_log_diff(small.customers, after, "customers", "me", NOW).collect()
    assert {r["action"] for r in got} == {"UPDATE"} and len(got) == 4
    assert json.loads(got[0]["old_data"])["phone"] is None
    assert json.loads(got[0]["new_data"])["phone"] == "1"
    assert changes.audit_log_diff(after, small.customers, "customers", "me", NOW).count() == 4


@pytest.mark.parametrize("by_day", [None, ["day"]])
def test_append_adds_new_keys_only(spark, by_day):
    path = shared_folder(spark, "test-append")
    rows = spark.createDataFrame(
        [("a", 1), ("b", 1), ("b", 1), (None, 2)], "id string, day int")
    for _ in range(2):
        tables.append(rows, path, ["id"], by_day)
    more = spark.createDataFrame([("b", 1), ("c", 2)], "id string, day int")
    tables.append(more, path, ["id"], by_day)
    got = spark.read.schema(rows.schema).parquet(path).collect()
    assert sorted((r.id or "", r.day) for r in got) == [("", 2), ("a", 1), ("b", 1), ("c", 2)]


def test_append_shuffles_whole_rows_once(spark, capsys):
    rows = spark.range(0, 400, 1, 4).selectExpr(
        "cast(id % 100 as string) as id", "cast(id % 5 as int) as day", "repeat('x', 50) as note")
    tables.new_rows(rows, None, ["id"], ["day"]).explain()
    assert capsys.readouterr().out.count("Exchange") == 1
    held = rows.select("id", "day").where("day < 2")
    left = tables.new_rows(rows, held, ["id"], ["day"])
    left.explain()
    plan = capsys.readouterr().out
    assert len([x for x in plan.splitlines() if "Exchange range" in x]) == 1
    # the others carry the days of the batch and the keys held, no notes
    assert [x for x in plan.splitlines() if "Exchange hash" in x and "note" in x] == []
    assert sorted(int(r.id) for r in left.collect()) == [k for k in range(100) if k % 5 > 1]
    assert {r.note for r in left.collect()} == {"x" * 50}


def test_shared_folder_of_a_plain_local_session(tmp_path):
    code = (
        "from dealglass.session import local_session, shared_folder\n"
        "s = local_session(1, 1, '1g')\n"
        "a, b = shared_folder(s, 'x'), shared_folder(s, 'x')\n"
        "s.range(3).write.parquet(a)\n"
        "assert a != b and s.read.parquet(a).count() == 3\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]


def test_null_order(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, 4)], "id int, v int")
    assert [r.id for r in ordered(df, "v").collect()] == [3, 1, 2]
    assert [r.id for r in ordered(df, "-v", "id").collect()] == [2, 1, 3]
    assert [r.id for r in ordered(df, "-v", top_n=2).collect()] == [2, 1]


def test_resolve_key(spark):
    rows = spark.createDataFrame(
        [(1, "Acme"), (2, "Twin"), (3, "Nobody"), (4, None)], "row int, company string")
    parents = spark.createDataFrame(
        [("c1", "Acme"), ("c2", "Twin"), ("c3", "Twin")], "customer_id string, name string")
    got = by(ingest.resolve_key(
        rows, "company", parents, "name", "customer_id", F.col("row"), "owner"), "row")
    assert [(got[i]["owner"], got[i]["owner_status"]) for i in (1, 2, 3, 4)] == [
        ("c1", "matched"), (None, "ambiguous"), (None, "unmatched"), (None, "unmatched")]


def test_defaults_and_line_total(spark):
    rows = spark.createDataFrame([(1, None), (2, "EUR")], "deal_id int, currency string")
    got = by(ingest.apply_defaults(rows, "deals", NOW), "deal_id")
    assert (got[1]["currency"], got[2]["currency"]) == ("USD", "EUR")
    assert got[1]["is_active"] is True and got[1]["created_at"] == NOW
    lines = spark.createDataFrame(
        [(3, D("10.05"), D("12.50"))],
        "quantity int, unit_price decimal(15,2), discount_percent decimal(5,2)")
    assert ingest.line_total(lines).first()["total_value"] == D("26.38")     # 26.38125


def test_quality(spark, small):
    broken = small.replace(
        deals=small.deals.withColumn("deal_value", -F.col("deal_value")).withColumn(
            "deal_source", F.when(F.col("deal_id") == "d1", "Fax").otherwise(F.lit(None))),
        customers=small.customers.unionAll(small.customers.where("customer_id = 'c1'")),
    )
    domain = by(quality.check_domains(broken), "table_name", "column_name")
    assert domain["deals", "deal_source"]["violations"] == 1            # null passes
    assert by(quality.check_ranges(broken), "column_name")["deal_value"]["violations"] == 7
    assert by(quality.check_not_null(broken), "table_name", "column_name")[
        "deals", "deal_id"]["violations"] == 0
    unique = by(quality.check_unique(broken), "table_name", "key_columns")
    assert unique["customers", "customer_id"]["repeated_rows"] == 2
    missing = small.replace(deals=small.deals.where("deal_id <> 'd2'"))
    orphans = by(quality.check_orphans(missing), "child_table", "child_column")
    assert orphans["activities", "deal_id"]["orphan_rows"] == 2
    assert orphans["churn_signals", "deal_id"]["orphan_rows"] == 2      # the null one is excused
    moved = small.replace(deals=small.deals.withColumn("customer_id", F.lit("c1")))
    off = quality.check_deal_customer(moved).collect()
    assert {r["deal_id"] for r in off if r["child_table"] == "activities"} == {"d4", "d6"}
    assert {r["child_table"] for r in off} >= {"activities", "revenue_records"}


def test_audit_diff(small):
    before = small.customers
    after = before.where("customer_id <> 'c3'").withColumn(
        "status", F.when(F.col("customer_id") == "c1", F.lit(None)).otherwise(F.col("status")))
    new = after.limit(0).sparkSession.createDataFrame(
        [("c9", "Echo", None, "US", D(1), "SMB", "Active")], before.schema)
    got = by(changes.audit_log_diff(before, after.unionAll(new), "customers", "me", NOW),
             "record_id")
    assert {k: r["action"] for k, r in got.items()} == {
        "c1": "UPDATE", "c3": "DELETE", "c9": "INSERT"}
    assert json.loads(got["c1"]["new_data"])["status"] is None          # nulls are kept
    assert got["c9"]["old_data"] is None and got["c3"]["new_data"] is None
    again = by(changes.audit_log_diff(before, after.unionAll(new), "customers", "me", NOW),
               "record_id")
    assert again == got                                                 # ids are stable


def test_detect_inactivity(small):
    got = by(changes.detect_inactivity(small, AS_OF, NOW), "deal_id")
    # d2 is idle 14 days; d6 31 days with only a resolved signal
    assert {k: r["severity"] for k, r in got.items()} == {
        "d1": "High", "d3": "Critical", "d4": "High", "d5": "Critical", "d6": "Medium",
        "d7": "Critical"}
    active = changes.detect_inactivity(small, AS_OF, NOW, active_only=True).collect()
    assert {r["deal_id"] for r in active} == {"d4", "d6", "d7"}
    earlier = by(changes.detect_inactivity(small, AS_OF - dt.timedelta(days=1), NOW), "deal_id")
    assert "d6" not in earlier                                          # 30 days is not enough
    assert earlier["d4"]["severity"] == "Medium"                        # 45 days


def test_materialize_replaces(spark, small):
    folder = shared_folder(spark, "test-mv")
    summary = revenue.monthly_revenue_summary(small)
    first = tables.materialize(summary, folder, partition_by=["revenue_month"])
    assert first.count() == 2
    jan = small.replace(
        revenue_records=small.revenue_records.where("revenue_date < '2024-02-01'"))
    second = tables.materialize(revenue.monthly_revenue_summary(jan), folder, as_of=AS_OF)
    assert second.dtypes == [*summary.dtypes, ("as_of", "date")]
    assert [r["as_of"] for r in second.collect()] == [AS_OF]


def test_model_reads_declared_tables(spark, small):
    folder = shared_folder(spark, "test-model")
    full = spark.createDataFrame([], ddl("customers"))
    filled = small.customers.select(
        *[F.col(f.name) if f.name in small.customers.columns
          else F.lit(None).cast(f.dataType).alias(f.name) for f in full.schema.fields])
    filled.write.parquet(f"{folder}/customers")
    m = tables.read_model(spark, folder, ["customers"])
    assert m.customers.count() == 4 and set(m.tables()) == {"customers"}
    assert required_columns("customers") == ["customer_id", "company_name"]
    with pytest.raises(AttributeError):
        m.deals
    with pytest.raises(ValueError):
        Model(orders=m.customers)


def test_shuffled_input_changes_nothing(small):
    mixed = small.replace(
        deals=small.deals.repartition(7).orderBy(F.rand(1)),
        activities=small.activities.repartition(5))
    for operator in (pipeline.pipeline_scoring, pipeline.deal_risk_scores):
        assert sorted(operator(mixed, AS_OF).collect(), key=str) == sorted(
            operator(small, AS_OF).collect(), key=str)


def test_one_day_later(small):
    today = by(pipeline.deal_risk_scores(small, AS_OF), "deal_id")
    later = by(pipeline.deal_risk_scores(small, AS_OF + dt.timedelta(days=1)), "deal_id")
    for deal, row in today.items():
        assert later[deal]["days_overdue"] == row["days_overdue"] + 1


def test_sql_names(spark, small):
    views.register(small, AS_OF)
    high = spark.sql(
        "SELECT deal_id FROM deal_risk_scores WHERE risk_level IN ('Critical', 'High') "
        "ORDER BY risk_score DESC, deal_id").collect()
    assert {r.deal_id for r in high} == {"d2", "d4", "d6"}
    default = spark.sql("SELECT * FROM get_revenue_forecast()").collect()
    expected = revenue.revenue_forecast(small, AS_OF, 3).collect()
    assert [r["predicted_revenue"] for r in sorted(default)] == [
        r["predicted_revenue"] for r in expected]
    value = spark.sql(
        "SELECT * FROM get_customer_lifetime_value("
        "(SELECT customer_id FROM customers WHERE company_name = 'Acme'))").first()
    assert value["clv_estimate"] == D("800.80")
    assert spark.sql("SELECT * FROM get_deal_health_score('d1')").first()["health_score"] == 66
    assert spark.sql("SELECT * FROM mv_pipeline_health").count() == 4
    for name in ("pipeline_summary", "customer_health", "mv_monthly_revenue_summary",
                 "pipeline_scoring", "funnel_velocity", "rep_forecast", "mrr_trend",
                 "cohort_analysis", "churn_risk_ranking", "win_loss", "rep_leaderboard",
                 "upsell_opportunities"):
        assert spark.table(name).columns
    ordered_health = spark.sql("SELECT * FROM customer_health ORDER BY health_score ASC")
    assert ordered_health.count() == 4
    assert spark.sql("SELECT * FROM get_revenue_forecast(3)").count() == len(default)
    assert at(0).date() == AS_OF


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_sql_functions_filter_the_facts(spark, capsys):
    views.register(orders.model(spark, "/root/testdata/sf0.001"), orders.AS_OF)

    def scans(call):
        spark.sql(f"SELECT * FROM {call}").explain()
        lines = capsys.readouterr().out.split("\n")
        return {kind: [x for x in lines if "FileScan" in x and f"{kind}.parquet" in x]
                for kind in ("orders", "customer", "lineitem", "events")}

    found = scans("get_customer_lifetime_value(17)")
    assert all("o_custkey" in x and "= 17" in x for x in found["orders"]) and found["orders"]
    assert all("= 17" in x for x in found["customer"])
    assert all("= 17" in x for x in found["events"])
    found = scans("get_deal_health_score(17)")
    assert all("= 17" in x for x in found["orders"]) and found["orders"]
    assert all("= 17" in x for x in found["lineitem"])


def test_lengths(small):
    long = small.replace(customers=small.customers.withColumn("industry", F.repeat(F.lit("é"), 101)))
    got = by(quality.check_lengths(long), "table_name", "column_name")
    assert got["customers", "industry"]["violations"] == 4
    assert sum(r["violations"] for r in got.values()) == 4
