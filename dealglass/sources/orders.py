"""The domain model over order-processing tables.

Maps customer, orders, lineitem, part and events files to the domain tables.
Every mapping but ``customers`` and ``forecasts`` is a projection of one file,
so column pruning and filters reach the scan and no shuffle is added.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealglass.functions.columns import half_up, month, percent
from dealglass.model import DOMAINS, STAGES, Model
from dealglass.operators.revenue import derive_mrr_arr
from dealglass.plans.rollups import STAGE_COLUMNS
from dealglass.sources.ingest import line_total

# The date that stands for "today" on these tables.
AS_OF = dt.date(2001, 6, 1)

# Order priority to deal source and to revenue type.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


# Column types of the source files.  Declared, so that planning a
# query reads no file footers.
FILE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMAS[table]).parquet(f"{folder.rstrip('/')}/{table}.parquet")


def _choose(key: str, keys: list, values: list[str], default: str | None = None) -> str:
    """A fixed mapping as a SQL CASE expression."""
    whens = " ".join(f"when {k!r} then '{v}'" for k, v in zip(keys, values))
    return f"case {key} {whens} {f"else '{default}'" if default else ''} end"


def deal_stages(spark: SparkSession) -> DataFrame:
    """The stage table as literal rows; Spark knows its size and broadcasts it."""
    rows = ", ".join(
        f"({order}, '{name}', {order}, cast({p} as decimal(5,2)), {closed}, {won})"
        for name, order, p, closed, won in STAGES
    )
    return spark.sql(f"select * from values {rows} as t({', '.join(STAGE_COLUMNS)})")


def customers(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Customers with country and region.

    Nation and region are looked up one after the other and are small enough that
    Spark broadcasts them by their size.  One row per key is asked of both, so that
    Spark knows it can leave them out where no place is wanted.
    """
    nations = nation.withColumnRenamed("n_nationkey", "c_nationkey")
    regions = region.withColumnRenamed("r_regionkey", "n_regionkey")
    located = customer.join(
        nations.dropDuplicates(["c_nationkey"]), "c_nationkey", "left"
    ).join(regions.dropDuplicates(["n_regionkey"]), "n_regionkey", "left")
    return located.selectExpr(
        "c_custkey as customer_id",
        "c_name as company_name",
        "c_mktsegment as industry",
        "n_name as country",
        "r_name as region",
        "cast(c_acctbal as decimal(15,2)) as annual_revenue",
        """case when c_acctbal >= 7000 then 'Enterprise' when c_acctbal >= 3000 then 'Mid-Market'
           else 'SMB' end as customer_tier""",
        """case when c_acctbal < 0 then 'Churned' when c_acctbal < 600 then 'At-Risk'
           else 'Active' end as status""",
    )


def deals(orders: DataFrame) -> DataFrame:
    source = _choose("o_orderpriority", PRIORITIES, DOMAINS["deals", "deal_source"])
    return orders.selectExpr(
        "o_orderkey as deal_id",
        "o_custkey as customer_id",
        """case when o_orderstatus = 'F' then if(o_orderpriority = '5-LOW', 7, 6)
                when o_orderstatus = 'P' then if(o_orderpriority in ('1-URGENT', '2-HIGH'), 5, 4)
                when o_orderpriority in ('1-URGENT', '2-HIGH') then 3
                when o_orderpriority = '3-MEDIUM' then 2 else 1 end as stage_id""",
        "concat('Deal ', o_orderkey) as deal_name",
        "cast(o_totalprice as decimal(15,2)) as deal_value",
        "date_add(cast(o_orderdate as date), cast(30 + o_orderkey % 120 as int))"
        " as expected_close_date",
        "if(o_orderstatus = 'F',"
        " date_add(cast(o_orderdate as date), cast(10 + o_orderkey % 80 as int)), null)"
        " as actual_close_date",
        "o_orderdate as created_at",
        f"{source} as deal_source",
        "concat('rep_', o_orderkey % 25) as assigned_rep",
        "cast(o_orderkey % 69 as int) as days_in_stage",
        "o_orderstatus <> 'F' as is_active",
    )


def products(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        "p_partkey as product_id",
        "concat(p_name, ' #', p_partkey) as product_name",
        "p_type as product_category",
        "cast(p_retailprice as decimal(15,2)) as unit_price",
        "case when p_size <= 10 then 'One-Time' when p_size <= 25 then 'Monthly'"
        " else 'Annual' end as billing_type",
        "p_size > 5 as is_active",
    )


LINE_ID = "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)"


def deal_products(lineitem: DataFrame) -> DataFrame:
    return line_total(lineitem.selectExpr(
        f"{LINE_ID} as deal_product_id",
        "l_orderkey as deal_id",
        "l_partkey as product_id",
        "cast(l_quantity as int) as quantity",
        "cast(l_extendedprice as decimal(15,2)) as unit_price",
        "cast(cast(l_discount as decimal(4,2)) * 100 as decimal(5,2)) as discount_percent",
    ))


def activities(lineitem: DataFrame) -> DataFrame:
    """Activities of a deal; the customer is found through the deal."""
    kind = _choose("l_linenumber", list(range(1, 8)), DOMAINS["activities", "activity_type"])
    return lineitem.selectExpr(
        f"{LINE_ID} as activity_id",
        "l_orderkey as deal_id",
        f"{kind} as activity_type",
        "l_shipdate as activity_date",
        """case when l_returnflag = 'A' then 'Positive' when l_returnflag = 'N' then 'Neutral'
           when l_linestatus = 'F' then 'No Response' else 'Negative' end as outcome""",
    )


def revenue_records(orders: DataFrame) -> DataFrame:
    kind = _choose("o_orderpriority", PRIORITIES, DOMAINS["revenue_records", "revenue_type"])
    period = _choose("o_orderkey % 4", list(range(4)), DOMAINS["revenue_records", "billing_period"])
    paid = _choose(
        "o_orderkey % 5", list(range(4)), DOMAINS["revenue_records", "payment_status"], "Paid")
    return derive_mrr_arr(orders.where("o_orderstatus = 'F'").selectExpr(
        "o_orderkey as revenue_id",
        "o_orderkey as deal_id",
        "o_custkey as customer_id",
        f"{kind} as revenue_type",
        "cast(o_totalprice as decimal(15,2)) as amount",
        "date_add(cast(o_orderdate as date), cast(10 + o_orderkey % 80 as int)) as revenue_date",
        f"{period} as billing_period",
        f"{paid} as payment_status",
    ))


def churn_signals(events: DataFrame) -> DataFrame:
    kind = _choose("k % 7", list(range(7)), DOMAINS["churn_signals", "signal_type"])
    return events.where("event_type = 'error'").selectExpr(
        "*", "cast(get_json_object(props, '$.k') as int) as k"
    ).selectExpr(
        "event_id as signal_id",
        "user_id as customer_id",
        "event_id as deal_id",
        f"{kind} as signal_type",
        """case when value < 20 then 'Low' when value < 60 then 'Medium'
           when value < 120 then 'High' else 'Critical' end as severity""",
        "ts as detected_at",
        "k < 10 as resolved",
    )


def forecasts(deal_rows: DataFrame, as_of: dt.date) -> DataFrame:
    """Rep × month forecasts; the actual is unknown from the month of ``as_of`` on."""
    start = month(F.col("expected_close_date"))
    grouped = deal_rows.groupBy("assigned_rep", start.alias("forecast_month")).agg(
        F.sum("deal_value").alias("pipeline_value"),
        F.sum(F.when(F.col("stage_id") == 6, F.col("deal_value"))).alias("won_value"),
    )
    known = F.col("forecast_month") < F.trunc(F.lit(as_of), "MM")
    committed = half_up(F.col("pipeline_value") * F.lit(Decimal("0.5")))
    return grouped.select(
        "assigned_rep",
        "forecast_month",
        "pipeline_value",
        committed.alias("committed_value"),
        F.when(known, F.col("won_value")).alias("actual_revenue"),
    ).withColumn("forecast_accuracy", percent(F.col("actual_revenue"), F.col("committed_value")))


def model(spark: SparkSession, folder: str, as_of: dt.date = AS_OF) -> Model:
    """All derivable domain tables of a folder; a table is set up when first used."""
    table = partial(read, spark, folder)
    return Model(
        deal_stages=lambda: deal_stages(spark),
        customers=lambda: customers(table("customer"), table("nation"), table("region")),
        deals=lambda: deals(table("orders")),
        products=lambda: products(table("part")),
        deal_products=lambda: deal_products(table("lineitem")),
        activities=lambda: activities(table("lineitem")),
        revenue_records=lambda: revenue_records(table("orders")),
        churn_signals=lambda: churn_signals(table("events")),
        forecasts=lambda: forecasts(deals(table("orders")), as_of),
    )


def deals_as_of(m: Model, day: dt.date, purge_years: int = 5) -> DataFrame:
    """The deal table as it stood on ``day``.

    Later deals do not exist yet, a deal closing later is still in negotiation,
    and lost deals are deleted ``purge_years`` after closing.
    """
    closed_later = F.col("actual_close_date") > F.lit(day)
    purged = (F.col("stage_id") == 7) & (
        F.col("actual_close_date") <= F.add_months(F.lit(day), -12 * purge_years))
    still_open = F.coalesce(closed_later, F.lit(False))
    return (
        m.deals.where((F.col("created_at").cast("date") <= F.lit(day))
                      & ~F.coalesce(purged, F.lit(False)))
        .withColumn("stage_id", F.when(still_open, 5).otherwise(F.col("stage_id")))
        .withColumn("is_active", still_open | F.col("is_active"))
        .withColumn("actual_close_date", F.when(~closed_later, F.col("actual_close_date")))
    )
