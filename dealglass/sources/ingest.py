"""Loading rows: column defaults, natural-key lookup, line totals, stable ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealglass.functions.columns import dec, half_up, moment, stable_id  # noqa: F401
from dealglass.model import column_type
from dealglass.plans.skew import salted_join

# Column defaults per table.  "now" is the load time.
DEFAULTS: dict[str, dict[str, object]] = {
    "deal_stages": {"is_closed": False, "is_won": False, "created_at": "now"},
    "customers": {"status": "Active", "created_at": "now", "updated_at": "now"},
    "contacts": {"decision_maker": False, "created_at": "now", "updated_at": "now"},
    "deals": {"currency": "USD", "days_in_stage": 0, "is_active": True, "created_at": "now",
              "updated_at": "now"},
    "products": {"is_active": True, "created_at": "now", "updated_at": "now"},
    "deal_products": {"quantity": 1, "discount_percent": 0, "created_at": "now"},
    "activities": {"created_at": "now"},
    "revenue_records": {"currency": "USD", "payment_status": "Paid", "created_at": "now"},
    "forecasts": {"created_at": "now", "updated_at": "now"},
    "churn_signals": {"detected_at": "now", "resolved": False, "created_at": "now"},
    "cohorts": {"total_customers": 0, "total_revenue": 0, "avg_deal_value": 0, "churn_rate": 0,
                "expansion_rate": 0, "created_at": "now", "updated_at": "now"},
    "audit_logs": {"changed_at": "now"},
}


def apply_defaults(rows: DataFrame, table: str, loaded_at: dt.datetime) -> DataFrame:
    """Fills nulls of columns with a default, and adds such columns when missing."""
    types = dict(rows.dtypes)
    filled = {}
    for column, value in DEFAULTS[table].items():
        if value == "now":
            default = moment(loaded_at)
        else:
            default = F.lit(value)
        if column in types:
            filled[column] = F.coalesce(F.col(column), default.cast(types[column]))
        else:
            filled[column] = default.cast(column_type(table, column))
    return rows.withColumns(filled)


def line_total(lines: DataFrame) -> DataFrame:
    """Adds total_value = quantity × unit price × (1 − discount %), two digits."""
    factor = F.lit(1) - F.col("discount_percent") * dec("0.01")
    total = F.col("quantity") * F.col("unit_price") * factor
    return lines.withColumn("total_value", half_up(total).cast("decimal(15,2)"))


def resolve_key(
    rows: DataFrame, name: str, parents: DataFrame, parent_name: str, parent_id: str,
    spread: Column, out: str,
) -> DataFrame:
    """Looks up ``parent_id`` by a natural key and reports how that went.

    Adds ``out`` (null unless exactly one parent matches) and ``<out>_status``:
    matched, ambiguous or unmatched.  Parents are first combined per name, so
    an ambiguous name cannot multiply rows; a name that dominates the incoming
    rows is spread over many tasks.
    """
    by_name = parents.groupBy(F.col(parent_name).alias(name)).agg(
        F.count(F.lit(1)).alias("_matches"), F.min(parent_id).alias("_id"))
    matches = F.col("_matches")
    return (
        salted_join(rows, by_name, name, spread=spread, how="left")
        .withColumn(out, F.when(matches == 1, F.col("_id")))
        .withColumn(
            f"{out}_status",
            F.when(matches == 1, "matched").when(matches > 1, "ambiguous").otherwise("unmatched"))
        .drop("_matches", "_id")
    )
