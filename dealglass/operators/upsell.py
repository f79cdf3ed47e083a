"""Products a customer owns through won deals, and what is left to sell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealglass.functions.columns import count_where
from dealglass.model import Model
from dealglass.plans import rollups


def owned_products(m: Model) -> DataFrame:
    """One row per customer and owned product, with the product's attributes."""
    catalogue = m.products.select(
        "product_id", "product_name", "product_category", "unit_price", "is_active")
    return rollups.customer_products(m).join(catalogue, "product_id")


def upsell_opportunities(m: Model) -> DataFrame:
    """Per customer with won products: products owned, their value, and what is missing.

    Missing = active catalogue minus owned active products, by count and list
    price, so customers are never paired with every product.  A customer who
    owns everything stays, with zeros.
    """
    active, price = F.col("is_active"), F.col("unit_price")
    owned = (
        owned_products(m)
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("products_owned"),
            F.sum("owned_value").alias("current_rev"),
            count_where(active).alias("owned_active"),
            F.coalesce(F.sum(F.when(active, price)), F.lit(0).cast("decimal(15,2)")).alias(
                "owned_active_price"),
        )
    )
    on_sale = m.products.where("is_active")
    on_sale_count = on_sale.agg(F.count(F.lit(1))).scalar()
    on_sale_price = on_sale.agg(
        F.coalesce(F.sum("unit_price"), F.lit(0).cast("decimal(15,2)"))).scalar()
    return (
        m.customers.select("customer_id", "company_name", "customer_tier", "industry")
        .join(owned, "customer_id")
        .select(
            "company_name",
            "customer_tier",
            "industry",
            "products_owned",
            "current_rev",
            (on_sale_count - F.col("owned_active")).alias("missing_product_count"),
            (on_sale_price - F.col("owned_active_price")).alias("potential_expansion_value"),
        )
    )


def owned_categories(m: Model) -> DataFrame:
    """Per customer: sorted, comma-separated list of distinct owned product categories.

    The list is bounded by the number of categories; the full product list of a
    customer is ``owned_products``, one row per product.
    """
    return (
        owned_products(m)
        .select("customer_id", "product_category")
        .distinct()
        .groupBy("customer_id")
        .agg(
            F.array_join(F.array_sort(F.collect_set("product_category")), ", ").alias(
                "owned_categories")
        )
    )


def owned_product_names(m: Model, customer_id) -> DataFrame:
    """One row for one customer: the sorted, comma-separated names of owned products."""
    mine = m.replace(deals=m.deals.where(F.col("customer_id") == F.lit(customer_id)))
    return owned_products(mine).agg(
        F.array_join(F.array_sort(F.collect_set("product_name")), ", ").alias("products_owned"))
