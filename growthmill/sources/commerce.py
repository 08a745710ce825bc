"""E-commerce order and customer payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.sources.crm import stack

SHOPIFY_ORDER_PAYLOAD = """
    id bigint, created_at string, updated_at string, email string, financial_status string,
    fulfillment_status string, total_price string, subtotal_price string, total_tax string,
    total_discounts string, currency string, customer struct<id: bigint>,
    line_items array<struct<id: bigint>>, discount_codes array<struct<code: string>>,
    source_name string, referring_site string, landing_site string, cancelled_at string"""

SHOPIFY_CUSTOMER_PAYLOAD = """
    id bigint, email string, first_name string, last_name string, created_at string, updated_at string,
    orders_count bigint, total_spent string, accepts_marketing boolean, tags string, state string,
    currency string"""


def _price(name: str) -> Column:
    return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0)).alias(name)


def flatten_shopify_orders(df: DataFrame) -> DataFrame:
    codes = F.transform("discount_codes", lambda c: F.coalesce(c["code"], F.lit("")))
    return df.select(
        F.col("id").alias("order_id"),
        F.try_to_timestamp(F.col("created_at")).alias("created_at"),
        "updated_at",
        "email",
        "financial_status",
        "fulfillment_status",
        *[_price(name) for name in ("total_price", "subtotal_price", "total_tax", "total_discounts")],
        "currency",
        F.col("customer.id").alias("customer_id"),
        "source_name",
        "referring_site",
        "landing_site",
        "cancelled_at",
        F.when(F.col("line_items").isNull(), 0).otherwise(F.size("line_items")).alias("item_count"),
        F.coalesce(F.array_join(codes, ","), F.lit("")).alias("discount_codes"),
    )


def flatten_shopify_customers(df: DataFrame) -> DataFrame:
    return df.withColumn("created_at", F.try_to_timestamp(F.col("created_at")))


def stack_shopify(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Flat orders and customers in one table; ``record_id`` is the key both kinds have."""
    stacked = stack({"order": orders, "customer": customers})
    return stacked.withColumn("record_id", F.coalesce("order_id", "id"))
