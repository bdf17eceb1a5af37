"""Dimension views."""

from pyspark.sql import DataFrame, functions as F


def dim_products(products: DataFrame) -> DataFrame:
    """Product attributes, from staged products."""
    return products.select(
        "product_id",
        "category",
        "cost_ratio",
        "list_price_min",
        "list_price_max",
        "avg_list_price",
        "weight_g",
        "volumetric_weight_kg",
    )


def dim_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with their order history; orders are counted before the join."""
    history = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    )
    return customers.join(history, "customer_id", "left").select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_segment",
        "acquisition_channel",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_lifespan_days"),
    )
