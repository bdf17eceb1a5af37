"""Column types and the layout of the raw tables and the fact."""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
ORDER_MONEY = T.DecimalType(14, 2)
TOTAL = T.DecimalType(18, 2)
# A line sold for a cent can lose more than a million percent.
PERCENT = T.DecimalType(18, 2)
# Amounts and cost ratios as they come in, before anything is rounded.
AMOUNT_IN = T.DecimalType(20, 8)
RATIO_IN = T.DecimalType(16, 10)
SHARE = T.DecimalType(9, 6)

# Columns of the raw tables, all text, spelled as in the source files.
RAW_COLUMNS = {
    "orders": [
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_approved_at",
        "order_delivered_carrier_date",
        "order_delivered_customer_date",
        "order_estimated_delivery_date",
        "order_discount_amount",
        "order_channel",
    ],
    "order_items": [
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
    ],
    "order_payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "products": [
        "product_id",
        "product_category_name",
        "product_name_lenght",
        "product_description_lenght",
        "product_photos_qty",
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        "list_price_min",
        "list_price_max",
        "estimated_cost_ratio",
    ],
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_segment",
        "acquisition_channel",
    ],
    "marketing_qualified_leads": [
        "mql_id",
        "first_contact_date",
        "landing_page_id",
        "origin",
    ],
    "closed_deals": [
        "mql_id",
        "seller_id",
        "sdr_id",
        "sr_id",
        "won_date",
        "business_segment",
        "lead_type",
        "lead_behaviour_profile",
        "has_company",
        "has_gtin",
        "average_stock",
        "business_type",
        "declared_product_catalog_size",
        "declared_monthly_revenue",
    ],
}


def raw_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in RAW_COLUMNS[table]])


FACT_SCHEMA = T.StructType(
    [
        T.StructField("order_item_key", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("order_item_id", T.IntegerType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("seller_id", T.StringType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("order_month", T.DateType()),
        T.StructField("order_year", T.IntegerType()),
        T.StructField("order_quarter", T.IntegerType()),
        T.StructField("month_label", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("customer_segment", T.StringType()),
        T.StructField("customer_state", T.StringType()),
        T.StructField("order_channel", T.StringType()),
        T.StructField("acquisition_channel", T.StringType()),
        T.StructField("primary_payment_type", T.StringType()),
        T.StructField("return_flag", T.BooleanType()),
        T.StructField("is_late_delivery", T.BooleanType()),
        T.StructField("is_first_order", T.BooleanType()),
        T.StructField("customer_order_seq", T.LongType()),
        T.StructField("item_revenue_share", SHARE),
        T.StructField("item_revenue", MONEY),
        T.StructField("item_cogs", MONEY),
        T.StructField("gross_profit", MONEY),
        T.StructField("gross_margin_pct", PERCENT),
        T.StructField("logistics_cost", MONEY),
        T.StructField("payment_fee", MONEY),
        T.StructField("discount_allocated", MONEY),
        T.StructField("return_cost", MONEY),
        T.StructField("contribution_margin", MONEY),
        T.StructField("contribution_margin_pct", PERCENT),
        T.StructField("cac_allocation", MONEY),
        T.StructField("net_profit", MONEY),
        T.StructField("net_margin_pct", PERCENT),
        T.StructField("is_profit_leak", T.BooleanType()),
    ]
)
