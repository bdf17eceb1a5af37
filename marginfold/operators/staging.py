"""Raw text tables to typed, filtered staging tables."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marginfold.functions.lookup import lookup
from marginfold.functions.money import half_up, half_up_wide, money, percent, per_unit
from marginfold.functions.ranking import row_number_by
from marginfold.params import DEFAULT_PARAMS, EconomicsParams
from marginfold.schemas import AMOUNT_IN, MONEY, ORDER_MONEY, PERCENT, RATIO_IN, TOTAL

# Fee rates may have six places.
_RATE_UNIT = Decimal("0.000001")


def _timestamp(column: str) -> Column:
    return F.col(column).cast(T.TimestampNTZType())


def completed_orders(orders: DataFrame, params: EconomicsParams = DEFAULT_PARAMS) -> DataFrame:
    """Raw orders that went through: delivered, or delivered and returned."""
    return orders.filter(F.col("order_status").isin(*params.completed_statuses))


def stage_orders(orders: DataFrame, params: EconomicsParams = DEFAULT_PARAMS) -> DataFrame:
    """Completed orders with parsed times, delivery performance and the customer's order sequence.

    The sequence counts completed orders only. Equal timestamps are ordered by ``order_id``.
    """
    typed = completed_orders(orders, params).select(
        "order_id",
        "customer_id",
        "order_status",
        _timestamp("order_purchase_timestamp").alias("order_purchase_at"),
        _timestamp("order_approved_at").alias("order_approved_at"),
        _timestamp("order_delivered_carrier_date").alias("shipped_at"),
        _timestamp("order_delivered_customer_date").alias("delivered_at"),
        _timestamp("order_estimated_delivery_date").alias("estimated_delivery_at"),
        F.to_date(_timestamp("order_purchase_timestamp")).alias("order_date"),
        F.trunc(F.to_date(_timestamp("order_purchase_timestamp")), "month").alias("order_month"),
        F.coalesce(F.col("order_discount_amount").cast(AMOUNT_IN), F.lit(0).cast(AMOUNT_IN)).alias("discount_amount"),
        "order_channel",
        (F.col("order_status") == params.returned_status).alias("return_flag"),
    )
    lag = "(order_approved_at - order_purchase_at)"
    # Field by field: an interval itself must not be multiplied, it would overflow after some months.
    approval_micros = (
        f"(((extract(day from {lag}) * 24 + extract(hour from {lag})) * 60 + extract(minute from {lag})) * 60000000L"
        f" + cast(extract(second from {lag}) * 1000000 as bigint))"
    )
    derived = typed.select(
        "*",
        # Whole days of the difference, towards zero: 12 hours late is 0 days, yet late.
        F.extract(F.lit("DAY"), F.col("delivered_at") - F.col("estimated_delivery_at"))
        .cast("int")
        .alias("delivery_delay_days"),
        F.coalesce(F.col("delivered_at") > F.col("estimated_delivery_at"), F.lit(False)).alias("is_late_delivery"),
        # Purchase to approval.
        money(half_up_wide(approval_micros, 100, "3600000000")).alias("approval_lag_hours"),
    )
    return row_number_by(
        derived,
        # Orders without a customer form one group of their own, apart from every id.
        key=F.coalesce(F.concat(F.lit("="), "customer_id"), F.lit("")),
        order_by=[F.asc_nulls_last("order_purchase_at"), F.asc("order_id")],
        out="customer_order_seq",
    )


def line_prices(items: DataFrame) -> DataFrame:
    """Order lines with their price, all that order totals need."""
    return items.select(
        "order_id",
        F.col("order_item_id").cast("int").alias("order_item_id"),
        F.round(F.col("price").cast(AMOUNT_IN), 2).cast(MONEY).alias("selling_price"),
    )


def line_economics(items: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with price, cost of goods and freight; unknown products keep NULL costs.

    Costs and profits come from the price and ratio as given and are rounded once.
    """
    ratio = F.col("estimated_cost_ratio").cast(RATIO_IN)
    ratios = products.select(
        "product_id",
        F.col("product_category_name").alias("category"),
        ratio.alias("cost_ratio"),
        F.round((1 - ratio) * 100, 2).cast(PERCENT).alias("gross_margin_pct"),
    )
    return (
        items.select(
            "order_id",
            F.col("order_item_id").cast("int").alias("order_item_id"),
            "product_id",
            "seller_id",
            F.col("price").cast(AMOUNT_IN).alias("price"),
            F.round(F.col("freight_value").cast(AMOUNT_IN), 2).cast(MONEY).alias("logistics_cost"),
        )
        .join(ratios, "product_id", "left")
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            "category",
            "cost_ratio",
            F.round("price", 2).cast(MONEY).alias("selling_price"),
            F.expr("cast(round(price * cost_ratio, 2) as decimal(12,2))").alias("unit_cogs"),
            "logistics_cost",
            # May differ by a cent from price - unit_cogs, being rounded on its own.
            F.expr("cast(round(price - price * cost_ratio, 2) as decimal(12,2))").alias("gross_profit"),
            "gross_margin_pct",
        )
    )


def stage_order_items(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of the given (completed) orders with their economics."""
    return line_economics(items.join(orders.select("order_id"), "order_id", "left_semi"), products)


def payments_by_order(payments: DataFrame, params: EconomicsParams = DEFAULT_PARAMS) -> DataFrame:
    """One row per order: payment count, dominant type, amount paid and gateway fee."""
    rate = lookup(F.col("payment_type"), params.fee_rates, _RATE_UNIT, params.default_fee_rate)
    paid = payments.select(
        "order_id",
        "payment_type",
        F.col("payment_sequential").cast("int").alias("sequence"),
        F.col("payment_installments").cast("int").alias("installments"),
        F.col("payment_value").cast(AMOUNT_IN).alias("amount"),
        rate.alias("rate"),
    )
    # Largest payment wins, then the lowest sequence; a missing amount loses to any other.
    size = F.struct("amount", -F.col("sequence"))
    # Amounts in units of 10^-8 and rates in units of 10^-6 are whole numbers, so sums are exact.
    units = "cast(amount * 100000000BD as decimal(20,0))"
    return (
        paid.groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("payment_count"),
            F.max_by("payment_type", size).alias("primary_payment_type"),
            F.max("installments").alias("max_installments"),
            F.expr(f"sum({units})").alias("paid"),
            F.expr(f"sum({units} * cast(rate as decimal(8,0)))").alias("weighted"),
        )
        .select(
            "order_id",
            "payment_count",
            "primary_payment_type",
            "max_installments",
            money(half_up("paid", "1000000L"), ORDER_MONEY).alias("total_payment_value"),
            money(half_up("weighted", "1000000000000L")).alias("total_payment_fee"),
            # weighted / 10^6 / paid in percent, 3 places
            F.expr(
                "cast(cast((weighted + if(weighted < 0, -5, 5) * abs(paid)) div nullif(paid * 10, 0)"
                " as decimal(9,0)) * 0.001BD as decimal(9,3))"
            ).alias("effective_fee_rate_pct"),
        )
    )


def stage_payments(
    payments: DataFrame, orders: DataFrame, params: EconomicsParams = DEFAULT_PARAMS
) -> DataFrame:
    """Payments of the given (completed) orders, aggregated before the join."""
    return payments_by_order(payments, params).join(orders.select("order_id"), "order_id", "left_semi")


def stage_products(products: DataFrame) -> DataFrame:
    def integer(column: str) -> Column:
        return F.col(column).cast("int")

    volume = integer("product_length_cm").cast("decimal(10,0)")
    volume = volume * integer("product_height_cm").cast("decimal(10,0)")
    volume = volume * integer("product_width_cm").cast("decimal(10,0)")
    return products.select(
        "product_id",
        F.col("product_category_name").alias("category"),
        integer("product_weight_g").alias("weight_g"),
        integer("product_length_cm").alias("length_cm"),
        integer("product_height_cm").alias("height_cm"),
        integer("product_width_cm").alias("width_cm"),
        integer("product_photos_qty").alias("photos_qty"),
        integer("list_price_min").alias("list_price_min"),
        integer("list_price_max").alias("list_price_max"),
        money(half_up("(cast(list_price_min as bigint) + cast(list_price_max as bigint)) * 100", "2")).alias(
            "avg_list_price"
        ),
        F.col("estimated_cost_ratio").cast(RATIO_IN).alias("cost_ratio"),
        F.round(volume / 5000, 3).cast("decimal(18,3)").alias("volumetric_weight_kg"),
    )


def stage_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_city",
        "customer_state",
        "customer_segment",
        "acquisition_channel",
    )


def stage_leads(leads: DataFrame) -> DataFrame:
    contact = F.col("first_contact_date").cast("date")
    return leads.select(
        "mql_id",
        F.col("origin").alias("channel"),
        contact.alias("first_contact_date"),
        F.trunc(contact, "month").alias("lead_month"),
    )


def stage_deals(deals: DataFrame, leads: DataFrame) -> DataFrame:
    """Won deals with the channel and first contact of their lead."""
    won = F.col("won_date").cast("date")
    origin = leads.select(
        "mql_id",
        F.col("origin").alias("channel"),
        F.col("first_contact_date").cast("date").alias("first_contact_date"),
    )
    return (
        deals.select(
            "mql_id",
            "seller_id",
            won.alias("won_date"),
            F.trunc(won, "month").alias("won_month"),
            "business_segment",
            "lead_type",
            "business_type",
            F.col("declared_monthly_revenue").cast(TOTAL).alias("declared_monthly_revenue"),
        )
        .join(origin, "mql_id", "left")
        .withColumn("days_to_close", F.datediff("won_date", "first_contact_date"))
    )


def channel_funnel(leads: DataFrame, deals: DataFrame, customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Leads, deals and buying customers per channel; spend and CAC still empty.

    Takes staged leads and deals, customers and completed orders.
    """
    buyers = orders.select("customer_id").distinct()
    per_channel = {
        "total_leads": leads.groupBy("channel").agg(F.count(F.lit(1)).alias("total_leads")),
        "total_deals": deals.groupBy("channel").agg(F.count(F.lit(1)).alias("total_deals")),
        "new_customers": customers.join(buyers, "customer_id", "left_semi")
        .groupBy(F.col("acquisition_channel").alias("channel"))
        .agg(F.count_distinct("customer_id").alias("new_customers")),
    }
    joined = (
        per_channel["total_leads"]
        .join(per_channel["total_deals"], "channel", "full_outer")
        .join(per_channel["new_customers"], "channel", "full_outer")
        .fillna(0, list(per_channel))
    )
    return joined.select(
        "channel",
        *per_channel,
        percent("total_deals", "total_leads").alias("lead_conversion_rate_pct"),
        F.lit(None).cast(TOTAL).alias("estimated_monthly_spend"),
        F.lit(None).cast(TOTAL).alias("estimated_cac"),
    )


def attach_spend(funnel: DataFrame, spend: Mapping[str, Decimal] = DEFAULT_PARAMS.monthly_spend) -> DataFrame:
    """Set monthly spend and CAC of the channels named in ``spend``; others keep what they have."""
    given = F.col("_given").isNotNull()
    cac = F.when(F.col("new_customers") > 0, per_unit("_given", "new_customers"))
    return (
        funnel.withColumn("_given", lookup(F.col("channel"), spend, Decimal("0.01")))
        .withColumns(
            {
                "estimated_monthly_spend": F.when(given, money("_given", TOTAL)).otherwise(
                    F.col("estimated_monthly_spend")
                ),
                "estimated_cac": F.when(given, cac).otherwise(F.col("estimated_cac")),
            }
        )
        .drop("_given")
    )
