"""Star-schema order tables as the canonical raw inputs.

Maps ``orders lineitem customer nation part events`` to the seven raw tables, so that every
operator runs on them unchanged. Prices are scaled down by 100.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marginfold.functions.ranking import row_number_by
from marginfold.params import DEFAULT_PARAMS, EconomicsParams
from marginfold.schemas import MONEY, RAW_COLUMNS
from marginfold.sources.layers import COMPRESSION, replace_table, table_path
from marginfold.sources.scratch import discard, scratch_folder, written

# Order priority to order channel.
CHANNEL_OF_PRIORITY = {
    "1": "paid_search",
    "2": "social_ads",
    "3": "email",
    "4": "marketplace",
    "5": "organic_search",
}
# Acquisition channel by customer key modulo 6.
ACQUISITION_CHANNELS = ["marketplace", "organic_search", "paid_search", "social_ads", "email", "referral"]
# Event type to lead channel; anything else comes from display ads.
LEAD_CHANNEL_OF_EVENT = {
    "view": "marketplace",
    "click": "paid_search",
    "signup": "organic_search",
    "purchase": "email",
}
# Payment type by return flag and line status; other lines were paid by wallet.
PAYMENT_TYPE_OF_LINE = {
    "AF": "credit_card",
    "AO": "debit_card",
    "NF": "upi",
    "NO": "voucher",
}
# What order lines and payments take from line items.
LINE_COLUMNS = (
    "l_orderkey l_linenumber l_partkey l_suppkey l_extendedprice l_tax l_shipdate l_returnflag l_linestatus"
).split()
# A lead whose event is worth this much or more is a closed deal.
DEAL_VALUE = 100


def _choose(key: Column, table: dict[str, str], otherwise: str | None) -> Column:
    (first, value), *rest = table.items()
    chain = F.when(key == first, value)
    for name, value in rest:
        chain = chain.when(key == name, value)
    return chain.otherwise(F.lit(otherwise))


def _hundredths(column: str) -> Column:
    """A two-decimal double as a whole number of hundredths."""
    return F.rint(F.col(column) * 100).cast("bigint")


def _cents(hundredths: Column, scale: int) -> Column:
    """Whole cents of an unscaled product, rounded half up; all inputs are positive."""
    return F.floor((hundredths * 2 + scale) / (2 * scale)).cast("bigint")


def _price() -> Column:
    return _cents(_hundredths("l_extendedprice"), 100)


def _part_of_price(rate: str) -> Column:
    return _cents(_hundredths("l_extendedprice") * _hundredths(rate), 10_000)


def _money(cents: Column) -> Column:
    return (cents.cast("decimal(14,0)") / F.lit(100).cast("decimal(3,0)")).cast(MONEY)


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _after(start: Column, days: Column, hours: Column) -> Column:
    return start + F.make_dt_interval(days.cast("int"), hours.cast("int"))


class StarTables:
    """Lazy canonical inputs over a folder of star-schema Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str, params: EconomicsParams = DEFAULT_PARAMS):
        self._spark, self._folder, self._params = spark, folder, params
        self._lines_path: str | None = None

    def _read(self, table: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{table}.parquet")

    @cached_property
    def _lines(self) -> DataFrame:
        """Line items numbered within their order; ``l_linenumber`` alone repeats.

        Lines and payments both read them, so they are shuffled and sorted once and written.
        """
        numbered = row_number_by(
            self._read("lineitem").select(*LINE_COLUMNS),
            key=F.col("l_orderkey"),
            order_by=[
                F.asc(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
            ],
            out="line_id",
        )
        self._lines_path = scratch_folder(self._spark)
        return written(numbered, self._lines_path, COMPRESSION)

    def release(self) -> None:
        """Delete the numbered lines. Frames over them end here; lines asked for again are numbered again."""
        if self.__dict__.pop("_lines", None) is not None:
            discard(self._spark, self._lines_path)

    def orders(self) -> DataFrame:
        discounts = (
            self._read("lineitem").groupBy("l_orderkey").agg(F.sum(_part_of_price("l_discount")).alias("discount"))
        )
        key, start = F.col("o_orderkey"), F.col("o_orderdate").cast(T.TimestampNTZType())
        status = (
            F.when(F.col("o_orderstatus") == "F", "delivered")
            .when(F.col("o_orderstatus") == "P", "returned")
            .when(key % 5 == 0, "canceled")
            .otherwise("shipped")
        )
        no_days, no_hours = F.lit(0), F.lit(0)
        return (
            self._read("orders")
            .join(discounts, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            .select(
                _text("o_orderkey").alias("order_id"),
                _text("o_custkey").alias("customer_id"),
                status.alias("order_status"),
                start.alias("order_purchase_timestamp"),
                F.when(key % 13 != 0, _after(start, no_days, key % 48)).alias("order_approved_at"),
                _after(start, F.lit(1), no_hours).alias("order_delivered_carrier_date"),
                _after(start, key % 40, key % 24).alias("order_delivered_customer_date"),
                _after(start, F.lit(20), no_hours).alias("order_estimated_delivery_date"),
                F.when(key % 11 != 0, _money(F.col("discount"))).alias("order_discount_amount"),
                _choose(F.substring("o_orderpriority", 1, 1), CHANNEL_OF_PRIORITY, None).alias("order_channel"),
            )
        )

    def order_items(self) -> DataFrame:
        return self._lines.select(
            _text("l_orderkey").alias("order_id"),
            F.col("line_id").alias("order_item_id"),
            _text("l_partkey").alias("product_id"),
            _text("l_suppkey").alias("seller_id"),
            F.col("l_shipdate").alias("shipping_limit_date"),
            _money(_price()).alias("price"),
            _money(_part_of_price("l_tax")).alias("freight_value"),
        )

    def order_payments(self) -> DataFrame:
        return self._lines.select(
            _text("l_orderkey").alias("order_id"),
            F.col("line_id").alias("payment_sequential"),
            _choose(F.concat("l_returnflag", "l_linestatus"), PAYMENT_TYPE_OF_LINE, "wallet").alias("payment_type"),
            F.col("l_linenumber").alias("payment_installments"),
            _money(_price()).alias("payment_value"),
        )

    def products(self) -> DataFrame:
        size, price = F.col("p_size"), F.floor("p_retailprice").cast("int")
        return self._read("part").select(
            _text("p_partkey").alias("product_id"),
            F.col("p_type").alias("product_category_name"),
            F.length("p_name").alias("product_name_lenght"),
            F.length("p_brand").alias("product_description_lenght"),
            (size % 6).alias("product_photos_qty"),
            (size * 100).alias("product_weight_g"),
            (size + 10).alias("product_length_cm"),
            (size % 20 + 5).alias("product_height_cm"),
            (size % 15 + 8).alias("product_width_cm"),
            price.alias("list_price_min"),
            (price + size).alias("list_price_max"),
            ((size + 30) / F.lit(100).cast("decimal(3,0)")).cast("decimal(6,4)").alias("estimated_cost_ratio"),
        )

    def customers(self) -> DataFrame:
        channel = _choose(
            F.col("c_custkey") % 6, {i: name for i, name in enumerate(ACQUISITION_CHANNELS)}, None
        )
        nations = self._read("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self._read("customer")
            .join(nations, "c_nationkey", "left")
            .select(
                _text("c_custkey").alias("customer_id"),
                F.col("c_name").alias("customer_unique_id"),
                F.concat(F.lit("City "), "c_nationkey").alias("customer_city"),
                F.col("n_name").alias("customer_state"),
                F.col("c_mktsegment").alias("customer_segment"),
                channel.alias("acquisition_channel"),
            )
        )

    def marketing_qualified_leads(self) -> DataFrame:
        return self._read("events").select(
            _text("event_id").alias("mql_id"),
            F.to_date("ts").alias("first_contact_date"),
            _text("user_id").alias("landing_page_id"),
            _choose(F.col("event_type"), LEAD_CHANNEL_OF_EVENT, "display").alias("origin"),
        )

    def closed_deals(self) -> DataFrame:
        unused = ["sdr_id", "sr_id", "lead_behaviour_profile", "has_company", "has_gtin", "average_stock"]
        return (
            self._read("events")
            .filter(F.col("value") >= DEAL_VALUE)
            .select(
                _text("event_id").alias("mql_id"),
                _text("user_id").alias("seller_id"),
                *[F.lit(None).cast("string").alias(c) for c in unused],
                F.date_add(F.to_date("ts"), (F.col("event_id") % 30).cast("int")).alias("won_date"),
                F.col("event_type").alias("business_segment"),
                F.when(F.col("value") >= 2 * DEAL_VALUE, "offline").otherwise("online_medium").alias("lead_type"),
                F.lit("reseller").alias("business_type"),
                F.lit(None).cast("string").alias("declared_product_catalog_size"),
                (F.col("value").cast("decimal(12,2)") * 1000).cast("decimal(18,2)").alias("declared_monthly_revenue"),
            )
        )

    def write(self, name: str, root: str) -> None:
        """Write one raw table below ``root``, as CSV ingestion would."""
        frame = getattr(self, name)()
        replace_table(frame, table_path(root, "raw", name), nulls_of=frame.columns)


def write_raw_layer(spark: SparkSession, folder: str, root: str, params: EconomicsParams = DEFAULT_PARAMS) -> None:
    """Write all canonical raw tables below ``root``."""
    tables = StarTables(spark, folder, params)
    for name in RAW_COLUMNS:
        tables.write(name, root)
