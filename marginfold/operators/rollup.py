"""Pre-aggregation of the fact shared by the reports."""

from pyspark.sql import Column, DataFrame, functions as F

from marginfold.functions.money import cents, per_unit, total_cents
from marginfold.schemas import PERCENT

# The money columns of the fact that reports add up.
MEASURES = [
    "item_revenue",
    "item_cogs",
    "gross_profit",
    "logistics_cost",
    "payment_fee",
    "discount_allocated",
    "return_cost",
    "contribution_margin",
    "cac_allocation",
    "net_profit",
]

_SUMMED = [*MEASURES, "first_revenue", "first_net", "net_margin_sum", "cm_margin_sum"]
_COUNTED = ["lines", "net_margin_lines", "cm_margin_lines", "leak_lines", "losing_lines", "returned_lines"]


def per_order(fact: DataFrame, *dims: str) -> DataFrame:
    """Fact rows folded to one per order, customer and ``dims``.

    Distinct orders then are a row count and distinct customers one grouping away, so reports
    with several distinct counts need no row expansion of the fact. Lines of an order meet
    map-side, which also flattens huge orders. Money is in whole cents and percentages in
    hundredths; measures a report does not use are pruned.
    """
    return fact.groupBy("order_id", "customer_id", *dims).agg(
        *[total_cents(m).alias(m) for m in MEASURES],
        total_cents("if(is_first_order, item_revenue, NULL)").alias("first_revenue"),
        total_cents("if(is_first_order, net_profit, NULL)").alias("first_net"),
        total_cents("net_margin_pct").alias("net_margin_sum"),
        F.count("net_margin_pct").alias("net_margin_lines"),
        total_cents("contribution_margin_pct").alias("cm_margin_sum"),
        F.count("contribution_margin_pct").alias("cm_margin_lines"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if("is_profit_leak").alias("leak_lines"),
        F.count_if(F.col("net_profit") < 0).alias("losing_lines"),
        F.count_if("return_flag").alias("returned_lines"),
        F.bool_or("is_first_order").alias("is_first"),
        F.bool_or("return_flag").alias("is_returned"),
        F.min("order_date").alias("first_date"),
        F.max("order_date").alias("last_date"),
        # The alphabetically last category stands for the order.
        F.max("category").alias("primary_category"),
    )


# What is the same for all lines of an order and some report groups by.
ORDER_DIMS = [
    "order_month",
    "order_year",
    "month_label",
    "order_channel",
    "customer_segment",
    "acquisition_channel",
    "customer_state",
]


def order_rows(fact: DataFrame) -> DataFrame:
    """The fact at order grain, from which all reports but the category one follow."""
    return per_order(fact, *ORDER_DIMS)


# What the headline takes of each line, NULL or false where a line does not count.
_LINE_SUMS = {m: cents(m) for m in (*MEASURES, "net_margin_pct")}
_LINE_FLAGS = {
    "lines": "true",
    "net_margin_lines": "net_margin_pct IS NOT NULL",
    "leak_lines": "is_profit_leak",
    "losing_lines": "net_profit < 0",
    "returned_lines": "return_flag",
}


def headline(fact: DataFrame, *dims: str) -> DataFrame:
    """One row, or one per ``dims``: the sums and counts of all lines, and orders, customers, first_orders, returned_orders.

    The fact is evaluated once, written or not. Each line is taken twice: for the sums, which meet where
    the lines are, and for its order and customer, which are shuffled to be counted with all sums empty.
    """
    taken = fact.select(
        *dims,
        "order_id",
        "customer_id",
        F.expr("is_first_order").alias("is_first"),
        F.expr("return_flag").alias("is_returned"),
        *[F.expr(amount).alias(name) for name, amount in _LINE_SUMS.items()],
        *[F.expr(flag).alias(name) for name, flag in _LINE_FLAGS.items()],
        F.explode(F.array(F.lit(False), F.lit(True))).alias("as_key"),
    )
    as_sum = ~F.col("as_key")
    keys = [F.when(F.col("as_key"), F.col(name)).alias(name) for name in ("order_id", "customer_id")]
    met = taken.groupBy("as_key", *dims, *keys).agg(
        *[F.sum(F.when(as_sum, F.col(name))).alias(name) for name in _LINE_SUMS],
        *[F.count_if(as_sum & F.col(name)).alias(name) for name in _LINE_FLAGS],
        F.bool_or(F.when(F.col("as_key"), F.col("is_first"))).alias("is_first"),
        F.bool_or(F.when(F.col("as_key"), F.col("is_returned"))).alias("is_returned"),
    )
    counted = met.groupBy(*dims).agg(
        *[F.sum(name).alias(name) for name in _LINE_SUMS],
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _LINE_FLAGS],
        F.count("order_id").alias("orders"),
        F.count_distinct("customer_id").alias("customers"),
        F.count_if("is_first").alias("first_orders"),
        F.count_if("is_returned").alias("returned_orders"),
    )
    return counted.withColumnRenamed("net_margin_pct", "net_margin_sum")


def add_up() -> list[Column]:
    """Sums of the measures and counts of ``per_order`` rows, under their own names."""
    return [F.sum(c).alias(c) for c in (*_SUMMED, *_COUNTED)]


def mean_net_margin() -> Column:
    """Unweighted mean of the lines' net margin percentages."""
    return per_unit("net_margin_sum", "net_margin_lines", PERCENT)


def mean_contribution_margin() -> Column:
    return per_unit("cm_margin_sum", "cm_margin_lines", PERCENT)


# Revenue that did not become net profit, at most the revenue itself.
LEAKED = "(item_revenue - greatest(net_profit, 0))"
