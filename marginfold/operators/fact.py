"""The order-line fact: joins, allocation of order-level costs, cost cascade.

Staged tables come in with decimal money. From the joined base up to the final projection the
amounts that are computed with are whole cents and percentages are hundredths, both BIGINT. What
can be computed before the join, per order or per line, is; so the step with all the arithmetic
generates little enough code for the JVM to compile it to machine code as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marginfold.functions.money import cents, half_up, money, share_of, total_cents
from marginfold.params import DEFAULT_PARAMS, EconomicsParams
from marginfold.schemas import FACT_SCHEMA, MONEY, ORDER_MONEY, PERCENT, TOTAL


def _line_block(params: EconomicsParams) -> Column:
    """Block of line numbers a line falls in.

    ``(order_id, order_item_id)`` is a key, so a block never holds more than ``rows_per_task``
    lines: joining on order and block spreads an order of any size over several tasks.
    """
    return F.expr(f"cast((order_item_id - 1) div {params.rows_per_task} as int)")


def _order_spans(lines: DataFrame, params: EconomicsParams) -> DataFrame:
    """Revenue in cents, number of lines, and the blocks that hold lines, per order.

    Sets are collected only of the lines behind the first block, of which few orders have any: the fold
    of all lines has counts and sums alone, so no task sorts its lines for it.
    """
    block = _line_block(params)
    spans = lines.groupBy("order_id").agg(
        total_cents("selling_price").alias("order_total_revenue"),
        F.count(F.lit(1)).alias("item_count"),
        F.count_if(block == 0).alias("_near"),
    )
    # At most one block per line.
    far = (
        lines.filter(block != 0)
        .groupBy("order_id")
        .agg(F.collect_set(block).alias("_far"))
    )
    none = F.array().cast("array<int>")
    near = F.when(F.col("_near") > 0, F.array(F.lit(0))).otherwise(none)
    return spans.join(far, "order_id", "left").select(
        "order_id", "order_total_revenue", "item_count", F.concat(near, F.coalesce("_far", none)).alias("_blocks")
    )


def order_totals(lines: DataFrame) -> DataFrame:
    """Revenue and number of lines per order, from lines with their price."""
    return lines.groupBy("order_id").agg(
        F.sum("selling_price").cast(ORDER_MONEY).alias("order_total_revenue"), F.count(F.lit(1)).alias("item_count")
    )


def _join_lines(items: DataFrame, prices: DataFrame, orders: DataFrame, params: EconomicsParams) -> DataFrame:
    """Lines, in cents, with the columns of their order and its totals from ``prices``.

    The order row is repeated once per block of its lines, which is once for all but huge orders.
    """
    per_block = orders.join(_order_spans(prices, params), "order_id").select(
        "*",
        # Divisor of every revenue share and half of it, once per order.
        F.expr("nullif(order_total_revenue, 0)").alias("_whole"),
        F.expr("abs(order_total_revenue) div 2").alias("_half"),
        F.explode("_blocks").alias("_block"),
    )
    lines = items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "category",
        "gross_profit",
        "gross_margin_pct",
        *[F.expr(cents(m)).alias(m) for m in ("selling_price", "unit_cogs", "logistics_cost")],
        F.expr(cents(_cost_if_returned(params))).alias("_cost_if_returned"),
        _line_block(params).alias("_block"),
    )
    return lines.join(per_block, ["order_id", "_block"]).drop("_block", "_blocks")


def _cost_if_returned(params: EconomicsParams) -> str:
    """Reverse freight plus restocking as money, the rates taken in full."""
    reverse, restocking = params.reverse_logistics_multiplier, params.restocking_rate
    return f"cast(round(logistics_cost * {reverse:f}BD + unit_cogs * {restocking:f}BD, 2) as {MONEY.simpleString()})"


def return_costs(items: DataFrame, orders: DataFrame, params: EconomicsParams = DEFAULT_PARAMS) -> DataFrame:
    """Reverse freight plus restocking for every line of a returned order, else 0."""
    cost = f"if(return_flag, {_cost_if_returned(params)}, 0)"
    return items.join(orders.select("order_id", "return_flag"), "order_id").select(
        "order_id", "order_item_id", F.expr(cost).cast(MONEY).alias("return_cost")
    )


def channel_cac(funnel: DataFrame) -> DataFrame:
    """Acquisition cost per new customer and channel, 0 where unknown."""
    return funnel.select(
        "channel", F.coalesce("estimated_cac", F.lit(0).cast(TOTAL)).alias("cac_per_new_customer")
    )


def fact_base(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    cac: DataFrame,
    params: EconomicsParams = DEFAULT_PARAMS,
    prices: DataFrame | None = None,
) -> DataFrame:
    """Every column the metrics need, one row per line.

    Money is in cents, but for gross profit, margin and the order's discount, which pass through
    unchanged. ``prices`` may give the lines' prices from nearer to their source; order totals come
    from them, so that lines need not be joined with their products twice.

    Everything at order grain is joined first, so the lines are shuffled once. Orders without a
    customer or a payment drop out; unknown products stay with NULL costs.
    """
    # Only channels with a configured spend carry a cost, so these are as few as the parameters name; all others
    # cost 0 either way. As one value they reach the orders where these are: joined, the orders could be shuffled
    # by channel, into as few tasks as there are channels.
    charged = (
        cac.filter((F.col("cac_per_new_customer") != 0) & F.col("channel").isNotNull())
        .groupBy("channel")
        .agg(F.collect_list(F.expr(cents("cac_per_new_customer"))).alias("costs"))
        .agg(F.map_from_entries(F.collect_list(F.struct("channel", "costs"))))
        .scalar()
    )
    headers = (
        orders.select(
            "order_id",
            "customer_id",
            "order_date",
            "order_month",
            F.year("order_date").alias("order_year"),
            F.quarter("order_date").alias("order_quarter"),
            F.date_format("order_date", "MMM yyyy").alias("month_label"),
            "order_channel",
            "return_flag",
            "is_late_delivery",
            "customer_order_seq",
            (F.col("customer_order_seq") == 1).alias("is_first_order"),
            F.col("discount_amount").alias("order_discount"),
        )
        .join(
            customers.select("customer_id", "customer_segment", "customer_state", "acquisition_channel"),
            "customer_id",
        )
        .join(
            payments.select(
                "order_id", "primary_payment_type", F.expr(cents("total_payment_fee")).alias("order_payment_fee")
            ),
            "order_id",
        )
        .withColumn("channel_cac", F.explode_outer(F.element_at(charged, F.col("order_channel"))))
        .withColumn("channel_cac", F.expr("coalesce(channel_cac, 0L)"))
    )
    return _join_lines(items, prices or items, headers, params).select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "seller_id",
        "order_date",
        "order_month",
        "order_year",
        "order_quarter",
        "month_label",
        "category",
        "customer_segment",
        "customer_state",
        "order_channel",
        "acquisition_channel",
        "primary_payment_type",
        "return_flag",
        "is_late_delivery",
        "customer_order_seq",
        "is_first_order",
        F.col("selling_price").alias("item_revenue"),
        F.col("unit_cogs").alias("item_cogs"),
        "gross_profit",
        "gross_margin_pct",
        "logistics_cost",
        F.expr("if(return_flag, _cost_if_returned, 0L)").alias("return_cost"),
        "order_payment_fee",
        "order_discount",
        "order_total_revenue",
        "item_count",
        "channel_cac",
        "_whole",
        "_half",
    )


# The order's discount, as it came in, in units of a millionth of a cent.
_DISCOUNT_UNITS = 1_000_000
_DISCOUNT = "order_discount * 100000000BD"


def _share(cost: str, units: int = 1) -> str:
    return share_of(cost, "item_revenue", "_whole", units, half="_half")


def allocate_by_revenue_share(lines: DataFrame, cost: str, out: str) -> DataFrame:
    """Spread an order-level cost over the lines by revenue; NULL for an order without revenue."""
    share = _share(_DISCOUNT, _DISCOUNT_UNITS) if cost == "order_discount" else _share(cost)
    return lines.withColumn(out, F.expr(share))


def revenue_share(lines: DataFrame, out: str = "item_revenue_share") -> DataFrame:
    """The line's part of the order's revenue, in millionths."""
    return lines.withColumn(
        out, F.expr("(item_revenue * 1000000 + if(item_revenue < 0, -_half, _half)) div _whole")
    )


def allocate_cac(lines: DataFrame) -> DataFrame:
    """Charge the channel's acquisition cost to the customer's first order, by revenue share."""
    return lines.withColumn("cac_allocation", F.expr(f"if(is_first_order, {_share('channel_cac')}, 0L)"))


def cost_cascade(lines: DataFrame) -> DataFrame:
    """Contribution margin, net profit, their percentages and the loss flag."""
    margin = "item_revenue - item_cogs - logistics_cost - payment_fee - discount_allocated - return_cost"
    return (
        lines.withColumn("contribution_margin", F.expr(margin))
        .withColumn("net_profit", F.expr("contribution_margin - cac_allocation"))
        .withColumns(
            {
                "contribution_margin_pct": F.expr(half_up("contribution_margin * 10000", "item_revenue")),
                "net_margin_pct": F.expr(half_up("net_profit * 10000", "item_revenue")),
                "is_profit_leak": F.expr("net_profit < 0"),
            }
        )
    )


def allocate_costs(base: DataFrame) -> DataFrame:
    lines = revenue_share(base)
    lines = allocate_by_revenue_share(lines, "order_payment_fee", "payment_fee")
    lines = allocate_by_revenue_share(lines, "order_discount", "discount_allocated")
    return allocate_cac(lines)


def fact_order_items(
    items: DataFrame,
    orders: DataFrame,
    customers: DataFrame,
    payments: DataFrame,
    funnel: DataFrame,
    params: EconomicsParams = DEFAULT_PARAMS,
    prices: DataFrame | None = None,
) -> DataFrame:
    """One row per order line with the full cascade from revenue to net profit."""
    return lines_of(fact_base(items, orders, customers, payments, channel_cac(funnel), params, prices))


def lines_of(base: DataFrame) -> DataFrame:
    """The fact's lines from its base; each line by itself, so the base may be moved or written before."""
    return in_fact_types(cost_cascade(allocate_costs(base))).select(*[f.name for f in FACT_SCHEMA])


def in_fact_types(lines: DataFrame) -> DataFrame:
    """Key the lines and turn cents, hundredths and millionths into the fact's decimals."""
    typed = {
        f.name: money(f.name, f.dataType)
        for f in FACT_SCHEMA
        if f.dataType in (MONEY, PERCENT) and f.name not in ("gross_profit", "gross_margin_pct")
    }
    return lines.withColumns(
        {
            **typed,
            "item_revenue_share": F.expr(
                "cast(cast(item_revenue_share as decimal(9,0)) * 0.000001BD as decimal(9,6))"
            ),
            "order_item_key": F.concat("order_id", F.lit("-"), F.col("order_item_id").cast("string")),
        }
    )
