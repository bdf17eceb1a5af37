"""Business reports over the fact.

Most take the fact's ``order_rows`` too, where a build has written them once for all reports.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marginfold.functions.money import cents, half_up_wide, money, per_unit, percent, ratio, total_cents
from marginfold.operators.rollup import (
    LEAKED,
    add_up,
    headline,
    mean_contribution_margin,
    mean_net_margin,
    order_rows,
)
from marginfold.schemas import TOTAL


def _orders() -> Column:
    return F.count("order_id").alias("orders")


def _amounts(**names: str) -> list[Column]:
    return [money(source, TOTAL).alias(out) for out, source in names.items()]


def _counts(**names: str) -> list[Column]:
    return [F.coalesce(source, F.lit(0)).alias(out) for out, source in names.items()]


def _of_revenue(**names: str) -> list[Column]:
    return [percent(source, "item_revenue").alias(out) for out, source in names.items()]


def _tier(value: Column, steps: list[tuple[int, str]], otherwise: str) -> Column:
    """First label whose lower bound the value reaches; NULL gets the last one."""
    (bound, label), *rest = steps
    chain = F.when(value >= bound, label)
    for bound, label in rest:
        chain = chain.when(value >= bound, label)
    return chain.otherwise(otherwise)


def summary_by_month(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    dims = ["order_month", "order_year", "month_label"]
    months = (orders or order_rows(fact)).groupBy(*dims).agg(_orders(), *add_up())
    return months.select(
        *dims,
        *_counts(total_orders="orders", total_line_items="lines"),
        *_amounts(
            total_revenue="item_revenue",
            total_cogs="item_cogs",
            total_logistics="logistics_cost",
            total_payment_fees="payment_fee",
            total_discounts="discount_allocated",
            total_return_costs="return_cost",
            total_contribution_margin="contribution_margin",
        ),
        mean_contribution_margin().alias("avg_cm_pct"),
        *_amounts(total_cac="cac_allocation", total_net_profit="net_profit"),
        mean_net_margin().alias("avg_net_margin_pct"),
        *_counts(profit_leak_items="leak_lines"),
    )


def category_profitability(fact: DataFrame) -> DataFrame:
    """Volume, costs, margins, returns and leakage per category."""
    sums = headline(fact, "category")
    biggest = F.greatest("item_cogs", "logistics_cost", "cac_allocation", "return_cost")
    driver = (
        F.when(F.col("item_cogs") == biggest, "COGS")
        .when(F.col("logistics_cost") == biggest, "Logistics")
        .when(F.col("cac_allocation") == biggest, "CAC")
        .otherwise("Returns")
    )
    report = sums.select(
        "category",
        *_counts(total_line_items="lines", total_orders="orders", total_customers="customers"),
        *_amounts(
            total_revenue="item_revenue",
            total_cogs="item_cogs",
            total_logistics_cost="logistics_cost",
            total_payment_fees="payment_fee",
            total_discounts="discount_allocated",
            total_return_cost="return_cost",
            total_cac_spend="cac_allocation",
        ),
        *_of_revenue(
            cogs_pct="item_cogs",
            logistics_pct="logistics_cost",
            payment_fee_pct="payment_fee",
            discount_pct="discount_allocated",
            return_cost_pct="return_cost",
            cac_pct="cac_allocation",
        ),
        *_amounts(total_gross_profit="gross_profit"),
        *_of_revenue(gross_margin_pct="gross_profit"),
        *_amounts(total_contribution_margin="contribution_margin"),
        *_of_revenue(cm_pct="contribution_margin"),
        *_amounts(total_net_profit="net_profit"),
        mean_net_margin().alias("avg_net_margin_pct"),
        *_counts(returned_items="returned_lines"),
        percent("returned_lines", "lines").alias("return_rate_pct"),
        *_amounts(profit_leaked_abs=LEAKED),
        *_of_revenue(leakage_pct=LEAKED),
        driver.alias("primary_cost_driver"),
    )
    # Lower bounds and labels of the tiers.
    return report.withColumn(
        "profitability_tier",
        _tier(
            F.col("avg_net_margin_pct"),
            [(15, "High Margin"), (5, "Moderate Margin"), (0, "Low Margin")],
            "Loss-Making",
        ),
    )


def loss_making_orders(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Orders with a negative net profit, their root cause and severity."""
    dims = [
        "order_id",
        "customer_id",
        "order_date",
        "order_month",
        "order_channel",
        "customer_segment",
        "return_flag",
        "is_first_order",
    ]
    measures = {
        "order_revenue": "item_revenue",
        "order_cogs": "item_cogs",
        "order_logistics": "logistics_cost",
        "order_payment_fee": "payment_fee",
        "order_discount": "discount_allocated",
        "order_return_cost": "return_cost",
        "order_gross_profit": "gross_profit",
        "order_contribution_margin": "contribution_margin",
        "order_cac": "cac_allocation",
        "order_net_profit": "net_profit",
    }
    losing = (orders or order_rows(fact)).filter(F.col("net_profit") < 0)
    named = losing.select(
        "order_id",
        "customer_id",
        F.col("first_date").alias("order_date"),
        "order_month",
        "order_channel",
        "customer_segment",
        F.col("is_returned").alias("return_flag"),
        F.col("is_first").alias("is_first_order"),
        "primary_category",
        F.col("lines").alias("item_count"),
        *[F.col(source).alias(out) for out, source in measures.items()],
    )
    margin, cac = F.col("order_contribution_margin"), F.col("order_cac")
    # Labels of the causes. The first rule that holds gives the cause; with discounts of
    # at least 0 the last two cannot be reached.
    causes = [
        ("High CAC on First Order", (margin >= 0) & (cac > margin)),
        ("Return Cost", F.col("return_flag") & (F.col("order_return_cost") > margin + cac)),
        ("Negative Gross Margin (COGS > Revenue)", F.col("order_gross_profit") < 0),
        ("Excess Discount", F.col("order_discount") > margin),
        ("High Logistics Cost", F.col("order_logistics") * 2 > F.col("order_gross_profit")),
    ]
    cause = F.when(causes[0][1], causes[0][0])
    for label, holds in causes[1:]:
        cause = cause.when(holds, label)
    margin_pct = F.col("order_net_margin_pct")
    # The labels carry literal runs of spaces.
    severity = (
        F.when(margin_pct < -50, "Severe   (>50% loss)")
        .when(margin_pct < -20, "High     (20-50% loss)")
        .when(margin_pct < -5, "Moderate (5-20% loss)")
        .otherwise("Marginal (<5% loss)")
    )
    return named.select(
        *dims,
        "primary_category",
        "item_count",
        *[money(out, TOTAL).alias(out) for out in measures],
        percent("order_net_profit", "order_revenue").alias("order_net_margin_pct"),
        money("abs(order_net_profit)", TOTAL).alias("loss_amount"),
        cause.otherwise("Combined Cost Pressure").alias("loss_root_cause"),
    ).withColumn("loss_severity", severity)


def customer_profitability(fact: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Lifetime economics per customer."""
    dims = ["customer_id", "customer_segment", "acquisition_channel", "customer_state"]
    customers = (
        (orders or order_rows(fact))
        .groupBy(*dims)
        .agg(
            _orders(),
            F.count_if("is_returned").alias("returned_orders"),
            F.min("first_date").alias("first_order_date"),
            F.max("last_date").alias("last_order_date"),
            *add_up(),
        )
    )
    # CAC / (contribution margin / orders), multiplied out; 1 place.
    tenths = half_up_wide("cac_allocation", "(10 * orders)", "contribution_margin")
    payback = F.expr(f"cast(cast({tenths} as decimal(18,0)) * 0.1BD as decimal(18,1))")
    report = customers.select(
        *dims,
        F.col("orders").alias("total_orders"),
        "first_order_date",
        "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_lifespan_days"),
        *_amounts(total_revenue="item_revenue"),
        per_unit("item_revenue", "orders").alias("avg_order_value"),
        *_amounts(
            total_cogs="item_cogs",
            total_logistics="logistics_cost",
            total_payment_fees="payment_fee",
            total_discounts="discount_allocated",
            total_return_costs="return_cost",
            total_gross_profit="gross_profit",
            total_contribution_margin="contribution_margin",
            total_cac_paid="cac_allocation",
            total_net_profit="net_profit",
        ),
        *_of_revenue(net_margin_pct="net_profit"),
        ratio("net_profit", "cac_allocation").alias("ltv_cac_ratio"),
        payback.alias("cac_payback_orders"),
        "returned_orders",
    )
    # Lower bounds and labels of the tiers.
    return report.withColumn(
        "customer_value_tier",
        _tier(
            F.col("total_net_profit"),
            [(5000, "Champion"), (1000, "Profitable"), (0, "Breakeven")],
            "Loss-Making",
        ),
    )


def cac_by_channel(fact: DataFrame, funnel: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Unit economics per order channel, with the marketing funnel beside it.

    CAC in the funnel is per *acquisition* channel while orders count by *order* channel.
    """
    # One fold to channel and customer gives the channel's sums, orders and people.
    people = (
        (orders or order_rows(fact))
        .groupBy(F.col("order_channel").alias("channel"), "customer_id")
        .agg(_orders(), F.bool_or("is_first").alias("is_new"), *add_up())
    )
    channels = people.groupBy("channel").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("total_customers"),
        F.count_if("is_new").alias("new_customers"),
        *add_up(),
    )
    marketing = funnel.select(
        "channel",
        "total_leads",
        "total_deals",
        "lead_conversion_rate_pct",
        "estimated_monthly_spend",
        "estimated_cac",
    )
    zero = F.lit(0)
    report = channels.join(marketing, "channel", "left").select(
        "channel",
        F.coalesce("total_leads", zero).alias("total_mql_leads"),
        F.coalesce("total_deals", zero).alias("total_deals_closed"),
        F.coalesce("lead_conversion_rate_pct", zero).alias("lead_conversion_rate_pct"),
        "new_customers",
        "total_customers",
        percent("(total_customers - new_customers)", "new_customers").alias("repeat_customer_rate_pct"),
        F.coalesce("estimated_monthly_spend", zero).cast(TOTAL).alias("estimated_monthly_spend"),
        F.coalesce("estimated_cac", zero).cast(TOTAL).alias("estimated_cac"),
        per_unit("cac_allocation", "new_customers").alias("actual_cac_per_new_customer"),
        "total_orders",
        *_amounts(
            total_revenue="item_revenue",
            total_gross_profit="gross_profit",
            total_contribution_margin="contribution_margin",
            total_cac_spend="cac_allocation",
            total_net_profit="net_profit",
        ),
        mean_net_margin().alias("avg_net_margin_pct"),
        per_unit("item_revenue", "new_customers").alias("revenue_per_new_customer"),
        per_unit("net_profit", "new_customers").alias("net_profit_per_new_customer"),
        *_amounts(first_order_revenue="first_revenue", first_order_net_profit="first_net"),
        percent("first_net", "first_revenue").alias("first_order_net_margin_pct"),
        # Against the monthly spend where there is one, else against the CAC charged.
        ratio("net_profit", f"coalesce({cents('estimated_monthly_spend')}, cac_allocation)").alias("ltv_cac_ratio"),
    )
    # Lower bounds and labels of the tiers.
    return report.withColumn(
        "channel_tier",
        _tier(
            F.col("net_profit_per_new_customer"),
            [(2000, "High Value Channel"), (500, "Moderate Value"), (0, "Breakeven")],
            "Loss Channel",
        ),
    )


def profit_waterfall(fact: DataFrame) -> DataFrame:
    """One row: the cascade from revenue to net profit over everything."""
    return headline(fact).select(
        *_amounts(
            step_01_item_revenue="item_revenue",
            step_02_less_cogs="item_cogs",
            step_03_less_logistics="logistics_cost",
            step_04_less_payment_fees="payment_fee",
            step_05_less_discounts="discount_allocated",
            step_06_less_return_costs="return_cost",
            step_07_contribution_margin="contribution_margin",
        ),
        *_of_revenue(cm_margin_pct="contribution_margin"),
        *_amounts(step_08_less_cac="cac_allocation", step_09_net_profit="net_profit"),
        *_of_revenue(net_margin_pct="net_profit"),
        *_amounts(total_profit_leaked=LEAKED),
        *_of_revenue(leakage_pct=LEAKED),
        *_counts(
            total_orders="orders",
            total_line_items="lines",
            total_customers="customers",
            loss_making_line_items="leak_lines",
        ),
        percent("leak_lines", "lines").alias("pct_items_losing_money"),
    )
