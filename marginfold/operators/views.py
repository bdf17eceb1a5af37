"""Readers for dashboards and run logs: counts, rankings, overviews."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marginfold.functions.counts import Known, row_count
from marginfold.functions.rules import stack_rows


def table_counts(
    tables: Mapping[str, DataFrame], known: Known | None = None, name: str = "table_name", out: str = "row_count"
) -> DataFrame:
    """Row count per table; tables whose counts are known are not read."""
    known = known or {}
    return reduce(
        DataFrame.unionByName,
        [
            row_count(t, known.get(label), out).select(F.lit(label).alias(name), out)
            for label, t in tables.items()
        ],
    )


def channel_cac_report(funnel: DataFrame) -> DataFrame:
    return funnel.select("channel", "new_customers", "estimated_monthly_spend", "estimated_cac").orderBy(
        F.desc_nulls_last("estimated_cac"), "channel"
    )


def category_summary(report: DataFrame) -> DataFrame:
    return report.select(
        "category",
        "total_revenue",
        "total_net_profit",
        "avg_net_margin_pct",
        "leakage_pct",
        "profitability_tier",
    ).orderBy(F.desc_nulls_first("total_net_profit"), "category")


def channel_economics(report: DataFrame) -> DataFrame:
    return report.select(
        "channel",
        "new_customers",
        "estimated_cac",
        "total_net_profit",
        "avg_net_margin_pct",
        "ltv_cac_ratio",
        "channel_tier",
    ).orderBy(F.desc_nulls_first("total_net_profit"), "channel")


def fact_explorer(fact: DataFrame) -> DataFrame:
    """Line-level columns for drill-down, newest first.

    The keys behind the date let the sort split a busy day over several tasks.
    """
    return fact.select(
        "order_id",
        "order_item_id",
        "customer_id",
        "product_id",
        "category",
        "customer_segment",
        "order_channel",
        "order_date",
        "order_month",
        "month_label",
        "item_revenue",
        "item_cogs",
        "logistics_cost",
        "payment_fee",
        "discount_allocated",
        "return_cost",
        "gross_profit",
        "gross_margin_pct",
        "contribution_margin",
        "contribution_margin_pct",
        "cac_allocation",
        "net_profit",
        "net_margin_pct",
        "return_flag",
        "is_first_order",
        "is_profit_leak",
        "customer_order_seq",
    ).orderBy(F.desc_nulls_first("order_date"), "order_id", "order_item_id")


def _average(column: str) -> Column:
    return F.sum(column).cast("double") / F.nullif(F.count(column), F.lit(0)).cast("double")


def monthly_averages(monthly: DataFrame) -> DataFrame:
    """Mean revenue, profit and margin over months, with the best and the worst month."""
    profit = F.col("total_net_profit")
    # Ties go to the earlier month; months without a profit figure do not compete.
    age = -F.unix_date("order_month")
    best = F.when(profit.isNotNull(), F.struct(profit, age))
    worst = F.when(profit.isNotNull(), F.struct(profit, -age))
    return monthly.agg(
        _average("total_revenue").alias("avg_monthly_revenue"),
        _average("total_net_profit").alias("avg_monthly_profit"),
        _average("avg_net_margin_pct").alias("avg_net_margin_pct"),
        F.max_by("month_label", best).alias("best_month"),
        F.min_by("month_label", worst).alias("worst_month"),
    )


# Cost buckets of the waterfall and the labels they are shown under.
LEAK_BUCKETS = {
    "COGS": "step_02_less_cogs",
    "Logistics": "step_03_less_logistics",
    "Payment Fees": "step_04_less_payment_fees",
    "Discounts": "step_05_less_discounts",
    "Returns": "step_06_less_return_costs",
    "CAC": "step_08_less_cac",
    "Net Profit": "step_09_net_profit",
}


def leak_breakdown(waterfall: DataFrame) -> DataFrame:
    """Where the revenue went: one row per bucket with its share of revenue in percent."""
    revenue = F.col("step_01_item_revenue").cast("double")
    rows = []
    for position, (label, column) in enumerate(LEAK_BUCKETS.items(), start=1):
        value = F.col(column).cast("double")
        rows.append(
            {
                "position": F.lit(position),
                "label": F.lit(label),
                "value": value,
                "magnitude": F.abs(value),
                "pct_of_revenue": F.when(revenue != 0, value / F.nullif(revenue, F.lit(0.0)) * 100).otherwise(0.0),
            }
        )
    return stack_rows(waterfall, rows)


def quick_stats(fact: DataFrame) -> DataFrame:
    """One row of counters; the return rate is over lines."""
    lines = F.nullif(F.count(F.lit(1)), F.lit(0)).cast("double")
    flags = F.nullif(F.count("return_flag"), F.lit(0)).cast("double")
    first = F.count_if("is_first_order")
    return fact.agg(
        F.count_distinct("customer_id").alias("unique_customers"),
        (F.count_if("return_flag").cast("double") / flags * 100).alias("return_rate_pct"),
        first.alias("first_order_items"),
        (first.cast("double") / lines * 100).alias("first_order_items_pct"),
        F.count_if("is_profit_leak").alias("leak_items"),
    )


# Bars of the waterfall chart: label, source column, kind of bar.
WATERFALL_STEPS = [
    ("Revenue", "step_01_item_revenue", "absolute"),
    ("− COGS", "step_02_less_cogs", "relative"),
    ("− Logistics", "step_03_less_logistics", "relative"),
    ("− Payment Fees", "step_04_less_payment_fees", "relative"),
    ("− Discounts", "step_05_less_discounts", "relative"),
    ("− Returns", "step_06_less_return_costs", "relative"),
    ("Contribution Margin", "step_07_contribution_margin", "total"),
    ("− CAC", "step_08_less_cac", "relative"),
    ("Net Profit", "step_09_net_profit", "total"),
]


def waterfall_steps(waterfall: DataFrame) -> DataFrame:
    """Ordered chart steps: ``value`` is the signed move (none for totals), ``amount`` the figure shown."""
    moves = {"absolute": 1, "relative": -1}
    rows = []
    for step, (label, column, measure) in enumerate(WATERFALL_STEPS, start=1):
        amount = F.col(column).cast("double")
        value = amount * moves[measure] if measure in moves else F.lit(None).cast("double")
        rows.append(
            {
                "step": F.lit(step),
                "label": F.lit(label),
                "measure": F.lit(measure),
                "value": value,
                "amount": amount,
            }
        )
    return stack_rows(waterfall, rows)


# Sort column, direction and tie-break of each report; the waterfall is a single row.
REPORT_ORDER = {
    "summary_by_month": ("order_month", "asc", "month_label"),
    "rpt_category_profitability": ("total_net_profit", "desc", "category"),
    "rpt_customer_profitability": ("total_net_profit", "desc", "customer_id"),
    "rpt_cac_by_channel": ("total_net_profit", "desc", "channel"),
    "rpt_loss_making_orders": ("order_net_profit", "asc", "order_id"),
    "rpt_profit_waterfall": None,
}


def in_report_order(name: str, report: DataFrame) -> DataFrame:
    """A report in its fixed reading order.

    The tie-break lets the sort split a value that very many rows share over several tasks.
    """
    if REPORT_ORDER[name] is None:
        return report
    column, direction, tie_break = REPORT_ORDER[name]
    return report.orderBy(F.asc_nulls_last(column) if direction == "asc" else F.desc_nulls_first(column), tie_break)
