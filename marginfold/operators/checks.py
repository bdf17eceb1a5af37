"""Reconciliation and data-quality checks that return PASS/FAIL rows.

Every rule set over one table is a single aggregation pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marginfold.functions.counts import Known, TableCounts, null_counts, row_count
from marginfold.functions.money import cents, money, percent, total_cents
from marginfold.functions.rules import pass_fail, rule_rows, stack_rows, with_status
from marginfold.operators.rollup import LEAKED, headline, mean_net_margin
from marginfold.operators.staging import completed_orders
from marginfold.operators.views import table_counts
from marginfold.params import DEFAULT_PARAMS, EconomicsParams
from marginfold.schemas import MONEY, TOTAL


def _repeat_with_cac() -> Column:
    return ~F.col("is_first_order") & (F.col("cac_allocation") != 0)


def _kept_with_return_cost() -> Column:
    return ~F.col("return_flag") & (F.col("return_cost") != 0)


def _net_off_cascade(tolerance) -> Column:
    off = F.col("net_profit") - (F.col("contribution_margin") - F.col("cac_allocation"))
    return F.abs(off) > F.lit(tolerance)


def _revenue_by_layer(
    items: DataFrame, orders: DataFrame, fact: DataFrame, params: EconomicsParams
) -> DataFrame:
    """One row: revenue, orders and lines of the raw completed orders and of the fact.

    Both layers are folded to orders first, so distinct orders are a row count and a huge order
    never meets its header line by line.
    """
    raw = (
        items.select("order_id", F.col("price").cast(MONEY).alias("price"))
        .groupBy("order_id")
        .agg(total_cents("price").alias("revenue"), F.count(F.lit(1)).alias("lines"))
        .join(completed_orders(orders, params).select("order_id"), "order_id", "left_semi")
        .select(F.lit("raw").alias("layer"), "revenue", "lines")
    )
    built = (
        fact.groupBy("order_id")
        .agg(total_cents("item_revenue").alias("revenue"), F.count(F.lit(1)).alias("lines"))
        .select(F.lit("fact").alias("layer"), "revenue", "lines")
    )

    def of(layer: str) -> list[Column]:
        mine = f"layer = '{layer}'"
        return [
            money(f"sum(if({mine}, revenue, NULL))", TOTAL).alias(f"{layer}_total_revenue"),
            F.expr(f"count_if({mine})").alias(f"{layer}_order_count"),
            F.expr(f"coalesce(sum(if({mine}, lines, NULL)), 0)").alias(f"{layer}_line_items"),
        ]

    return raw.unionByName(built).agg(*of("raw"), *of("fact"))


def reconcile_revenue(
    items: DataFrame, orders: DataFrame, fact: DataFrame, params: EconomicsParams = DEFAULT_PARAMS
) -> DataFrame:
    """Revenue, order and line counts of raw completed orders against the fact."""
    delta = (F.col("fact_total_revenue") - F.col("raw_total_revenue")).cast(TOTAL)
    order_delta = F.col("fact_order_count") - F.col("raw_order_count")
    line_delta = F.col("fact_line_items") - F.col("raw_line_items")
    ok = (F.abs(delta) <= F.lit(params.revenue_tolerance)) & (order_delta == 0) & (line_delta == 0)
    return _revenue_by_layer(items, orders, fact, params).select(
        "raw_total_revenue",
        "fact_total_revenue",
        delta.alias("revenue_delta"),
        "raw_order_count",
        "fact_order_count",
        order_delta.alias("order_count_delta"),
        "raw_line_items",
        "fact_line_items",
        line_delta.alias("line_item_delta"),
        pass_fail(ok, "FAIL — Revenue or row count mismatch").alias("reconciliation_status"),
    )


def _allocation_gap(fact: DataFrame, allocated: str, orders: DataFrame, amount: str) -> DataFrame:
    """Per order, the distance between the allocated sum and the order's own amount."""
    summed = fact.groupBy("order_id").agg(total_cents(allocated).alias("_allocated"))
    return summed.join(orders.select("order_id", F.col(amount).alias("_amount")), "order_id").select(
        F.expr("cast(abs(cast(_allocated as decimal(18,0)) * 0.01BD - _amount) as decimal(26,8))").alias("gap")
    )


def _reconcile_allocation(gaps: DataFrame, mismatches: str, passed: str, failed: str, tolerance) -> DataFrame:
    return (
        gaps.agg(
            F.count(F.lit(1)).alias("orders_checked"),
            F.count_if(F.col("gap") > F.lit(tolerance)).alias(mismatches),
            F.max("gap").cast("decimal(18,4)").alias("max_rounding_error"),
        )
        .withColumn("status", pass_fail(F.col(mismatches) == 0, failed, passed))
    )


def reconcile_fee(fact: DataFrame, payments: DataFrame, params: EconomicsParams = DEFAULT_PARAMS) -> DataFrame:
    """Allocated payment fees against the fee of each staged order."""
    return _reconcile_allocation(
        _allocation_gap(fact, "payment_fee", payments, "total_payment_fee"),
        "orders_with_fee_mismatch",
        "PASS — All fee allocations sum correctly",
        "FAIL — Fee allocation mismatch (check multi-item orders)",
        params.allocation_tolerance,
    )


def reconcile_discount(fact: DataFrame, orders: DataFrame, params: EconomicsParams = DEFAULT_PARAMS) -> DataFrame:
    """Allocated discounts against the discount of each staged order."""
    return _reconcile_allocation(
        _allocation_gap(fact, "discount_allocated", orders, "discount_amount"),
        "orders_with_discount_mismatch",
        "PASS — All discount allocations sum correctly",
        "FAIL — Discount allocation mismatch detected",
        params.allocation_tolerance,
    )


def check_cac_rules(fact: DataFrame) -> DataFrame:
    negative = F.col("cac_allocation") < 0
    # Labels of the rules.
    return rule_rows(
        fact,
        {
            "Repeat orders have zero CAC": _repeat_with_cac(),
            "First orders have non-negative CAC": F.col("is_first_order") & negative,
            "No negative cac_allocation anywhere": negative,
        },
        "rule_name",
    )


def check_return_rules(fact: DataFrame) -> DataFrame:
    # Labels of the rules.
    return rule_rows(
        fact,
        {
            "Non-returned orders have zero return_cost": _kept_with_return_cost(),
            "Returned orders have positive return_cost": F.col("return_flag") & (F.col("return_cost") <= 0),
        },
        "rule_name",
    )


def check_cascade(fact: DataFrame, params: EconomicsParams = DEFAULT_PARAMS) -> DataFrame:
    revenue, cogs = F.col("item_revenue"), F.col("item_cogs")
    margin = (
        revenue
        - cogs
        - F.col("logistics_cost")
        - F.col("payment_fee")
        - F.col("discount_allocated")
        - F.col("return_cost")
    )
    limit = F.lit(params.cascade_tolerance)
    # Labels of the rules.
    return rule_rows(
        fact,
        {
            "gross_profit = item_revenue - item_cogs": F.abs(F.col("gross_profit") - (revenue - cogs)) > limit,
            "CM = Revenue - COGS - Logistics - Fee - Disc - Returns": F.abs(F.col("contribution_margin") - margin)
            > limit,
            "net_profit = contribution_margin - cac_allocation": _net_off_cascade(params.cascade_tolerance),
        },
        "check_name",
    )


def sanity_summary(fact: DataFrame) -> DataFrame:
    """One row of portfolio health metrics."""
    sums = headline(fact)
    amounts = {
        "total_revenue": "item_revenue",
        "total_cogs": "item_cogs",
        "total_logistics": "logistics_cost",
        "total_payment_fees": "payment_fee",
        "total_discounts": "discount_allocated",
        "total_return_costs": "return_cost",
        "total_cm": "contribution_margin",
        "total_cac": "cac_allocation",
        "total_net_profit": "net_profit",
    }
    return sums.select(
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("total_customers"),
        "first_orders",
        *[money(source, TOTAL).alias(out) for out, source in amounts.items()],
        percent("gross_profit", "item_revenue").alias("gross_margin_pct"),
        percent("contribution_margin", "item_revenue").alias("cm_pct"),
        percent("net_profit", "item_revenue").alias("net_margin_pct"),
        money(LEAKED, TOTAL).alias("total_leaked"),
        percent(LEAKED, "item_revenue").alias("leakage_pct"),
        F.coalesce("leak_lines", F.lit(0)).alias("loss_making_line_items"),
        "returned_orders",
    )


def business_sanity(fact: DataFrame) -> DataFrame:
    """One row of headline numbers for a human reader."""
    return headline(fact).select(
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("total_customers"),
        money("item_revenue", TOTAL).alias("total_revenue"),
        money("net_profit", TOTAL).alias("total_net_profit"),
        mean_net_margin().alias("avg_net_margin_pct"),
        F.coalesce("returned_lines", F.lit(0)).alias("returned_items"),
        percent("losing_lines", "lines").alias("pct_items_losing_money"),
    )


def report_completeness(reports: Mapping[str, DataFrame], known: Known | None = None) -> DataFrame:
    """Row count per report; the loss report may be empty, the waterfall has exactly one row."""
    rows = F.col("row_count")
    report = F.col("report_table")
    status = (
        F.when(report == "rpt_loss_making_orders", pass_fail(rows >= 0))
        .when(report == "rpt_profit_waterfall", pass_fail(rows == 1, "FAIL — Expected 1 row"))
        .otherwise(pass_fail(rows >= 1, "FAIL — Empty Report"))
    )
    return table_counts(reports, known, "report_table").withColumn("status", status)


def check_min_rows(
    tables: Mapping[str, DataFrame],
    floors: Mapping[str, int] = DEFAULT_PARAMS.row_floors,
    known: Known | None = None,
) -> DataFrame:
    """Row counts of raw tables against their floors; tables whose counts are known are not read."""
    known = known or {}
    checks = [
        row_count(tables[name], known.get(name), "actual_rows").select(
            F.lit(f"raw.{name}").alias("table_name"),
            "actual_rows",
            F.lit(floor).cast("bigint").alias("expected_min"),
            pass_fail(F.col("actual_rows") >= floor).alias("status"),
        )
        for name, floor in floors.items()
    ]
    return reduce(DataFrame.unionByName, checks)


# Columns of the raw tables that may never be NULL.
REQUIRED_COLUMNS = {
    "orders": ["order_id", "customer_id"],
    "order_items": ["order_id", "product_id", "price"],
    "products": ["estimated_cost_ratio"],
    "customers": ["acquisition_channel"],
}


def check_not_null(
    name: str, table: DataFrame, columns: Sequence[str], known: TableCounts | None = None
) -> DataFrame:
    """NULL count of each column, in one pass, or in none where the counts are known."""
    counted = null_counts(table, known, columns)
    stacked = stack_rows(
        counted, [{"column_check": F.lit(f"{name}.{c}"), "null_count": F.col(c)} for c in columns]
    )
    return stacked.withColumn("status", pass_fail(F.col("null_count") == 0))


def check_required_columns(
    raw: Mapping[str, DataFrame],
    required: Mapping[str, Sequence[str]] = REQUIRED_COLUMNS,
    known: Known | None = None,
) -> DataFrame:
    known = known or {}
    return reduce(
        DataFrame.unionByName,
        [check_not_null(f"raw.{name}", raw[name], columns, known.get(name)) for name, columns in required.items()],
    )


def check_staging_filter(orders: DataFrame) -> DataFrame:
    seq = F.col("customer_order_seq")
    # Labels of the rules.
    return rule_rows(
        orders,
        {
            "No canceled orders in stg_orders": F.col("order_status") == "canceled",
            "No in-transit orders in stg_orders": F.col("order_status") == "shipped",
            "All stg_orders have an order_date": F.col("order_date").isNull(),
            "stg_orders customer_order_seq starts at 1": (seq < 1) | seq.isNull(),
        },
        "check_name",
    )


def check_cogs(items: DataFrame, payments: DataFrame) -> DataFrame:
    lines = rule_rows(
        items,
        {
            "stg_order_items: no NULL unit_cogs": F.col("unit_cogs").isNull(),
            "stg_order_items: unit_cogs < selling_price": F.col("unit_cogs") >= F.col("selling_price"),
            "stg_order_items: gross_profit > 0 for all products": F.col("gross_profit") <= 0,
        },
        "check_name",
    )
    fees = rule_rows(
        payments, {"stg_order_payments: total_payment_fee >= 0": F.col("total_payment_fee") < 0}, "check_name"
    )
    return lines.unionByName(fees)


def check_fact_integrity(fact: DataFrame) -> DataFrame:
    """Seven rules in one pass; key duplicates come from folding the fact by key first."""
    rules = {
        "fact: no NULL item_revenue": F.col("item_revenue").isNull(),
        "fact: no NULL contribution_margin": F.col("contribution_margin").isNull(),
        "fact: no NULL net_profit": F.col("net_profit").isNull(),
        "fact: net_profit <= contribution_margin (CAC is non-negative)": F.col("net_profit")
        > F.col("contribution_margin"),
        "fact: CAC = 0 for non-first orders": _repeat_with_cac(),
        "fact: return_cost = 0 for delivered orders": _kept_with_return_cost(),
    }
    keys = [f"r{i}" for i in range(len(rules))]
    counted = (
        fact.groupBy("order_item_key")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            *[F.count_if(bad).alias(k) for k, bad in zip(keys, rules.values())],
        )
        .agg(
            # All lines minus the distinct keys; a NULL key is no key.
            (F.coalesce(F.sum("lines"), F.lit(0)) - F.count("order_item_key")).alias("duplicates"),
            *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in keys],
        )
    )
    return with_status(
        counted,
        [*rules, "fact: order_item_key is unique (no duplicates)"],
        [*keys, "duplicates"],
        "check_name",
    )


def check_key(name: str, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether ``keys`` identify the rows of a table: unique and never NULL."""
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rows = F.col("_rows")
    return (
        table.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .agg(
            F.coalesce(F.sum(rows), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum(F.when(missing, rows)), F.lit(0)).alias("null_keys"),
            F.count_if((rows > 1) & ~missing).alias("duplicate_keys"),
        )
        .select(
            F.lit(name).alias("table_name"),
            F.lit(", ".join(keys)).alias("key_columns"),
            "row_count",
            "null_keys",
            "duplicate_keys",
            pass_fail((F.col("null_keys") == 0) & (F.col("duplicate_keys") == 0)).alias("status"),
        )
    )


# Key of each table that declares one.
PRIMARY_KEYS = {
    "stg_orders": ["order_id"],
    "stg_order_payments": ["order_id"],
    "stg_products": ["product_id"],
    "stg_customers": ["customer_id"],
    "stg_channel_summary": ["channel"],
    "fact_order_items": ["order_item_key"],
}


def check_primary_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(
        DataFrame.unionByName, [check_key(name, tables[name], keys) for name, keys in PRIMARY_KEYS.items()]
    )


# The reports whose rows the "populated" headline check looks at.
_HEADLINE_REPORTS = [
    "rpt_category_profitability",
    "rpt_customer_profitability",
    "rpt_cac_by_channel",
    "rpt_profit_waterfall",
]


def reconciliation_summary(
    raw_items: DataFrame,
    raw_orders: DataFrame,
    payments: DataFrame,
    fact: DataFrame,
    reports: Mapping[str, DataFrame],
    params: EconomicsParams = DEFAULT_PARAMS,
    known: Known | None = None,
) -> DataFrame:
    """Six headline checks and the overall verdict.

    The last check names five reports but inspects four: the loss report may be empty.
    """
    revenue = _revenue_by_layer(raw_items, raw_orders, fact, params).select(
        F.lit(1).alias("check_no"),
        F.lit("Revenue matches raw source").alias("check_name"),
        pass_fail(
            F.abs(F.col("fact_total_revenue") - F.col("raw_total_revenue")) <= F.lit(params.revenue_tolerance)
        ).alias("status"),
    )
    fees = (
        _allocation_gap(fact, "payment_fee", payments, "total_payment_fee")
        .agg(F.max("gap").alias("gap"))
        .select(
            F.lit(2).alias("check_no"),
            F.lit("Payment fee allocation sums correctly").alias("check_name"),
            pass_fail(F.col("gap") <= F.lit(params.allocation_tolerance)).alias("status"),
        )
    )
    labels = {
        "No CAC on repeat orders": _repeat_with_cac(),
        "net_profit = CM - CAC (cascade integrity)": _net_off_cascade(params.cascade_tolerance),
        "Return cost only on returned orders": _kept_with_return_cost(),
    }
    keys = ["r3", "r4", "r5"]
    rules = stack_rows(
        fact.agg(*[F.count_if(bad).alias(k) for k, bad in zip(keys, labels.values())]),
        [
            {"check_no": F.lit(no), "check_name": F.lit(label), "status": pass_fail(F.col(k) == 0)}
            for no, (k, label) in enumerate(zip(keys, labels), start=3)
        ],
    )
    populated = (
        table_counts({name: reports[name] for name in _HEADLINE_REPORTS}, known)
        .agg(F.min("row_count").alias("least"))
        .select(
            F.lit(6).alias("check_no"),
            F.lit("All 5 report tables populated").alias("check_name"),
            pass_fail(F.col("least") >= 1).alias("status"),
        )
    )
    return reduce(DataFrame.unionByName, [revenue, fees, rules, populated])


def overall_verdict(summary: DataFrame) -> DataFrame:
    """One row: whether every headline check passed."""
    failed = F.count_if(F.col("status") != "PASS")
    return summary.agg(
        F.count(F.lit(1)).alias("checks"), failed.alias("failed"), pass_fail(failed == 0).alias("verdict")
    )
