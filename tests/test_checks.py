from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from frames import customer, item, order, payment, product, raw_tables
from marginfold.operators import checks
from marginfold.plans.mart import Mart


@pytest.fixture(scope="module")
def mart(spark):
    return Mart(
        raw_tables(
            spark,
            orders=[
                order("O1", at="2025-01-01 00:00:00", order_discount_amount="10"),
                order("O2", status="returned"),
                order("O3", status="canceled"),
            ],
            order_items=[item("O1", 1), item("O1", 2), item("O2"), item("O3")],
            order_payments=[payment("O1"), payment("O2"), payment("O3")],
            products=[product()],
            customers=[customer()],
        )
    )


@pytest.fixture(scope="module")
def fact(mart):
    return mart.fact_order_items


def statuses(frame, label="rule_name"):
    return {r[label]: (r.violations, r.status) for r in frame.collect()}


def test_sound_tables_pass(mart, fact):
    raw = mart.raw
    frames = [
        checks.check_cac_rules(fact),
        checks.check_return_rules(fact),
        checks.check_cascade(fact),
        checks.check_staging_filter(mart.stg_orders),
        checks.check_cogs(mart.stg_order_items, mart.stg_order_payments),
        checks.check_fact_integrity(fact),
        checks.check_required_columns(raw),
        checks.check_primary_keys({**mart.staging_tables, "fact_order_items": fact}),
        checks.report_completeness(mart.reports),
        checks.reconciliation_summary(
            raw["order_items"], raw["orders"], mart.stg_order_payments, fact, mart.reports
        ),
    ]
    for frame in frames:
        assert {r.status for r in frame.collect()} == {"PASS"}
    assert checks.overall_verdict(frames[-1]).first().verdict == "PASS"
    assert checks.reconcile_revenue(raw["order_items"], raw["orders"], fact).first().reconciliation_status == "PASS"
    assert checks.reconcile_fee(fact, mart.stg_order_payments).first().status.startswith("PASS")
    assert checks.reconcile_discount(fact, mart.stg_orders).first().status.startswith("PASS")


def test_lost_order_fails_revenue(mart, fact):
    got = checks.reconcile_revenue(
        mart.raw["order_items"], mart.raw["orders"], fact.filter("order_id <> 'O2'")
    ).first()
    assert (got.revenue_delta, got.order_count_delta, got.line_item_delta) == (D("-1000"), -1, -1)
    assert got.reconciliation_status == "FAIL — Revenue or row count mismatch"


def test_corrupted_allocations_fail(mart, fact):
    off = fact.withColumn("payment_fee", (F.col("payment_fee") + D("0.06")).cast("decimal(12,2)"))
    got = checks.reconcile_fee(off, mart.stg_order_payments).first()
    assert (got.orders_checked, got.orders_with_fee_mismatch, got.max_rounding_error) == (2, 2, D("0.12"))
    assert got.status.startswith("FAIL")
    near = fact.withColumn(
        "discount_allocated", F.expr("discount_allocated + if(order_item_id = 1, 0.05, 0)").cast("decimal(12,2)")
    )
    assert checks.reconcile_discount(near, mart.stg_orders).first().orders_with_discount_mismatch == 0


def test_corrupted_rules_fail(fact):
    repeat = fact.withColumn("cac_allocation", F.expr("if(order_id = 'O2', 5.00, 0.00)").cast("decimal(12,2)"))
    assert statuses(checks.check_cac_rules(repeat))["Repeat orders have zero CAC"] == (1, "FAIL")
    negative = fact.withColumn("cac_allocation", F.lit(D("-1")).cast("decimal(12,2)"))
    assert [v for v, _ in statuses(checks.check_cac_rules(negative)).values()] == [1, 2, 3]
    free = fact.withColumn("return_cost", F.expr("if(return_flag, 0.00, 1.00)").cast("decimal(12,2)"))
    assert [v for v, _ in statuses(checks.check_return_rules(free)).values()] == [2, 1]
    shifted = fact.withColumn("item_cogs", (F.col("item_cogs") + D("0.03")).cast("decimal(12,2)"))
    assert [v for v, _ in statuses(checks.check_cascade(shifted), "check_name").values()] == [3, 3, 0]
    twice = statuses(checks.check_fact_integrity(fact.unionByName(fact)), "check_name")
    assert twice["fact: order_item_key is unique (no duplicates)"] == (3, "FAIL")
    hole = fact.withColumn("net_profit", F.lit(None).cast("decimal(12,2)"))
    assert statuses(checks.check_fact_integrity(hole), "check_name")["fact: no NULL net_profit"] == (3, "FAIL")


def test_empty_fact(mart, fact):
    nothing = fact.limit(0)
    assert {s for _, s in statuses(checks.check_fact_integrity(nothing), "check_name").values()} == {"PASS"}
    got = checks.reconcile_revenue(mart.raw["order_items"], mart.raw["orders"], nothing).first()
    assert got.reconciliation_status.startswith("FAIL") and got.fact_line_items == 0


def test_key_check_counts_duplicates_and_nulls(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)], "k string, n int")
    got = checks.check_key("t", rows, ["k", "n"]).first()
    assert (got.row_count, got.null_keys, got.duplicate_keys, got.status) == (5, 2, 1, "FAIL")


def test_row_floors_and_nulls(spark, mart):
    got = {r.table_name: r.status for r in checks.check_min_rows(mart.raw, {"orders": 3, "products": 2}).collect()}
    assert got == {"raw.orders": "PASS", "raw.products": "FAIL"}
    rows = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert [tuple(r) for r in checks.check_not_null("t", rows, ["x", "y"]).collect()] == [
        ("t.x", 1, "FAIL"),
        ("t.y", 2, "FAIL"),
    ]


def test_completeness(spark, mart):
    empty = {n: t.limit(0) for n, t in mart.reports.items()}
    got = {r.report_table: r.status for r in checks.report_completeness(empty).collect()}
    assert got["rpt_loss_making_orders"] == "PASS"
    assert got["rpt_profit_waterfall"] == "FAIL — Expected 1 row"
    assert got["rpt_cac_by_channel"] == "FAIL — Empty Report"


def test_sanity_rows(fact):
    got = checks.sanity_summary(fact).first()
    assert (got.total_orders, got.total_customers, got.first_orders, got.returned_orders) == (2, 1, 1, 1)
    assert (got.total_revenue, got.loss_making_line_items) == (D("3000"), 0)
    assert checks.business_sanity(fact).first().returned_items == 1
