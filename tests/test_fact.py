import re
from decimal import Decimal as D

import pytest

from frames import customer, item, order, payment, product, raw_tables
from marginfold.functions.money import share_of
from marginfold.operators import fact
from marginfold.params import EconomicsParams
from marginfold.plans.mart import Mart
from marginfold.schemas import FACT_SCHEMA
from marginfold.verify.queries import comparable


def build(spark, params=EconomicsParams(), **rows):
    rows.setdefault("products", [product()])
    rows.setdefault("customers", [customer()])
    return Mart(raw_tables(spark, **rows), params)


def lines(m):
    return {r.order_item_key: r for r in m.fact_order_items.collect()}


def test_schema(spark):
    m = build(spark)
    got = m.fact_order_items.schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in FACT_SCHEMA]


def test_single_item_orders(spark):
    m = build(
        spark,
        orders=[order("O1", at="2025-01-01 00:00:00"), order("O2"), order("O3", status="returned", at="2025-04-01 00:00:00")],
        order_items=[item("O1"), item("O2"), item("O3")],
        order_payments=[payment("O1"), payment("O2"), payment("O3")],
    )
    got = lines(m)
    kept, returned = got["O2-1"], got["O3-1"]
    assert (kept.item_cogs, kept.payment_fee, kept.contribution_margin) == (D("400"), D("25"), D("525"))
    assert (kept.net_profit, kept.net_margin_pct, kept.is_profit_leak) == (D("525"), D("52.50"), False)
    assert (kept.item_revenue_share, kept.customer_order_seq, kept.month_label) == (D("1"), 2, "Mar 2025")
    assert (kept.order_year, kept.order_quarter) == (2025, 1)
    assert (returned.return_cost, returned.contribution_margin) == (D("90"), D("435"))
    assert got["O1-1"].is_first_order


def test_first_order_pays_the_channel_cac(spark):
    params = EconomicsParams(monthly_spend={"email": D("600")})
    m = build(
        spark,
        params,
        orders=[order("O1", channel="email"), order("O2", channel="email", at="2025-05-01 00:00:00")],
        order_items=[item("O1"), item("O2")],
        order_payments=[payment("O1"), payment("O2")],
    )
    got = lines(m)
    assert (got["O1-1"].cac_allocation, got["O1-1"].net_profit, got["O1-1"].is_profit_leak) == (D("600"), D("-75"), True)
    assert (got["O2-1"].cac_allocation, got["O2-1"].net_profit) == (0, D("525"))
    loss = m.rpt_loss_making_orders.first()
    assert (loss.loss_root_cause, loss.loss_severity) == ("High CAC on First Order", "Moderate (5-20% loss)")


def test_order_costs_split_by_revenue(spark):
    m = build(
        spark,
        orders=[order("O1", order_discount_amount="100"), order("O2")],
        order_items=[item("O1", 1, price="300"), item("O1", 2, price="700")]
        + [item("O2", i, price="10") for i in (1, 2, 3)],
        order_payments=[payment("O1", "400"), payment("O2", "4")],
    )
    got = lines(m)
    assert [got[f"O1-{i}"].payment_fee for i in (1, 2)] == [D("3"), D("7")]
    assert [got[f"O1-{i}"].discount_allocated for i in (1, 2)] == [D("30"), D("70")]
    assert [got[f"O2-{i}"].payment_fee for i in (1, 2, 3)] == [D("0.03")] * 3
    assert got["O2-1"].item_revenue_share == D("0.333333")


def test_missing_sides(spark):
    m = build(
        spark,
        orders=[order("unknown"), order("nocust", customer="C9"), order("nopay"), order("free")],
        order_items=[item("unknown", product="none"), item("nocust"), item("nopay"), item("free", price="0")],
        order_payments=[payment("unknown"), payment("nocust"), payment("free")],
    )
    got = lines(m)
    assert set(got) == {"unknown-1", "free-1"}
    u, f = got["unknown-1"], got["free-1"]
    assert (u.item_cogs, u.contribution_margin, u.net_profit, u.is_profit_leak) == (None,) * 4
    assert u.payment_fee == D("25")
    assert (f.item_revenue_share, f.payment_fee, f.contribution_margin, f.net_margin_pct) == (None,) * 4


def test_enormous_amounts_are_exact(spark):
    m = build(
        spark,
        orders=[order("O1", order_discount_amount="3000000000.01")],
        order_items=[item("O1", 1, price="5000000000.00"), item("O1", 2, price="2000000000.01")],
        order_payments=[payment("O1")],
    )
    got = lines(m)
    total = 700_000_000_001
    for line, cents in ((1, 500_000_000_000), (2, 200_000_000_001)):
        want = (2 * 300_000_000_001 * cents + total) // (2 * total)
        assert got[f"O1-{line}"].discount_allocated == D(want) / 100


@pytest.mark.parametrize("rows_per_task", [1, 7, 1_000_000])
def test_huge_order_is_split_over_blocks_without_changing_results(spark, rows_per_task):
    ids = [1, 2, 3, 50, 51, 1000, 20_000]
    m = build(
        spark,
        EconomicsParams(rows_per_task=rows_per_task),
        orders=[order("hot", order_discount_amount="70"), order("cold", status="returned")],
        order_items=[item("hot", i, price="100") for i in ids] + [item("cold")],
        order_payments=[payment("hot"), payment("cold")],
    )
    got = lines(m)
    assert set(got) == {f"hot-{i}" for i in ids} | {"cold-1"}
    assert all(got[f"hot-{i}"].discount_allocated == D("10") for i in ids)
    costs = {(r.order_id, r.order_item_id): r.return_cost for r in fact.return_costs(m._lines, m.stg_orders, m.params).collect()}
    assert costs[("cold", 1)] == D("90") and costs[("hot", 50)] == 0


def test_nothing_is_broadcast_by_force(spark):
    plan = build(spark).fact_order_items._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_lines_meet_their_products_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = build(spark)
        exchanges = re.findall(r"hashpartitioning\(product_id#", m.fact_order_items._jdf.queryExecution().executedPlan().toString())
        assert 1 <= len(exchanges) <= 2
        assert "(product_id" not in fact.order_totals(m._prices)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_headers_are_repeated_only_for_blocks_with_lines(spark):
    m = build(spark, orders=[order("O1")], order_items=[item("O1", 1), item("O1", 2_000_000_000)], order_payments=[payment("O1")])
    spans = fact._order_spans(m._prices, m.params).first()
    assert sorted(spans["_blocks"]) == [0, 1999] and spans["item_count"] == 2
    assert len(lines(m)) == 2


def test_return_rates_are_used_in_full(spark):
    m = build(
        spark,
        EconomicsParams(restocking_rate=D("0.12345"), reverse_logistics_multiplier=D("1.5")),
        orders=[order("O1", status="returned")],
        order_items=[item("O1", price="25000", freight="3.01")],
        order_payments=[payment("O1")],
    )
    assert lines(m)["O1-1"].return_cost == D("1239.02")


def test_discounts_are_spread_unrounded(spark):
    m = build(
        spark,
        orders=[order("O1", order_discount_amount="0.0099")],
        order_items=[item("O1", 1, price="50"), item("O1", 2, price="50")],
        order_payments=[payment("O1")],
    )
    assert [r.discount_allocated for r in lines(m).values()] == [D("0.00"), D("0.00")]


def two_orders(spark):
    return build(
        spark,
        orders=[order("O1", order_discount_amount="7"), order("O2", at="2025-05-01 10:00:00")],
        order_items=[item("O1", 1, price="50"), item("O1", 2, price="30"), item("O2")],
        order_payments=[payment("O1"), payment("O2")],
    )


def test_totals_of_all_lines_are_folded_without_collecting_sets(spark):
    m = two_orders(spark)
    plan = fact._order_spans(m._prices, m.params)._jdf.queryExecution().sparkPlan().toString()
    sums = [line for line in plan.splitlines() if "sum(" in line and "Aggregate" in line]
    assert sums and not any("ObjectHash" in line or "SortAggregate" in line for line in sums)


def test_lines_from_a_moved_base_are_the_fact(spark):
    m = two_orders(spark)
    moved = fact.lines_of(m.fact_base.hint("rebalance", "order_month"))
    assert moved.columns == m.fact_order_items.columns
    assert moved.exceptAll(m.fact_order_items).count() == 0 and moved.count() == 3


def test_the_step_with_all_arithmetic_is_compiled(spark, capsys):
    """The JVM compiles methods of at most 8,000 bytes of bytecode; result types are part of the step."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    query = comparable(two_orders(spark).fact_order_items)
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        query.select("*").explain("codegen")
    finally:
        for key in settings:
            spark.conf.unset(key)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) <= 8000


def test_shares_with_half_of_the_whole_at_hand(spark):
    rows = spark.sql("SELECT * FROM VALUES (7L, 1L, 3L), (-7L, 1L, 2L), (5L, -3L, 10L), (5L, 1L, CAST(NULL AS BIGINT)) AS t(cost, part, whole)")
    rows = rows.selectExpr("*", "abs(whole) div 2 AS half")
    for units in (1, 1_000_000):
        both = rows.selectExpr(f"{share_of('cost', 'part', 'whole', units)} AS a", f"{share_of('cost', 'part', 'whole', units, half='half')} AS b")
        assert all(r.a == r.b for r in both.collect())


def test_orders_are_not_shuffled_by_their_channel(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        m = build(spark, orders=[order("1")], order_items=[item("1")], order_payments=[payment("1")])
        plan = m.fact_order_items._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"hashpartitioning\(order_channel", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_repeated_channel_repeats_its_lines_and_none_costs_nothing(spark):
    m = build(
        spark,
        orders=[order("1", channel="email"), order("2", customer="C1", channel=None), order("3", channel="other")],
        order_items=[item("1"), item("2"), item("3")],
        order_payments=[payment("1"), payment("2"), payment("3")],
    )
    cac = spark.createDataFrame([("email", D("2.00")), ("email", D("3.00")), (None, D("9.00"))], "channel string, cac_per_new_customer decimal(20,2)")
    base = fact.fact_base(m._lines, m.stg_orders, m.stg_customers, m._payments, cac, m.params)
    assert sorted((r.order_id, r.channel_cac) for r in base.collect()) == [("1", 200), ("1", 300), ("2", 0), ("3", 0)]
