from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from marginfold.operators import reports, views
from marginfold.schemas import FACT_SCHEMA

BASE = {
    "order_id": "O1",
    "order_item_id": 1,
    "customer_id": "C1",
    "order_date": date(2025, 3, 10),
    "order_month": date(2025, 3, 1),
    "order_year": 2025,
    "month_label": "Mar 2025",
    "category": "Beauty",
    "customer_segment": "Mass",
    "customer_state": "SP",
    "order_channel": "email",
    "acquisition_channel": "email",
    "return_flag": False,
    "is_first_order": True,
    "customer_order_seq": 1,
    "item_revenue": "100",
    "item_cogs": "40",
    "gross_profit": "60",
    "logistics_cost": "5",
    "payment_fee": "2",
    "discount_allocated": "3",
    "return_cost": "0",
    "contribution_margin": "50",
    "cac_allocation": "0",
    "net_profit": "50",
    "net_margin_pct": "50",
    "contribution_margin_pct": "50",
    "is_profit_leak": False,
}


def fact_of(spark, *rows):
    """Fact rows as changes to a default row."""
    out = []
    for number, change in enumerate(rows):
        row = BASE | {"order_item_key": f"K{number}"} | change
        out.append(
            tuple(
                D(row[f.name]) if isinstance(row.get(f.name), str) and "decimal" in f.dataType.simpleString() else row.get(f.name)
                for f in FACT_SCHEMA
            )
        )
    return spark.createDataFrame(out, FACT_SCHEMA)


def test_category_report(spark):
    fact = fact_of(
        spark,
        {},
        {"order_item_id": 2, "return_flag": True, "net_profit": "-30", "net_margin_pct": "-30", "is_profit_leak": True},
        {"order_id": "O2", "customer_id": "C2", "category": None, "net_profit": None, "net_margin_pct": None},
        {"order_id": "O3", "category": "Tie", "item_cogs": "7", "logistics_cost": "7"},
    )
    got = {r.category: r for r in reports.category_profitability(fact).collect()}
    b = got["Beauty"]
    assert (b.total_line_items, b.total_orders, b.total_customers) == (2, 1, 1)
    assert (b.cogs_pct, b.avg_net_margin_pct, b.profitability_tier) == (D("40"), D("10"), "Moderate Margin")
    assert (b.returned_items, b.return_rate_pct) == (1, D("50"))
    assert (b.profit_leaked_abs, b.leakage_pct, b.primary_cost_driver) == (D("180"), D("90"), "COGS")
    assert (got[None].avg_net_margin_pct, got[None].profitability_tier) == (None, "Loss-Making")
    assert got[None].profit_leaked_abs == D("100")
    assert got["Tie"].primary_cost_driver == "COGS"


@pytest.mark.parametrize(
    ("change", "cause"),
    [
        ({"contribution_margin": "10", "cac_allocation": "60", "net_profit": "-50"}, "High CAC on First Order"),
        ({"contribution_margin": "-10", "return_flag": True, "return_cost": "5"}, "Return Cost"),
        ({"contribution_margin": "-10", "gross_profit": "-1"}, "Negative Gross Margin (COGS > Revenue)"),
        ({"contribution_margin": "-10", "discount_allocated": "0"}, "Excess Discount"),
        ({"contribution_margin": "-10", "discount_allocated": "-50", "logistics_cost": "31"}, "High Logistics Cost"),
        ({"contribution_margin": "-10", "discount_allocated": "-50", "logistics_cost": "30"}, "Combined Cost Pressure"),
    ],
)
def test_loss_causes_in_order(spark, change, cause):
    got = reports.loss_making_orders(fact_of(spark, {"net_profit": "-10"} | change)).collect()
    assert [r.loss_root_cause for r in got] == [cause]


def test_loss_severity_and_rollup(spark):
    fact = fact_of(
        spark,
        *[
            {"order_id": f"O{n}", "net_profit": n}
            for n in ("-51", "-50", "-20", "-5", "0", "7")
        ],
        {"order_id": "O7", "order_item_id": 2, "category": "Kitchen", "net_profit": "-8"},
    )
    got = {r.order_id: r for r in reports.loss_making_orders(fact).collect()}
    assert {k: r.loss_severity for k, r in got.items()} == {
        "O-51": "Severe   (>50% loss)",
        "O-50": "High     (20-50% loss)",
        "O-20": "Moderate (5-20% loss)",
        "O-5": "Marginal (<5% loss)",
        "O7": "Marginal (<5% loss)",
    }
    assert (got["O7"].primary_category, got["O7"].item_count, got["O7"].loss_amount) == ("Kitchen", 2, D("1"))


def test_customer_report(spark):
    fact = fact_of(
        spark,
        {"cac_allocation": "30"},
        {"order_item_id": 2, "return_flag": True},
        {"order_id": "O2", "order_date": date(2025, 3, 30), "contribution_margin": "-70"},
        {"order_id": "O3", "customer_id": "C2", "net_profit": "5000"},
    )
    got = {r.customer_id: r for r in reports.customer_profitability(fact).collect()}
    c = got["C1"]
    assert (c.total_orders, c.returned_orders, c.customer_lifespan_days) == (2, 1, 20)
    assert (c.avg_order_value, c.ltv_cac_ratio) == (D("150"), D("5"))
    assert c.cac_payback_orders == D("2.0")  # 30 / (30 / 2)
    assert (got["C2"].ltv_cac_ratio, got["C2"].customer_value_tier) == (None, "Champion")


def test_channel_report(spark):
    fact = fact_of(
        spark,
        {"customer_id": "C1", "net_profit": "800"},
        {"order_id": "O2", "customer_id": "C2", "is_first_order": False},
        {"order_id": "O3", "customer_id": "C3", "is_first_order": False},
        {"order_id": "O4", "order_channel": "organic_search", "cac_allocation": "1"},
        {"order_id": "O5", "order_channel": "other", "is_first_order": False, "cac_allocation": "25"},
    )
    funnel = spark.createDataFrame(
        [("email", 10, 2, D("20"), D("8000"), D("4000")), ("organic_search", 0, 0, None, D("0"), D("0"))],
        "channel string, total_leads bigint, total_deals bigint, lead_conversion_rate_pct decimal(12,2),"
        " estimated_monthly_spend decimal(18,2), estimated_cac decimal(18,2)",
    )
    got = {r.channel: r for r in reports.cac_by_channel(fact, funnel).collect()}
    e, o, x = got["email"], got["organic_search"], got["other"]
    assert (e.total_customers, e.new_customers, e.repeat_customer_rate_pct) == (3, 1, D("200"))
    assert (e.ltv_cac_ratio, e.channel_tier) == (D("0.11"), "Moderate Value")
    assert (e.first_order_net_profit, e.first_order_net_margin_pct) == (D("800"), D("800"))
    assert (o.ltv_cac_ratio, o.estimated_monthly_spend) == (None, 0)
    assert (x.ltv_cac_ratio, x.total_mql_leads, x.channel_tier) == (D("2"), 0, "Loss Channel")
    assert (x.first_order_revenue, x.repeat_customer_rate_pct) == (None, None)


def test_waterfall_and_its_views(spark):
    w = reports.profit_waterfall(fact_of(spark, {}, {"order_id": "O2", "net_profit": "-80", "is_profit_leak": True}))
    row = w.first()
    assert (row.total_orders, row.total_customers, row.total_line_items) == (2, 1, 2)
    assert (row.total_profit_leaked, row.leakage_pct, row.pct_items_losing_money) == (D("200"), D("100"), D("50"))
    leaks = {r.label: r for r in views.leak_breakdown(w).collect()}
    assert (leaks["COGS"].pct_of_revenue, leaks["Net Profit"].value, leaks["Net Profit"].magnitude) == (40.0, -30.0, 30.0)
    steps = views.waterfall_steps(w).orderBy("step").collect()
    assert [s.measure for s in steps] == ["absolute"] + ["relative"] * 5 + ["total", "relative", "total"]
    assert (steps[1].value, steps[6].value, steps[6].amount) == (-80.0, None, 100.0)

    empty = reports.profit_waterfall(fact_of(spark, {}).limit(0))
    assert empty.first().total_line_items == 0 and empty.first().step_01_item_revenue is None
    free = w.withColumn("step_01_item_revenue", F.lit(0))
    assert {r.pct_of_revenue for r in views.leak_breakdown(free).collect()} == {0.0}


def test_monthly_summary_and_averages(spark):
    fact = fact_of(
        spark,
        {"net_margin_pct": "10"},
        {"order_item_id": 2, "net_margin_pct": "15.01"},
        {"order_id": "O2", "order_month": date(2025, 2, 1), "month_label": "Feb 2025", "net_profit": "100"},
        {"order_id": "O3", "order_month": date(2025, 1, 1), "month_label": "Jan 2025", "net_profit": "20"},
        {"order_id": "O4", "order_month": date(2025, 4, 1), "month_label": "Apr 2025", "net_profit": None, "net_margin_pct": None},
    )
    monthly = reports.summary_by_month(fact)
    got = [r.order_month.month for r in views.in_report_order("summary_by_month", monthly).collect()]
    assert got == [1, 2, 3, 4]
    march = monthly.filter("month_label = 'Mar 2025'").first()
    assert (march.total_orders, march.total_line_items, march.avg_net_margin_pct) == (1, 2, D("12.51"))
    averages = views.monthly_averages(monthly).first()
    assert (averages.avg_monthly_revenue, averages.best_month, averages.worst_month) == (125.0, "Feb 2025", "Jan 2025")
    assert averages.avg_monthly_profit == pytest.approx(220 / 3)


def test_report_orders(spark):
    rows = spark.createDataFrame(
        [("a", 1), ("b", None), ("d", 3), ("c", 3)], "customer_id string, total_net_profit int"
    )
    got = [r.customer_id for r in views.in_report_order("rpt_customer_profitability", rows).collect()]
    assert got == ["b", "c", "d", "a"]


def test_quick_stats(spark):
    fact = fact_of(spark, {"return_flag": True}, {"order_id": "O2", "is_first_order": False, "is_profit_leak": None})
    got = views.quick_stats(fact).first()
    assert tuple(got) == (1, 50.0, 1, 50.0, 0)


def test_category_sums_are_shuffled_once_per_category(spark):
    """Lines go to the shuffle as keys; amounts meet where the lines are."""
    fact = fact_of(spark, *[{"order_id": f"O{i}", "customer_id": f"C{i % 7}", "category": f"K{i % 3}"} for i in range(60)])
    fact = fact.unionByName(fact_of(spark, {"order_id": "O1", "category": None, "customer_id": None}))
    report = reports.category_profitability(fact)
    got = {r.category: (r.total_orders, r.total_customers, r.total_line_items, r.total_revenue) for r in report.collect()}
    assert got == {f"K{k}": (20, 7, 20, D(2000)) for k in range(3)} | {None: (1, 0, 1, D(100))}
    folds = [line for line in report._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [as_key" in line]
    assert folds
