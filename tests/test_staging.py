from datetime import date
from decimal import Decimal as D

import pytest

from frames import customer, item, order, payment, product, raw_table
from marginfold.operators import staging
from marginfold.params import EconomicsParams


def rows_by(frame, key):
    return {r[key]: r for r in frame.collect()}


def test_sequence_counts_completed_orders_only_and_breaks_ties_by_id(spark):
    orders = raw_table(
        spark,
        "orders",
        order("O1", status="canceled", at="2025-01-01 00:00:00"),
        order("O3", at="2025-01-02 00:00:00"),
        order("O2", at="2025-01-02 00:00:00", status="returned"),
        order("O4", at=None),
        order("O5", customer=None, at="2025-01-03 00:00:00"),
        order("O6", customer=None, at="2025-01-01 00:00:00"),
    )
    got = rows_by(staging.stage_orders(orders), "order_id")
    assert {k: r.customer_order_seq for k, r in got.items()} == {"O2": 1, "O3": 2, "O4": 3, "O6": 1, "O5": 2}
    assert got["O2"].return_flag and not got["O3"].return_flag


@pytest.mark.parametrize(
    ("approved", "hours"),
    [
        ("2025-05-09 10:00:00", "1440.00"),
        ("2025-07-08 10:00:00", "2880.00"),
        ("2026-03-10 10:00:00", "8760.00"),
        ("2125-03-10 10:00:00", "876576.00"),
        ("2025-03-10 09:59:42", "-0.01"),
        ("2025-03-10 10:00:17.999999", "0.00"),
        ("2025-03-10 10:00:18", "0.01"),
    ],
)
def test_approval_lag_of_any_length(spark, approved, hours):
    orders = raw_table(spark, "orders", order("O1", order_approved_at=approved))
    assert staging.stage_orders(orders).first().approval_lag_hours == D(hours)


def test_costs_come_from_unrounded_prices_and_ratios(spark):
    items = raw_table(spark, "order_items", item("A", product="R", price="1000.00"), item("B", product="H", price="10.005"))
    products = raw_table(spark, "products", product("R", ratio="0.33335"), product("H", ratio="0.5"))
    got = rows_by(staging.line_economics(items, products), "order_id")
    assert (got["A"].unit_cogs, got["A"].gross_profit, got["A"].cost_ratio) == (D("333.35"), D("666.65"), D("0.33335"))
    assert (got["B"].unit_cogs, got["B"].gross_profit, got["B"].selling_price) == (D("5.00"), D("5.00"), D("10.01"))


def test_payments_are_summed_before_they_are_rounded(spark):
    payments = raw_table(spark, "order_payments", payment("A", "0.004", "upi"), payment("A", "0.004", "upi", seq=2))
    row = staging.payments_by_order(payments).first()
    assert (row.total_payment_value, row.total_payment_fee, row.effective_fee_rate_pct) == (D("0.01"), D("0.00"), D("0.500"))


def test_delivery_and_approval_measures(spark):
    orders = raw_table(
        spark,
        "orders",
        order(
            "late",
            order_approved_at="2025-03-10 11:30:00",
            order_delivered_customer_date="2025-03-15 12:00:00",
            order_estimated_delivery_date="2025-03-15 00:00:00",
        ),
        order(
            "early",
            order_delivered_customer_date="2025-03-13 12:00:00",
            order_estimated_delivery_date="2025-03-15 00:00:00",
        ),
        order("open", order_estimated_delivery_date="2025-03-15 00:00:00", order_discount_amount="12.5"),
    )
    got = rows_by(staging.stage_orders(orders), "order_id")
    assert (got["late"].delivery_delay_days, got["late"].is_late_delivery) == (0, True)
    assert got["late"].approval_lag_hours == D("1.50")
    assert (got["early"].delivery_delay_days, got["early"].is_late_delivery) == (-1, False)
    assert (got["open"].delivery_delay_days, got["open"].is_late_delivery) == (None, False)
    assert got["open"].approval_lag_hours is None
    assert (got["open"].discount_amount, got["early"].discount_amount) == (D("12.50"), D("0.00"))
    assert got["open"].order_month == date(2025, 3, 1)


def test_items_keep_unknown_products_and_drop_open_orders(spark):
    items = raw_table(
        spark,
        "order_items",
        item("O1", 1, price="10.01"),
        item("O1", 2, product="none"),
        item("O2", 1),
    )
    orders = raw_table(spark, "orders", order("O1"))
    products = raw_table(spark, "products", product(ratio="0.35"))
    got = rows_by(staging.stage_order_items(items, orders, products), "order_item_id")
    assert set(got) == {1, 2}
    # 10.01 * 0.35 = 3.5035 and 6.5065
    assert (got[1].unit_cogs, got[1].gross_profit, got[1].gross_margin_pct) == (D("3.50"), D("6.51"), D("65.00"))
    assert (got[2].unit_cogs, got[2].gross_profit, got[2].category) == (None, None, None)


def test_payments_split_and_unmapped(spark):
    payments = raw_table(
        spark,
        "order_payments",
        payment("split", "40", "voucher", 1, 1),
        payment("split", "60", "credit_card", 2, 6),
        payment("wallet", "100", "wallet"),
        payment("none", "100", None),
        payment("tie", "50", "upi", 2),
        payment("tie", "50", "voucher", 1),
        payment("zero", "0", "upi"),
        payment("null", None, "upi", 1),
        payment("null", "5", "voucher", 2),
        payment("open", "1"),
    )
    orders = raw_table(spark, "orders", *[order(o) for o in ("split", "wallet", "none", "tie", "zero", "null")])
    got = rows_by(staging.stage_payments(payments, orders), "order_id")
    assert set(got) == {"split", "wallet", "none", "tie", "zero", "null"}
    s = got["split"]
    assert (s.payment_count, s.primary_payment_type, s.max_installments) == (2, "credit_card", 6)
    assert (s.total_payment_value, s.total_payment_fee, s.effective_fee_rate_pct) == (D("100"), D("1.50"), D("1.500"))
    assert (got["wallet"].total_payment_fee, got["wallet"].effective_fee_rate_pct) == (D("2.00"), D("2.000"))
    assert got["none"].total_payment_fee == D("2.00")
    assert got["tie"].primary_payment_type == "voucher"
    assert got["zero"].effective_fee_rate_pct is None
    assert got["null"].primary_payment_type == "voucher"


def test_products_and_deals(spark):
    products = raw_table(
        spark,
        "products",
        product(
            list_price_min="299",
            list_price_max="800",
            product_length_cm="10",
            product_height_cm="22",
            product_width_cm="21",
        ),
    )
    p = staging.stage_products(products).first()
    assert (p.avg_list_price, p.volumetric_weight_kg, p.weight_g) == (D("549.50"), D("0.924"), None)

    leads = raw_table(spark, "marketing_qualified_leads", {"mql_id": "m", "first_contact_date": "2025-01-30", "origin": "email"})
    deals = raw_table(
        spark,
        "closed_deals",
        {"mql_id": "m", "won_date": "2025-02-02", "declared_monthly_revenue": "10.5"},
        {"mql_id": "x", "won_date": "2025-02-02"},
    )
    d = rows_by(staging.stage_deals(deals, leads), "mql_id")
    assert (d["m"].days_to_close, d["m"].channel, d["m"].won_month) == (3, "email", date(2025, 2, 1))
    assert (d["x"].days_to_close, d["x"].channel) == (None, None)


def funnel(spark):
    leads = raw_table(
        spark,
        "marketing_qualified_leads",
        *[{"mql_id": f"m{i}", "first_contact_date": "2025-01-01", "origin": "display"} for i in range(3)],
        {"mql_id": "n", "first_contact_date": "2025-01-01", "origin": None},
    )
    deals = raw_table(spark, "closed_deals", {"mql_id": "m0", "won_date": "2025-01-05"})
    customers = raw_table(
        spark,
        "customers",
        customer("C1", "organic_search"),
        customer("C2", "referral"),
        customer("C3", "email"),
        customer("C4", "email"),
        customer("C5", "email"),
        customer("C6", "paid_search"),
    )
    orders = raw_table(spark, "orders", *[order(f"O{i}", f"C{c}") for i, c in enumerate([1, 2, 2, 3, 4, 5])])
    staged = staging.stage_leads(leads)
    return staging.channel_funnel(staged, staging.stage_deals(deals, leads), customers, orders)


def test_funnel_and_spend(spark):
    got = rows_by(staging.attach_spend(funnel(spark)), "channel")
    assert set(got) == {"display", None, "organic_search", "referral", "email"}
    assert (got["display"].total_leads, got["display"].total_deals, got["display"].new_customers) == (3, 1, 0)
    assert got["display"].lead_conversion_rate_pct == D("33.33")
    assert (got["display"].estimated_monthly_spend, got["display"].estimated_cac) == (None, None)
    assert (got["organic_search"].estimated_monthly_spend, got["organic_search"].estimated_cac) == (0, 0)
    assert got["referral"].estimated_cac == D("5000.00")
    assert got["referral"].lead_conversion_rate_pct is None
    assert (got["email"].new_customers, got["email"].estimated_cac) == (3, D("2666.67"))


def test_spend_without_customers_has_no_cac(spark):
    got = rows_by(staging.attach_spend(funnel(spark), {"display": D("10")}), "channel")
    assert (got["display"].estimated_monthly_spend, got["display"].estimated_cac) == (D("10.00"), None)
    assert got["email"].estimated_cac is None
