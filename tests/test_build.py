"""CSV ingestion and the whole build, over small files written here."""

import threading

import pytest

from marginfold.params import EconomicsParams
from marginfold.plans import build
from marginfold.plans.build import run_all
from marginfold.plans.together import together
from marginfold.sources import layers
from marginfold.sources.csv_raw import load_raw, read_csv
from marginfold.sources.layers import Layer, ordered_report, read_table
from marginfold.sources.scratch import discard

FILES = {
    # Columns out of order, an absent column, a quoted comma and doubled quotes.
    "orders.csv": """customer_id,order_id,order_status,order_purchase_timestamp,order_discount_amount,order_channel
C1,O1,delivered,2025-01-05 10:00:00,,email
C1,O2,returned,2025-02-05 10:00:00,5.00,email
C2,O3,shipped,2025-02-06 10:00:00,1.00,referral
""",
    "order_items.csv": """order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value
O1,1,P1,S1,2025-01-09,100.00,5.00
O1,2,P1,S1,2025-01-09,300.00,5.00
O2,1,P1,S1,2025-02-09,50.00,5.00
O3,1,P1,S1,2025-02-09,50.00,5.00
""",
    "order_payments.csv": """order_id,payment_sequential,payment_type,payment_installments,payment_value
O1,1,credit_card,3,400.00
O2,1,upi,1,45.00
""",
    "products.csv": '''product_id,product_category_name,estimated_cost_ratio
P1,"Home, ""Decor""",0.35
''',
    "customers.csv": """customer_id,customer_unique_id,customer_city,customer_state,customer_segment,acquisition_channel
C1,U1,NA,SP,Mass,email
C2,U2,"",RJ,Mass,referral
""",
    "marketing_qualified_leads.csv": "mql_id,wrong\nm1,2\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("csv")
    for name, text in FILES.items():
        (path / name).write_text(text, encoding="utf-8")
    return str(path)


def test_columns_are_matched_by_name(spark, folder):
    row = read_csv(spark, f"{folder}/orders.csv", "orders").filter("order_id = 'O1'").first()
    assert (row.customer_id, row.order_approved_at, row.order_discount_amount) == ("C1", None, None)
    assert read_csv(spark, f"{folder}/products.csv", "products").first().product_category_name == 'Home, "Decor"'
    cities = {r.customer_id: r.customer_city for r in read_csv(spark, f"{folder}/customers.csv", "customers").collect()}
    assert cities == {"C1": "NA", "C2": None}


def test_status_rows(spark, folder, tmp_path):
    got = {r.table_name: r for r in load_raw(spark, folder, str(tmp_path)).collect()}
    assert (got["orders"].status, got["orders"].row_count) == ("OK", 3)
    assert (got["closed_deals"].status, got["closed_deals"].row_count) == ("MISSING", 0)
    assert got["marketing_qualified_leads"].status == "ERROR" and "wrong" in got["marketing_qualified_leads"].error
    for broken in ("closed_deals", "marketing_qualified_leads"):
        assert read_table(spark, str(tmp_path), "raw", broken).count() == 0


def test_quoted_fields_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "customers.csv").write_text('customer_id,customer_city\nC1,"Rio\nde ""J"""\nC2,"a,\n\nb"\n', encoding="utf-8")
    rows = {r.customer_id: r.customer_city for r in read_csv(spark, f"{tmp_path}/customers.csv", "customers").collect()}
    assert rows == {"C1": 'Rio\nde "J"', "C2": "a,\n\nb"}


def test_missing_folder_touches_nothing(spark, folder, tmp_path):
    root = str(tmp_path)
    load_raw(spark, folder, root)
    for action in (load_raw, run_all):
        with pytest.raises(FileNotFoundError):
            action(spark, f"{folder}/not there", root)
    assert read_table(spark, root, "raw", "orders").count() == 3
    assert not (tmp_path / "staging").exists()


def test_whole_build_is_repeatable(spark, folder, tmp_path):
    root = str(tmp_path)
    for _ in range(2):
        result = run_all(spark, folder, root)
    counts = {r.table_name: r.row_count for r in result.counts.collect()}
    assert counts["staging.stg_orders"] == 2 and counts["analytics.fact_order_items"] == 3
    assert {r.check_name: r.status for r in result.checks.collect()} == {
        "Revenue matches raw source": "PASS",
        "Payment fee allocation sums correctly": "PASS",
        "No CAC on repeat orders": "PASS",
        "net_profit = CM - CAC (cascade integrity)": "PASS",
        "Return cost only on returned orders": "PASS",
        "All 5 report tables populated": "PASS",
    }
    fact = Layer(spark, root, "analytics", ["fact_order_items"])["fact_order_items"]
    assert str(fact.schema["order_month"].dataType) == "DateType()"
    months = [r.month_label for r in ordered_report(spark, root, "summary_by_month").collect()]
    assert months == ["Jan 2025", "Feb 2025"]
    assert spark.table("dim_customers").filter("customer_id = 'C1'").first().total_orders == 2
    with pytest.raises(KeyError):
        ordered_report(spark, root, "nope")


def test_bad_value_stops_the_build(spark, folder, tmp_path):
    other = tmp_path / "csv"
    other.mkdir()
    for name, text in FILES.items():
        (other / name).write_text(text.replace("100.00", "much"), encoding="utf-8")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_all(spark, str(other), str(tmp_path / "out"))


def test_independent_steps_run_at_once_and_a_failure_is_raised(spark):
    met = threading.Barrier(2, timeout=60)

    def step(n):
        met.wait()
        return spark.range(n).count()

    assert list(together(spark, {"b": lambda: step(5), "a": lambda: step(7)}).items()) == [("b", 5), ("a", 7)]
    assert together(spark, {}) == {}
    ran = []

    def broken():
        raise ValueError("broken")

    with pytest.raises(ValueError, match="broken"):
        together(spark, {"x": broken, "y": lambda: ran.append("y")}, at_once=1)
    assert not ran


def test_settings(tmp_path):
    path = tmp_path / "settings.json"
    path.write_text(
        '{"payment_fee_rates": {"upi": 0.01, "default": 0.03}, "return_cost": {"restocking_fee_rate": 0.2},'
        ' "marketing_spend": {"email": 9}, "staging_order_statuses": ["delivered"]}'
    )
    params = EconomicsParams.from_file(path)
    assert [str(v) for v in (params.fee_rates["upi"], params.default_fee_rate, params.restocking_rate)] == [
        "0.01",
        "0.03",
        "0.2",
    ]
    assert params.completed_statuses == ("delivered",) and params.reverse_logistics_multiplier == 1


def test_the_joined_base_is_written_before_it_moves(spark, folder, tmp_path, monkeypatch):
    plans, discarded = {}, []

    def write_table(frame, root, layer, table, *args, **kwargs):
        plans[table] = frame._jdf.queryExecution().executedPlan().toString()
        return layers.write_table(frame, root, layer, table, *args, **kwargs)

    monkeypatch.setattr(build, "write_table", write_table)
    monkeypatch.setattr(build, "discard", lambda spark, path: (discarded.append(path), discard(spark, path)))
    run_all(spark, folder, str(tmp_path))
    moved = plans["fact_order_items"]
    assert moved.count("Exchange") == 1 and "Join" not in moved
    assert len(discarded) == 2 and not any(layers.path_exists(spark, path) for path in discarded)
    assert read_table(spark, str(tmp_path), "analytics", "fact_order_items").count() == 3
