"""Hand-built raw tables for the tests."""

from marginfold.schemas import RAW_COLUMNS, raw_schema


def raw_table(spark, table, *rows):
    """Rows given as dicts of any values; everything arrives as text, absent columns as NULL."""
    text = [tuple(None if r.get(c) is None else str(r[c]) for c in RAW_COLUMNS[table]) for r in rows]
    return spark.createDataFrame(text, raw_schema(table))


def order(order_id, customer="C1", status="delivered", at="2025-03-10 10:00:00", channel="organic_search", **more):
    return {
        "order_id": order_id,
        "customer_id": customer,
        "order_status": status,
        "order_purchase_timestamp": at,
        "order_channel": channel,
        **more,
    }


def item(order_id, line=1, product="P40", price="1000", freight="50"):
    return {
        "order_id": order_id,
        "order_item_id": line,
        "product_id": product,
        "seller_id": "S1",
        "price": price,
        "freight_value": freight,
    }


def payment(order_id, value="1000", kind="credit_card", seq=1, installments=1):
    return {
        "order_id": order_id,
        "payment_sequential": seq,
        "payment_type": kind,
        "payment_installments": installments,
        "payment_value": value,
    }


def product(product_id="P40", ratio="0.40", category="Beauty", **more):
    return {
        "product_id": product_id,
        "product_category_name": category,
        "estimated_cost_ratio": ratio,
        **more,
    }


def customer(customer_id="C1", channel="email", segment="Mass", state="SP"):
    return {
        "customer_id": customer_id,
        "customer_unique_id": f"U{customer_id}",
        "customer_segment": segment,
        "customer_state": state,
        "acquisition_channel": channel,
    }


def raw_tables(spark, **rows):
    """All seven raw tables; those not given are empty."""
    return {name: raw_table(spark, name, *rows.get(name, [])) for name in RAW_COLUMNS}
