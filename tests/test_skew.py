"""Hot keys on real shuffles: adaptive execution splits their partitions."""

import re

import pytest
from pyspark.sql import functions as F

from marginfold.operators import staging
from marginfold.plans.mart import Mart
from marginfold.schemas import RAW_COLUMNS
from marginfold.sources.scratch import written

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def small_partitions(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


def _table(spark, name, n, **columns):
    given = {c: F.expr(e).cast("string") for c, e in columns.items()}
    # Many files, as map tasks are what a hot partition is split by.
    frame = spark.range(0, n, 1, 16)
    return frame.select(*[given.get(c, F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS[name]])


def _raw(spark, customer, product):
    tables = {name: _table(spark, name, 0) for name in RAW_COLUMNS}
    tables["orders"] = _table(
        spark, "orders", 20_000, order_id="uuid()", customer_id=customer, order_status="'delivered'", order_purchase_timestamp="'2025-01-01 00:00:00'"
    )
    tables["order_items"] = _table(spark, "order_items", 20_000, order_id="id", order_item_id="1", product_id=product, seller_id="uuid()", price="10", freight_value="1")
    tables["customers"] = _table(spark, "customers", 200, customer_id="concat('c', id)", customer_segment="'Mass'")
    tables["products"] = _table(spark, "products", 200, product_id="concat('p', id)", estimated_cost_ratio="0.5")
    return tables


def _ran(frame):
    frame.write.format("noop").mode("overwrite").save()
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def test_a_huge_product_is_split(spark, small_partitions):
    raw = _raw(spark, "'c1'", "if(id % 2 = 0, 'p7', concat('p', id % 200))")
    rows, plan = _ran(staging.line_economics(raw["order_items"], raw["products"]))
    assert len(rows) == 20_000 and all(r.unit_cogs == 5 for r in rows)
    assert re.search("skew=true", plan)


def test_a_huge_customer_is_split(spark, small_partitions):
    m = Mart(_raw(spark, "if(id % 2 = 0, 'c7', concat('c', id % 200))", "'p1'"))
    # As in a build, the staged orders are a table of several files.
    orders = written(m.stg_orders.repartition(16))
    rows, plan = _ran(orders.join(m.stg_customers, "customer_id"))
    assert len(rows) == 20_000
    assert re.search("skew=true", plan)
