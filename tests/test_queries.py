import shutil

from pyspark.sql import functions as F

from marginfold.sources.layers import path_exists, table_path
from marginfold.sources.tpch import StarTables
from marginfold.verify import queries

FOLDER = "/root/testdata/sf0.001"


def test_a_query_writes_only_the_raw_tables_that_it_reads(spark, monkeypatch):
    monkeypatch.setattr(queries, "_made", {})
    queries.queries()["b05_stage_customers"](spark, FOLDER)
    raw = queries.raw_layer(spark, FOLDER)
    there = [name for name in raw if path_exists(spark, table_path(raw._root, "raw", name))]
    assert there == ["customers"]


def test_a_changed_folder_is_read_anew(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "_made", {})
    for name in ("customer", "nation"):
        shutil.copy(f"{FOLDER}/{name}.parquet", tmp_path)
    query = queries.queries()["b05_stage_customers"]
    before = query(spark, str(tmp_path)).count()
    spark.read.parquet(f"{FOLDER}/customer.parquet").limit(7).write.parquet(f"{tmp_path}/new")
    (tmp_path / "customer.parquet").unlink()
    part = next((tmp_path / "new").glob("*.parquet"))
    shutil.copy(part, tmp_path / "customer.parquet")
    assert before > 7 and query(spark, str(tmp_path)).count() == 7


def star_tables(spark, folder):
    """Small tables: 30 orders of two lines each, ten customers and parts, twelve events."""
    day = F.lit("2024-03-05 00:00:00").cast("timestamp")
    key, double = F.col("id"), lambda value: F.lit(value).cast("double")
    tables = {
        "orders": spark.range(30).select(
            key.alias("o_orderkey"), (key % 10).alias("o_custkey"), F.lit("F").alias("o_orderstatus"),
            double(1).alias("o_totalprice"), day.alias("o_orderdate"), F.lit("3-MEDIUM").alias("o_orderpriority"),
        ),
        "lineitem": spark.range(60).select(
            (key % 30).alias("l_orderkey"), (key % 10).alias("l_partkey"), F.lit(1).cast("bigint").alias("l_suppkey"),
            F.lit(1).alias("l_linenumber"), double(1).alias("l_quantity"), (key * 100 + 9000.0).alias("l_extendedprice"),
            double(0.05).alias("l_discount"), double(0.02).alias("l_tax"), F.lit("N").alias("l_returnflag"),
            F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
        ),
        "customer": spark.range(10).select(
            key.alias("c_custkey"), F.lit("a name").alias("c_name"), F.lit(0).alias("c_nationkey"),
            double(1).alias("c_acctbal"), F.lit("MACHINERY").alias("c_mktsegment"),
        ),
        "nation": spark.range(1).select(key.cast("int").alias("n_nationkey"), F.lit("N").alias("n_name"), F.lit(0).alias("n_regionkey")),
        "part": spark.range(10).select(
            key.alias("p_partkey"), F.lit("a part").alias("p_name"), F.lit("Brand#1").alias("p_brand"),
            F.lit("LARGE").alias("p_type"), F.lit(3).alias("p_size"), double(900.5).alias("p_retailprice"),
        ),
        "events": spark.range(12).select(
            key.alias("event_id"), day.alias("ts"), key.alias("user_id"), F.lit("click").alias("event_type"),
            (key * 30.0).alias("value"), F.lit("{}").alias("props"),
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_csv_copies_are_compressed_and_need_no_raw_tables(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "_made", {})
    monkeypatch.setattr(queries, "_CSV_ROWS", 7)
    folder = star_tables(spark, tmp_path)
    loaded = {r.table_name: (r.status, r.row_count) for r in queries.queries()["b41_load_raw"](spark, folder).collect()}
    assert set(loaded.values()) == {("OK", n) for n in (10, 12, 30, 60, 8)}
    raw = queries.raw_layer(spark, folder)
    assert not [name for name in raw if path_exists(spark, table_path(raw._root, "raw", name))]
    copies = spark.read.text(f"{queries._csv_copy(spark, folder)}/order_items.csv").groupBy("_metadata.file_path").count().collect()
    # Rows and the header of a file.
    assert all(r.file_path.endswith(".csv.gz") and r["count"] <= 8 for r in copies)
    got = queries.queries()["b41_loaded_order_items"](spark, folder)
    want = queries.queries()["b02_stage_order_items"](spark, folder)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 60


def test_lines_and_payments_are_numbered_once(spark, tmp_path):
    star_tables(spark, str(tmp_path))
    tables = StarTables(spark, str(tmp_path))
    lines, payments = tables.order_items(), tables.order_payments()
    for frame in (lines, payments):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
    numbers = [(r[0], r[1]) for r in lines.select("order_id", "order_item_id").collect()]
    assert len(set(numbers)) == 60 and {n for _, n in numbers} == {1, 2}
    assert sorted(numbers) == sorted((r[0], r[1]) for r in payments.select("order_id", "payment_sequential").collect())


def test_numbered_lines_go_when_the_csv_copies_are_made(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(queries, "_made", {})
    folder = star_tables(spark, tmp_path)
    queries._csv_copy(spark, folder)
    tables = queries.raw_layer(spark, folder)._tables
    assert "_lines" not in vars(tables) and not path_exists(spark, tables._lines_path)
    assert tables.order_items().count() == 60


def test_the_key_check_reads_the_fact_without_writing_it(spark, monkeypatch, tmp_path):
    star_tables(spark, str(tmp_path))
    monkeypatch.setattr(queries, "_made", {})
    monkeypatch.setattr(queries, "_StoredMart", None)
    rows = {r["table_name"]: r for r in queries.queries()["q1_check_key"](spark, str(tmp_path)).collect()}
    assert rows["fact_order_items"]["row_count"] == 60 and rows["fact_order_items"]["status"] == "PASS"
