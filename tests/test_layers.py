import os
import subprocess
import sys
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marginfold.functions.counts import TableCounts
from marginfold.operators import checks, views
from marginfold.schemas import RAW_COLUMNS
from marginfold.sources import layers
from marginfold.sources.csv_raw import read_csv, split_by_lines
from marginfold.sources.layers import Layer, current_path, read_table, replace_table, stored_counts, table_path, write_table


def _values(spark, root):
    return sorted(row["id"] for row in read_table(spark, root, "x", "t").collect())


def _versions(path):
    return sorted(name for name in os.listdir(path) if name.startswith("v-"))


def test_a_failed_write_leaves_the_old_table_and_nothing_else(spark, tmp_path):
    root = str(tmp_path)
    path = table_path(root, "x", "t")
    write_table(spark.range(3), root, "x", "t")
    old = _versions(path)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_table(broken, root, "x", "t")
    assert _values(spark, root) == [0, 1, 2] and _versions(path) == old


def test_a_failure_before_the_switch_keeps_the_old_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    path = table_path(root, "x", "t")
    write_table(spark.range(3), root, "x", "t")
    old = _versions(path)

    def fails(*_):
        # The new version is complete, but the pointer still names the old one.
        assert len(_versions(path)) == 2 and _values(spark, root) == [0, 1, 2]
        raise OSError("lost the store")

    with monkeypatch.context() as patch:
        patch.setattr(layers, "_point", fails)
        with pytest.raises(OSError, match="lost the store"):
            write_table(spark.range(9), root, "x", "t")
    assert _values(spark, root) == [0, 1, 2] and _versions(path) == old
    write_table(spark.range(2), root, "x", "t")
    assert _values(spark, root) == [0, 1]


def test_an_open_reader_goes_on_over_one_replacement(spark, tmp_path):
    root = str(tmp_path)
    path = table_path(root, "x", "t")
    opened = write_table(spark.range(3), root, "x", "t")
    # A table may be replaced by what is read from it.
    write_table(opened.select((F.col("id") + 10).alias("id")), root, "x", "t")
    assert sorted(row["id"] for row in opened.collect()) == [0, 1, 2] and _values(spark, root) == [10, 11, 12]
    write_table(spark.range(1), root, "x", "t")
    assert len(_versions(path)) == 2 and _values(spark, root) == [0]


def test_counts_are_kept_with_the_version(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("a.b"), (F.col("id") % 4).alias("month"))
    replace_table(rows, table_path(root, "x", "t"), "month", nulls_of=["a.b", "month"])
    replace_table(rows.limit(0), table_path(root, "x", "none"), nulls_of=["id"])
    got = stored_counts(spark, root, "x", ["t", "none", "absent"])
    assert got == {"t": TableCounts(1000, {"a.b": 334, "month": 0}), "none": TableCounts(0, {"id": 0})}
    # A later version has counts of its own; a table written by others has none.
    write_table(rows.where("id < 10"), root, "x", "t")
    rows.write.parquet(table_path(root, "x", "plain"))
    assert stored_counts(spark, root, "x", ["t", "plain"]) == {"t": TableCounts(10)}
    assert read_table(spark, root, "x", "t").count() == 10


def test_checks_from_kept_counts_read_no_table(spark, tmp_path):
    root = str(tmp_path)
    names = ["rpt_loss_making_orders", "rpt_profit_waterfall", "rpt_cac_by_channel"]
    for n, name in enumerate(names):
        frame = spark.range(n).select(F.nullif("id", F.lit(0)).alias("id"))
        replace_table(frame, table_path(root, "x", name), nulls_of=["id"])
    tables, known = Layer(spark, root, "x", names), stored_counts(spark, root, "x", names)
    for from_kept, read in (
        (views.table_counts(tables, known), views.table_counts(tables)),
        (checks.report_completeness(tables, known), checks.report_completeness(tables)),
        (checks.check_min_rows(tables, dict.fromkeys(names, 1), known), checks.check_min_rows(tables, dict.fromkeys(names, 1))),
        (checks.check_required_columns(tables, dict.fromkeys(names, ["id"]), known), checks.check_required_columns(tables, dict.fromkeys(names, ["id"]))),
    ):
        assert sorted(map(tuple, from_kept.collect())) == sorted(map(tuple, read.collect()))
        plans = [f._jdf.queryExecution().executedPlan().toString() for f in (from_kept, read)]
        assert "FileScan" not in plans[0] and "FileScan" in plans[1]
    assert "FileScan" in checks.check_min_rows(tables, {names[0]: 1}, {})._jdf.queryExecution().executedPlan().toString()


def test_a_plain_folder_is_read_and_replaced(spark, tmp_path):
    path = table_path(str(tmp_path), "x", "t")
    spark.range(4).write.parquet(path)
    assert current_path(spark, path) == path and _values(spark, str(tmp_path)) == [0, 1, 2, 3]
    replace_table(spark.range(2), path)
    assert _values(spark, str(tmp_path)) == [0, 1] and not [name for name in os.listdir(path) if name.startswith("part-")]


def _lines(rows, columns=RAW_COLUMNS["customers"]):
    return "\n".join([",".join(columns), *(",".join(row) for row in rows)]) + "\n"


def test_only_files_with_line_breaks_in_fields_are_read_whole(spark, tmp_path):
    n = len(RAW_COLUMNS["customers"])
    contents = {
        "plain.csv": _lines([[f"c{i}", *["x"] * (n - 1)] for i in range(5)]),
        "quoted.csv": _lines([['"a, ""b"""', *["x"] * (n - 1)], ["", *['""'] * (n - 1)]]),
        "broken.csv": _lines([['"two\nlines"', *["x"] * (n - 1)]]),
        # Quotes inside an unquoted field prove nothing, although their number is even.
        "stray.csv": _lines([['5"', '6"', *["x"] * (n - 2)]]),
    }
    for name, content in contents.items():
        (tmp_path / name).write_text(content)
    by_line, as_whole = split_by_lines(spark, str(tmp_path))
    assert [Path(file).name for file in by_line] == ["plain.csv", "quoted.csv"]
    assert [Path(file).name for file in as_whole] == ["broken.csv", "stray.csv"]
    first = RAW_COLUMNS["customers"][0]
    found = {row[first] for row in read_csv(spark, str(tmp_path), "customers").collect()}
    assert found == {*(f"c{i}" for i in range(5)), 'a, "b"', None, "two\nlines", '5"'}


def test_a_large_plain_file_is_read_by_several_tasks(spark, tmp_path):
    n = len(RAW_COLUMNS["customers"])
    path = tmp_path / "customers.csv"
    path.write_text(_lines([[f"c{i}", *["some text"] * (n - 1)] for i in range(20_000)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        frame = read_csv(spark, str(path), "customers")
        assert frame.rdd.getNumPartitions() > 3
        first = RAW_COLUMNS["customers"][0]
        assert frame.select(first).distinct().count() == frame.count() == 20_000
        long = tmp_path / "long.csv"
        long.write_text(_lines([['"' + 'a ""b"", ' * 300_000 + '"', *["x"] * (n - 1)]]))
        assert read_csv(spark, str(long), "customers").count() == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_scratch_goes_with_the_application(tmp_path):
    code = (
        "import sys; sys.path.insert(0, sys.argv[1])\n"
        "from pyspark.sql import SparkSession\n"
        "from marginfold.sources.scratch import written\n"
        "spark = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').config('spark.checkpoint.dir', sys.argv[2]).getOrCreate()\n"
        "assert written(spark.range(3)).count() == 3\n"
        "import os; assert os.listdir(sys.argv[2])\n"
    )
    root = str(Path(__file__).resolve().parent.parent)
    subprocess.run([sys.executable, "-c", code, root, str(tmp_path)], check=True, timeout=120, env=os.environ | {"SPARK_LOCAL_IP": "127.0.0.1"})

    def left():
        return [name for name in os.listdir(tmp_path) if name.startswith("marginfold")]

    # The JVM ends a little after Python.
    until = time.monotonic() + 30
    while left() and time.monotonic() < until:
        time.sleep(0.2)
    assert not left()


def test_layers_are_written_with_zstandard(spark, tmp_path):
    write_table(spark.range(3), str(tmp_path), "x", "t")
    path = table_path(str(tmp_path), "x", "t")
    files = [name for name in os.listdir(f"{path}/{_versions(path)[0]}") if name.startswith("part-")]
    assert files and all(name.endswith(".zstd.parquet") for name in files)
