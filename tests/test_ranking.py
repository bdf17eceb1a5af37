import pytest
from pyspark.sql import Window, functions as F

from marginfold.functions import ranking
from marginfold.functions.ranking import row_number_by


@pytest.mark.parametrize("parts", ["1", "8", "37"])
def test_equals_the_plain_window(spark, parts):
    # One key holds a third of all rows.
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.xxhash64("id") % 40).alias("v"),
        "id",
    )
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = row_number_by(rows, F.col("k"), [F.asc("v"), F.asc("id")], "n")
        want = rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("bigint"))
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0
        assert got.count() == 3000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_one_key_with_one_time_fills_several_tasks(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(ranking, "written", lambda frame: seen.append(written_for_test(frame)) or seen[-1])
    from marginfold.sources.scratch import written as written_for_test

    rows = spark.range(4000).select(F.lit("c").alias("k"), F.lit(7).alias("day"), F.col("id").cast("string").alias("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = row_number_by(rows, F.col("k"), [F.asc("day"), F.asc("id")], "n")
        assert sorted(r["n"] for r in got.collect()) == list(range(1, 4001))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # The window's groups are (key, part).
    sizes = [r["count"] for r in seen[0].groupBy("_key", "_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000


def _numbered(rows):
    return rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("id")).cast("bigint"))


def test_keys_of_usual_size_take_one_window_and_are_not_written(spark, monkeypatch):
    monkeypatch.setattr(ranking, "written", lambda frame: pytest.fail("rows were written"))
    rows = spark.range(6000).select((F.col("id") % 1500).alias("k"), "id")
    got = row_number_by(rows, F.col("k"), [F.asc("id")], "n")
    assert got.exceptAll(_numbered(rows)).count() == 0 and got.count() == 6000
    # One shuffle of the rows.
    assert got._jdf.queryExecution().sparkPlan().toString().count("Window") == 1


def test_only_huge_keys_are_spread(spark, monkeypatch):
    from marginfold.sources.scratch import written as written_for_test

    seen = []
    monkeypatch.setattr(ranking, "written", lambda frame: seen.append(written_for_test(frame)) or seen[-1])
    # A third of the rows has one key, some have none.
    key = F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 3 == 1, F.col("id") % 2000).when(F.col("id") % 9 != 8, F.col("id"))
    rows = spark.range(9000).select(key.alias("k"), "id")
    got = row_number_by(rows, F.col("k"), [F.asc("id")], "n")
    want = _numbered(rows.filter("k IS NOT NULL"))
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() == 8000
    assert 3000 <= seen[0].count() < 3100 and seen[0].filter("k = -1").count() == 3000


def test_a_key_that_is_a_column_is_shuffled_once(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LEAST_ROWS", 10_000)
    rows = spark.range(300).select((F.col("id") % 7).alias("k"), "id")
    got = row_number_by(rows, F.col("k"), [F.asc("id")], "n")
    assert sorted(r["n"] for r in got.filter("k = 0").collect()) == list(range(1, 44))
    assert "_key" not in got._jdf.queryExecution().executedPlan().toString()
