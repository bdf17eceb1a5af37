"""Row numbers within a key that stay distributed when one key is huge."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from marginfold.sources.scratch import written


# Keys are counted by hash bucket; the driver sees at most this many counts.
BUCKETS = 4096
# A bucket with more rows than the least, and than a thousandth of all or the most, may hold a huge key.
LEAST_ROWS, MOST_ROWS = 1_000, 1_000_000


def row_number_by(rows: DataFrame, key: Column, order_by: list[Column], out: str) -> DataFrame:
    """Exact ``row_number() OVER (PARTITION BY key ORDER BY order_by)``; rows with a NULL ``key`` are left out.

    A window sorts each key in one task, which is right for all but huge keys. Rows are counted by hash of
    their key first, the only job that runs at once; the buckets that could hold a huge key take the way
    that spreads every key, all others one window. The window takes the key as given, so that a plain
    column is shuffled once.
    """
    keyed = rows.filter(key.isNotNull())
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    sizes = {r["bucket"]: r["rows"] for r in keyed.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("rows")).collect()}
    limit = min(max(sum(sizes.values()) // 1000, LEAST_ROWS), MOST_ROWS)
    large = sorted(b for b, size in sizes.items() if size > limit)
    if not large:
        return _by_window(keyed, key, order_by, out).select(*rows.columns, out)
    if 2 * sum(sizes[b] for b in large) > sum(sizes.values()):
        return _by_parts(keyed.withColumn("_key", key), order_by, out).select(*rows.columns, out)
    spread = _by_parts(keyed.filter(bucket.isin(large)).withColumn("_key", key), order_by, out)
    others = _by_window(keyed.filter(~bucket.isin(large)), key, order_by, out)
    return others.select(*rows.columns, out).unionByName(spread.select(*rows.columns, out))


def _by_window(keyed: DataFrame, key: Column, order_by: list[Column], out: str) -> DataFrame:
    numbered = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    return keyed.withColumn(out, numbered.cast("bigint"))


def _by_parts(keyed: DataFrame, order_by: list[Column], out: str) -> DataFrame:
    """Row numbers where one key may have any number of rows.

    The rows are range-partitioned by key and order, which spreads every key over as many parts as its
    rows fill, whatever they have in common; rows are numbered within key and part, and the rows of the
    key's earlier parts are added. Where a part ends depends on a sample, so the parts are written to
    the shared folder and read for both.
    """
    parts = written(
        keyed.repartitionByRange(F.asc("_key"), *order_by).withColumn("_part", F.spark_partition_id())
    )
    by_part = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = (
        parts.groupBy("_key", "_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_key", "_part", F.coalesce(F.sum("_rows").over(by_part), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy("_key", "_part").orderBy(*order_by))
    return (
        parts.withColumn("_within", within.cast("bigint"))
        .join(earlier, ["_key", "_part"])
        .withColumn(out, F.col("_within") + F.col("_before"))
    )
