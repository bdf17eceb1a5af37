"""Parquet layers: raw, staging and analytics tables under one root folder.

A table is a folder of versions and a small file that names the current one; ``read_table`` follows it.
Row and NULL counts are taken while a version is written and kept in it, so that counting reads no table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from marginfold.functions.counts import TableCounts
from marginfold.operators.views import REPORT_ORDER, in_report_order
from marginfold.sources.scratch import discard, shuffles_freed


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def table_path(root: str, layer: str, table: str) -> str:
    return f"{root}/{layer}/{table}"


# Layers are written once and read often: smaller files are worth the time to make them.
COMPRESSION = "zstd"
_POINTER = "_current"
_COUNTS = "_counts.json"


def _text_of(spark: SparkSession, path: str) -> str | None:
    """The content of a small file; None where there is none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(target):
        return None
    content = store.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(content, "UTF-8")
    finally:
        content.close()


def _put_text(spark: SparkSession, path: str, text: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    content = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    content.write(bytearray(text.encode()))
    content.close()


def _version(spark: SparkSession, path: str) -> str | None:
    """The name of the folder that a table's pointer names; None for a plain folder of files."""
    return _text_of(spark, f"{path}/{_POINTER}")


def _point(spark: SparkSession, path: str, version: str) -> None:
    """Let the table's pointer name a version; the new pointer replaces the old one by one rename."""
    files = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    new, pointer = files.Path(f"{path}/{_POINTER}.{version}"), files.Path(f"{path}/{_POINTER}")
    store = new.getFileSystem(conf)
    _put_text(spark, f"{path}/{_POINTER}.{version}", version)
    overwrite = spark.sparkContext._gateway.new_array(files.Options.Rename, 1)
    overwrite[0] = files.Options.Rename.OVERWRITE
    qualified = [p.makeQualified(store.getUri(), store.getWorkingDirectory()) for p in (new, pointer)]
    files.FileContext.getFileContext(qualified[0].toUri(), conf).rename(*qualified, overwrite)


def current_path(spark: SparkSession, path: str) -> str:
    """Where the files of a table's current version are."""
    version = _version(spark, path)
    return path if version is None else f"{path}/{version}"


def read_table(spark: SparkSession, root: str, layer: str, table: str) -> DataFrame:
    return spark.read.parquet(current_path(spark, table_path(root, layer, table)))


def table_counts_at(spark: SparkSession, path: str) -> TableCounts | None:
    """The counts kept with a table's current version; None where none were taken."""
    kept = _text_of(spark, f"{current_path(spark, path)}/{_COUNTS}")
    return None if kept is None else TableCounts(**json.loads(kept))


def stored_counts(spark: SparkSession, root: str, layer: str, names: Iterable[str]) -> dict[str, TableCounts]:
    """The kept counts of a layer's tables, by table; a table without counts is not among them."""
    found = {name: table_counts_at(spark, table_path(root, layer, name)) for name in names}
    return {name: counts for name, counts in found.items() if counts is not None}


class Layer(Mapping[str, DataFrame]):
    """The tables of a written layer, opened when they are first asked for."""

    def __init__(self, spark: SparkSession, root: str, layer: str, names: list[str]):
        self._spark, self._root, self._layer, self._names = spark, root, layer, names
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            self._open[name] = read_table(self._spark, self._root, self._layer, name)
        return self._open[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _counting(frame: DataFrame, taken: Observation, columns: Sequence[str]) -> DataFrame:
    """The frame, whose rows and the columns' values are counted where an action makes them."""
    values = [F.count(frame[f"`{name}`"]).alias(f"c{i}") for i, name in enumerate(columns)]
    return frame.observe(taken, F.count(F.lit(1)).alias("rows"), *values)


def _taken(taken: Observation, columns: Sequence[str]) -> TableCounts:
    found = taken.get
    return TableCounts(found["rows"], {name: found["rows"] - found[f"c{i}"] for i, name in enumerate(columns)})


def replace_table(
    frame: DataFrame, path: str, partition_by: str | None = None, nulls_of: Sequence[str] = ()
) -> TableCounts:
    """Write a new version of a table beside the old one; the last step switches the table's pointer to it.

    Rows, and the NULLs of the columns ``nulls_of``, are counted by the tasks that write them; the counts
    are kept in the version and returned. Whatever fails before leaves the old version in place and nothing of the new one. The version
    before the new one stays for those who have it open, until the next write; older ones go. A table
    has one writer at a time.
    """
    spark = frame.sparkSession
    version = f"v-{uuid.uuid4().hex}"
    before = _version(spark, path)
    taken = Observation()
    writer = _counting(frame, taken, nulls_of).write.option("compression", COMPRESSION)
    try:
        with shuffles_freed(spark):
            (writer if partition_by is None else writer.partitionBy(partition_by)).parquet(f"{path}/{version}")
        counts = _taken(taken, nulls_of)
        _put_text(spark, f"{path}/{version}/{_COUNTS}", json.dumps({"rows": counts.rows, "nulls": counts.nulls}))
        _point(spark, path, version)
    except BaseException:
        discard(spark, f"{path}/{version}")
        raise
    make = spark._jvm.org.apache.hadoop.fs.Path
    store = make(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for entry in store.listStatus(make(path)):
        if entry.getPath().getName() not in (version, before, _POINTER):
            store.delete(entry.getPath(), True)
    return counts


def write_table(
    frame: DataFrame, root: str, layer: str, table: str, partition_by: str | None = None, rebalanced: bool = False
) -> DataFrame:
    """Replace a table and return it as read back; if writing fails the old table stays.

    A partitioned table is rebalanced by its partition column first: few large files per
    partition value, while values with much data are split over several tasks. ``rebalanced`` says that
    the frame already is.
    """
    path = table_path(root, layer, table)
    keep = partition_by is None or rebalanced
    replace_table(frame if keep else frame.hint("rebalance", partition_by), path, partition_by)
    return read_table(frame.sparkSession, root, layer, table).select(*[f"`{name}`" for name in frame.columns])


def ordered_report(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A written report in its fixed reading order."""
    if name not in REPORT_ORDER:
        raise KeyError(f"unknown report {name}; have {', '.join(REPORT_ORDER)}")
    return in_report_order(name, read_table(spark, root, "analytics", name))
