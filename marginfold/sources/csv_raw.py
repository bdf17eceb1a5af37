"""CSV files to raw all-text tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from marginfold.params import DEFAULT_PARAMS
from marginfold.schemas import RAW_COLUMNS, raw_schema
from marginfold.sources.layers import path_exists, replace_table, table_path


# A line whose quoted fields all end on it. Possessive, as a group repeated by backtracking would recurse.
_FIELD = r'(?:"(?:[^"]++|"")*+"|[^",]*+)'
_WHOLE_RECORDS = f"^{_FIELD}(?:,{_FIELD})*+$"


def split_by_lines(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """The files below ``path``: those whose records all end with their lines, and those where one may not.

    A quoted field with a line break leaves a line that ends inside quotes, so a file without such a line
    can be read in splits, line by line. The text is read for this once, in splits itself.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").rlike(_WHOLE_RECORDS).alias("whole"))
    files = lines.groupBy("file").agg(F.bool_and("whole").alias("whole")).orderBy("file").collect()
    return [row["file"] for row in files if row["whole"]], [row["file"] for row in files if not row["whole"]]


def read_csv(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A source file, or a folder of files, as text columns, matched to the table by header name.

    Empty fields become NULL; absent columns become NULL; a column the table lacks is an error. Quoted
    fields may hold line breaks: files that have any are read as a whole each, all others in splits.
    """
    by_line, as_whole = split_by_lines(spark, path)

    def read(files: list[str] | str, multi_line: bool) -> DataFrame:
        # A declared schema would match by position, so the names come from the header.
        found = (
            spark.read.option("header", True)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("nullValue", "")
            .option("mode", "FAILFAST")
            .csv(files)
        )
        unknown = sorted(set(found.columns) - set(RAW_COLUMNS[table]))
        if unknown:
            raise ValueError(f"{path}: columns not in raw.{table}: {', '.join(unknown)}")
        return found.select(
            *[F.col(c) if c in found.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS[table]]
        )

    frames = [read(files, multi_line) for files, multi_line in ((by_line, False), (as_whole, True)) if files]
    return reduce(DataFrame.union, frames) if frames else read(path, True)


def _load(spark: SparkSession, path: str, table: str, target: str) -> tuple[str, int, str | None]:
    try:
        frame = read_csv(spark, path, table)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return "MISSING", 0, None
        return "ERROR", 0, str(exc)
    except Exception as exc:  # one bad file must not stop the others
        return "ERROR", 0, str(exc)
    try:
        return "OK", replace_table(frame, target, nulls_of=frame.columns).rows, None
    except Exception as exc:
        return "ERROR", 0, str(exc)


def load_raw(
    spark: SparkSession,
    folder: str,
    target: str,
    csv_files: Mapping[str, str] = DEFAULT_PARAMS.csv_files,
) -> DataFrame:
    """Refresh every raw table from its CSV file; returns one status row per table.

    A missing or broken file leaves its table empty and does not stop the others. Where the folder
    itself is missing nothing is touched and FileNotFoundError is raised.
    """
    if not path_exists(spark, folder):
        raise FileNotFoundError(folder)
    results = []
    for table, filename in csv_files.items():
        path = table_path(target, "raw", table)
        status, rows, error = _load(spark, f"{folder}/{filename}", table, path)
        if status != "OK":
            replace_table(spark.createDataFrame([], raw_schema(table)), path, nulls_of=RAW_COLUMNS[table])
        results.append((table, filename, status, rows, error))
    return spark.createDataFrame(results, "table_name string, file string, status string, row_count bigint, error string")
