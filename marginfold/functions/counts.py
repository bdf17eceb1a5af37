"""Row and NULL counts of tables: those kept from when a table was written, else counted from its rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F


@dataclass(frozen=True)
class TableCounts:
    """Rows of a table, and of each column the rows where it is NULL."""

    rows: int
    nulls: Mapping[str, int] = field(default_factory=dict)


Known = Mapping[str, TableCounts]


def row_count(table: DataFrame, known: TableCounts | None, out: str) -> DataFrame:
    """One row with the number of rows of a table; the table is not read where that is known."""
    if known is None:
        return table.agg(F.count(F.lit(1)).alias(out))
    return table.sparkSession.range(1).select(F.lit(known.rows).cast("bigint").alias(out))


def null_counts(table: DataFrame, known: TableCounts | None, columns: Sequence[str]) -> DataFrame:
    """One row with the NULLs of each column, under its name; the table is not read where they are known."""
    if known is None or not set(columns) <= set(known.nulls):
        return table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return table.sparkSession.range(1).select(*[F.lit(known.nulls[c]).cast("bigint").alias(c) for c in columns])
