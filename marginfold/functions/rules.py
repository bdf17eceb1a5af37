"""Turning one-row aggregates into PASS/FAIL rows."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F


def pass_fail(ok: Column, fail: str = "FAIL", passed: str = "PASS") -> Column:
    """NULL counts as a failure."""
    return F.when(ok, F.lit(passed)).otherwise(F.lit(fail))


def stack_rows(one_row: DataFrame, rows: list[dict[str, Column]]) -> DataFrame:
    """Unfold a one-row frame into one row per dict of named expressions."""
    structs = [F.struct(*[c.alias(name) for name, c in row.items()]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def rule_rows(table: DataFrame, rules: Mapping[str, Column], name: str) -> DataFrame:
    """Count the violations of every rule in one pass over the table."""
    keys = [f"r{i}" for i in range(len(rules))]
    counted = table.agg(*[F.count_if(bad).alias(k) for k, bad in zip(keys, rules.values())])
    return with_status(counted, list(rules), keys, name)


def with_status(counted: DataFrame, labels: list[str], keys: list[str], name: str) -> DataFrame:
    stacked = stack_rows(
        counted,
        [{name: F.lit(label), "violations": F.col(k)} for label, k in zip(labels, keys)],
    )
    return stacked.withColumn("status", pass_fail(F.col("violations") == 0))
