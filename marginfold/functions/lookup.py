"""Constant lookups from parameter maps."""

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, functions as F


def lookup(key: Column, table: Mapping[str, Decimal], unit: Decimal, default: Decimal | None = None) -> Column:
    """Map ``key`` through a small parameter table, in whole numbers of ``unit``.

    NULL and unknown keys give ``default``. A value finer than the unit is an error.
    """

    def whole(value: Decimal | None) -> Column:
        if value is None:
            return F.lit(None).cast("bigint")
        units = value / unit
        if units != int(units):
            raise ValueError(f"{value} is not a multiple of {unit}")
        return F.lit(int(units)).cast("bigint")

    if not table:
        return whole(default)
    first, *rest = table.items()
    chain = F.when(key == first[0], whole(first[1]))
    for name, value in rest:
        chain = chain.when(key == name, whole(value))
    return chain.otherwise(whole(default))
