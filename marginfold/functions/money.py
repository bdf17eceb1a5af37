"""Cent-exact money arithmetic as SQL expressions.

Tables hold decimals; sums and quotients run on whole cents as BIGINT. That is exact, several
times cheaper than decimal arithmetic, and keeps shuffled rows small. ``cents`` enters this
form and ``money`` leaves it; the quotients round half away from zero and give NULL for a zero
divisor. Under ANSI mode an amount beyond BIGINT raises, it never wraps.
"""

from pyspark.sql import Column, functions as F, types as T

from marginfold.schemas import MONEY, PERCENT, TOTAL


def cents(amount: str) -> str:
    """A two-place decimal as a whole number of cents."""
    return f"cast({amount} * 100 as bigint)"


def money(whole: str, dtype: T.DecimalType = MONEY) -> Column:
    """Whole cents, or hundredths of a percent, as a two-place decimal."""
    digits = f"decimal({dtype.precision},0)"
    return F.expr(f"cast(cast({whole} as {digits}) * 0.01BD as {dtype.simpleString()})")


def half_up(num: str, den: str) -> str:
    """Rounded BIGINT quotient; ``num`` plus half of ``den`` must fit."""
    n, d = f"({num})", f"nullif({den}, 0)"
    return f"(({n} + if({n} < 0, -1, 1) * (abs({den}) div 2)) div {d})"


def half_up_wide(num: str, factor: str | int, den: str) -> str:
    """Rounded ``num * factor / den`` of BIGINTs with a 38-digit product."""
    n = f"(cast({num} as decimal(19,0)) * cast({factor} as decimal(18,0)))"
    return f"(({n} + if({n} < 0, -1, 1) * (abs({den}) div 2)) div nullif(cast({den} as decimal(19,0)), 0))"


def share_of(cost: str, part: str, whole: str, units: int = 1, half: str | None = None) -> str:
    """``cost * part / whole`` in whole cents, rounded once; NULL for a whole of 0.

    ``part`` and ``whole`` are cents, ``cost`` is in ``units`` to the cent, 1 or an even number. The
    product of up to 20 and 18 digits is exact. ``half`` names ``abs(whole) div 2`` where it is at hand;
    ``whole`` then is NULL and never 0, which spares generated code.
    """
    n = f"(cast({cost} as decimal(20,0)) * cast({part} as decimal(18,0)))"
    middle = (half or f"abs({whole}) div 2") if units == 1 else f"abs({whole}) * {units // 2}BD"
    divisor = f"cast({whole} as decimal(19,0))" + (f" * {units}BD" if units != 1 else "")
    return f"(({n} + if({n} < 0, -1, 1) * ({middle})) div {f'({divisor})' if half else f'nullif({divisor}, 0BD)'})"


def percent(part: str, whole: str) -> Column:
    """Percentage of two whole numbers of any size, 2 places."""
    return money(half_up_wide(part, 10_000, whole), PERCENT)


def ratio(num: str, den: str, dtype: T.DecimalType = TOTAL) -> Column:
    """Quotient of two whole numbers of cents, 2 places."""
    return money(half_up_wide(num, 100, den), dtype)


def per_unit(amount: str, count: str, dtype: T.DecimalType = TOTAL) -> Column:
    """Cents, or hundredths of a percent, divided by a count: an average to 2 places."""
    return money(half_up_wide(amount, 1, count), dtype)


def total_cents(amount: str) -> Column:
    """Sum of a money column in whole cents."""
    return F.expr(f"sum({cents(amount)})")
