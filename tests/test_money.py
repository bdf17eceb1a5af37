from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from marginfold.functions.money import half_up, half_up_wide, money, share_of


def exact(num, den):
    """Rounded half away from zero."""
    if den == 0:
        return None
    q = Fraction(num, den)
    sign = -1 if q < 0 else 1
    return sign * int((abs(q) + Fraction(1, 2)))


amounts = st.integers(-(10**12) + 1, 10**12 - 1)
small = st.integers(-1000, 1000)
wholes = st.integers(-(10**14), 10**14) | small


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(amounts | small, amounts | small), min_size=40, max_size=80))
def test_quotients_round_half_away_from_zero(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for r in df.select("n", "d", F.expr(half_up("n", "d")).alias("q"), F.expr(half_up_wide("n", 100, "d")).alias("w")).collect():
        assert r.q == exact(r.n, r.d)
        assert r.w == exact(100 * r.n, r.d)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(amounts | small, amounts | small, wholes), min_size=40, max_size=80))
def test_shares_are_exact_at_any_size(spark, triples):
    df = spark.createDataFrame(triples, "c bigint, p bigint, w bigint")
    # A share must fit; a line is not far larger than its order.
    df = df.filter("w = 0 OR abs(cast(c as decimal(19,0)) * p / w) < 1000000000000")
    columns = {"one": F.expr(share_of("c", "p", "w")), "many": F.expr(share_of("c * 1000000BD + 1", "p", "w", 1_000_000))}
    for r in df.select("*", *[v.alias(k) for k, v in columns.items()]).collect():
        assert r.one == exact(r.c * r.p, r.w)
        assert r.many == exact((r.c * 10**6 + 1) * r.p, r.w * 10**6)


def test_shares_near_the_largest_totals(spark):
    """A quotient rounded at 13 places and then again comes out a cent too high here."""
    df = spark.createDataFrame([(991_055_186_678, 767_678_251_418, 90_623_347_347_957)], "c bigint, p bigint, w bigint")
    assert df.select(F.expr(share_of("c", "p", "w"))).first()[0] == 8_395_314_618


def test_money_is_the_exact_decimal(spark):
    values = [0, 1, -1, 99, -12345, 999_999_999_999]
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    got = [r.m for r in df.select(money("v").alias("m")).collect()]
    assert got == [(Decimal(v) / 100).quantize(Decimal("0.01"), ROUND_HALF_UP) for v in values]
