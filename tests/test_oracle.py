"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import pytest

from compare import compare, connect
from marginfold.verify.oracle import oracle_sql
from marginfold.verify.queries import queries

FOLDER = "/root/testdata/sf0.001"
# Covered by the queries they order or repeat.
REPEATED = {n for n in queries() if n.startswith("b52_")} | {"b40_overall_verdict", "b42_table_counts"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(set(queries()) - REPEATED))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, FOLDER) is None
