"""Registered queries that have SQL, against it, on small whole tables."""

import pytest

from compare import compare_results, connect
from marginfold.llm.queries import oracle_sql, queries


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, name, folder):
    assert compare_results(queries()[name](spark, folder), connect(folder), oracle_sql()[name]) is None
