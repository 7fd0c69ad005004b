"""The queries that SQL can express, against DuckDB."""

import pytest

from tallycast.llm import queries as Q
from tests.oracle_compare import compare


@pytest.mark.parametrize("key", sorted(Q.oracle_sql()))
def test_query_matches_sql(spark, key):
    (res,) = compare(spark, "/root/testdata/sf0.01", [key])
    assert res["ok"], res


def test_one_query_for_each_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in Q.queries()) == list(range(1, 14))
