"""Every registered query against its DuckDB oracle (the driver's correctness gate) at sf0.001."""

import pytest

import __spark_entry__ as E
from claimlens.plans.queries import all_queries
from compare import compare, duck_connect
from conftest import SF_SMALL

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    ok, msg = compare(got, want)
    assert ok, msg


def test_every_query_has_oracle_or_is_listed():
    no_oracle = set(all_queries()) - set(SQL)
    assert no_oracle <= set(E.ROWS_ONLY), no_oracle


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [r.level for r in rows] == ["line", "claim", "encounter"]
