"""Every registered query against its DuckDB oracle on the smallest tables."""
import duckdb
import pytest

import __spark_entry__ as E
from compare import same
from conftest import SF_SMALL
from strata.plans.registry import ORACLE, QUERIES, load_catalog
from strata.sources.tables import TABLES

load_catalog()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert sorted(set(QUERIES) - set(ORACLE)) == []


def test_entry_lists_every_registered_query():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(ORACLE[name]).df()
    ok, why = same(got, want)
    assert ok, why


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 4
    assert df.count() >= 0
