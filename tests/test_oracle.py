"""Registered queries against their DuckDB oracle SQL on the smallest scale."""
import duckdb
import pytest

import __spark_entry__ as E
from quire.plans import catalog
from tests.conftest import SF_SMALL

TABLES = ["documents", "benchmark", "pages", "embeddings", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def canon(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(catalog.QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = canon(df.select(cols).collect())
    o = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in o.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = canon([tuple(r[i] for i in idx) for r in o.fetchall()])
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["collection", "document", "section_title", "importance_rank", "page_number"]
