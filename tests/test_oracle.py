"""Every registered query against its SQL oracle (DuckDB) on the sf0.001 tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from spanload.plans import registry
from spanload.sources.tables import TABLES
from tests.conftest import SF001

# Sampling is only deterministic when every row is in the sample, and the
# gates of the count/time splits need 1,000 rows: these hold at sf0.001 too.
registry.load_all()
NAMES = sorted(registry.ORACLE_SQL)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
    assert set(registry.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF001)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == _rows(cols, res.fetchall())
    assert not any(isinstance(x, float) and math.isnan(x) for r in got for x in r)


def test_entry_smoke(spark):
    rows = E.entry(spark).orderBy("chunk").collect()
    assert [r["rows"] for r in rows] == [99] + [100] * 8 + [101]
