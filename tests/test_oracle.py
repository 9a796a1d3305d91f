"""Every registered query against its DuckDB oracle (sf0.001, fast)."""
import hashlib

import duckdb
import pytest

from sigshape.plans.oracle import ORACLE
from sigshape.plans.registry import QUERIES
from conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.md5(repr(tuple(r[i] for i in order)).encode()).hexdigest() for r in rows)


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


SPARK_TO_DUCKDB = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER",
                   "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(ORACLE[name])
    oracle_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: SPARK_TO_DUCKDB.get(t, t) for c, t in df.dtypes} == oracle_types   # names and types
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.columns == ["topic", "key", "value"]
    assert df.count() > 0
    assert set(e.queries()) >= set(QUERIES) and set(e.oracle_sql()) >= set(ORACLE)
    assert set(e.oracle_sql()) <= set(e.queries())
