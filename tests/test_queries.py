"""Every query with SQL against DuckDB on the smallest tables."""

import pytest

from tessera.plans import publishing  # noqa: F401  its queries join the registry
from tessera.plans.queries import QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _cell(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def con(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_same_rows(spark, sf_dir, con, name):
    fn, sql = QUERIES[name]
    df = fn(spark, sf_dir)
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    assert sorted(cols) == sorted(df.columns)
    want = sorted(tuple(_cell(v) for v in r) for r in cur.fetchall())
    got = sorted(tuple(_cell(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    assert got == want


def test_entry():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(QUERIES) >= 80
