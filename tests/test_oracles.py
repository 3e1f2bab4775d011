"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from tessella.plans import accounts, ingestion, registry, serving, stores, telemetry  # noqa: F401
from tessella.streaming import hosts, ingest  # noqa: F401

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 5)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return str(v) if hasattr(v, "isoformat") else int(v) if isinstance(v, bool) else v


def sort_key(row):
    return tuple((x is None, str(type(x)), str(x)) for x in row)


def same(df, cursor):
    columns = sorted(df.columns)
    names = [c[0] for c in cursor.description]
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[k]) for k in at) for r in cursor.fetchall()), key=sort_key)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=sort_key)
    assert got == want


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(spark, duck, name):
    same(registry.QUERIES[name](spark, SF), duck.execute(registry.ORACLES[name]))


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0
