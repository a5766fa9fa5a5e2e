"""Every query of the reference's operators against its SQL on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from quillspark import registry

QUERIES, ORACLE = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(sf):
        c.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf}/{f}'")
    return c


def rows(frame: pd.DataFrame) -> list:
    def plain(v):
        if isinstance(v, float):
            return None if v != v else repr(round(v, 9))
        return None if v is None or v is pd.NaT or v is pd.NA else str(v)

    names = sorted(frame.columns)
    return sorted((tuple(plain(v) for v in r) for r in frame[names].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf, db):
    got = QUERIES[name](spark, sf).toPandas()
    if name not in ORACLE:
        assert len(got)
        return
    want = db.execute(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_has_every_query():
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
