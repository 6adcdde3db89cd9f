"""Every registered query of the climate side against its SQL, on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from rainfold.plans import catalog

SF = os.environ.get("RAINFOLD_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-4)
    return a == b


def key(row):
    return tuple((x is None, f"{x:.2f}" if isinstance(x, float) else str(x)) for x in row)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=key)
    if name not in catalog.ORACLE_SQL:
        assert columns and len(set(df.columns)) == len(df.columns)
        return
    rel = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=key)
    assert len(got) == len(want)
    if got != want:
        assert all(same(x, y) for g, w in zip(got, want) for x, y in zip(g, w))


def test_entry_point_names():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
