"""Every registered query that has SQL gives the same rows in DuckDB over the same tables."""

import datetime
import decimal
import glob
import os

import pytest

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

from foliospark.plans import catalog  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f if os.path.isfile(f) else f + '/*.parquet'}')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, list | tuple):
        return tuple(map(plain, v))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return v


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_same_as_sql(spark, con, name):
    df = catalog.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    ours = sorted(repr(tuple(plain(r[c]) for c in names)) for r in df.collect())
    found = con.sql(catalog.ORACLE[name])
    assert sorted(found.columns) == names
    at = [found.columns.index(c) for c in names]
    theirs = sorted(repr(tuple(plain(r[i]) for i in at)) for r in found.fetchall())
    assert ours == theirs

