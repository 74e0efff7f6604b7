"""Every named query of the reference's operators agrees with its SQL on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from loquarium import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


def plain(v):
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert rows == sorted(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in cursor.fetchall())
