import datetime
import glob
import math
import os

import duckdb
import pytest

from tidemill import catalogue

DATA = os.environ.get("TIDEMILL_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, list | tuple):
        return str([plain(x) for x in v])
    return str(v)


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(catalogue.oracles()))
def test_query_equals_oracle(spark, tables, name):
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    df = catalogue.queries()[name](spark, DATA)
    done = tables.execute(catalogue.oracles()[name])
    columns = [x[0] for x in done.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, done.fetchall())
