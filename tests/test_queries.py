"""Every registered query against its SQL on the driver's smallest tables, where they are there."""

import math
import os
from pathlib import Path

import pytest

from loomline.plans.queries import ORACLES, QUERIES

DATA = Path(os.environ.get("LOOMLINE_TESTDATA", "/root/testdata/sf0.001"))
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return None
    if isinstance(x, float):
        return round(x, 6)
    return tuple(map(plain, x)) if isinstance(x, list | tuple) else x


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    rows = df.collect()
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert table(df.columns, rows) == table(want.columns, want.fetchall())
    else:
        assert rows
