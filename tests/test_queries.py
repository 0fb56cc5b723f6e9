import math
import os

import duckdb
import pytest

from loomsift.plans.catalogue import ORACLE_SQL, QUERIES

from .conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SMALL):
        con.execute(f"create view {t.split('.')[0]} as select * from '{SMALL}/{t}'")
    return con


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return float(v) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    key = lambda row: tuple((v is None, str(v)) for v in row)
    got = sorted((tuple(value(r[c]) for c in cols) for r in df.collect()), key=key)
    if name not in ORACLE_SQL:
        assert got
        return
    rel = duck.sql(ORACLE_SQL[name])
    names = list(rel.columns)
    assert sorted(names) == cols
    want = sorted((tuple(value(r[names.index(c)]) for c in cols) for r in rel.fetchall()), key=key)
    assert got == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200
    assert set(e.oracle_sql()) <= set(e.queries())
