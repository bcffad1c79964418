"""Every registered query against its SQL, on the smallest tables."""

import os
from decimal import Decimal

import duckdb
import pytest
from changeflow.plans.oracles import ORACLE_SQL
from changeflow.plans.queries import QUERIES, flagship

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return format(v.normalize(), "f") if isinstance(v, Decimal) else str(v)


def test_all_have_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    done = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == columns
    assert got == sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in done.fetchall())


def test_flagship(spark):
    rows = flagship(spark, SF)
    assert rows.count() == rows.select("user_id").distinct().count() > 0
