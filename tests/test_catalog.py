"""Every registered query against its DuckDB SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from asofmill import catalog
from asofmill.plans.surrogate import ALSO, TABLES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in (*TABLES, *ALSO):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(records, names, columns):
    place = [names.index(c) for c in columns]
    text = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else repr(v)
    return sorted(tuple(text(r[i]) for i in place) for r in records)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_matches_sql(spark, duck, name):
    got = catalog.QUERIES[name](spark, SF)
    want = duck.sql(catalog.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    columns = sorted(got.columns)
    assert rows([tuple(r) for r in got.collect()], got.columns, columns) == rows(want.fetchall(), want.columns, columns)
