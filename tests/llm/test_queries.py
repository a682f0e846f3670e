"""Registered queries against their DuckDB SQL on the smallest tables."""

import duckdb
import pytest

from asofmill.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "labels", "benchmark", "embeddings"):
        duck.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    want = duck.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    place = [want.columns.index(c) for c in columns]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.collect()) == sorted(repr(tuple(r[i] for i in place)) for r in want.fetchall())
