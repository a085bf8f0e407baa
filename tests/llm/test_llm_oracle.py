"""The training-data queries with SQL, against DuckDB on whole tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from barloom.llm import queries

SF = "/root/testdata/sf0.001"


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df, relation = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLE_SQL[name])
    order = [relation.columns.index(c) for c in df.columns]
    want = Counter(tuple(plain(r[i]) for i in order) for r in relation.fetchall())
    assert Counter(tuple(plain(v) for v in r) for r in df.collect()) == want and want
