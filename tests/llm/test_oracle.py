"""The queries of this subpackage that SQL expresses, against DuckDB."""

import os

import duckdb
import pytest

from likeness.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, digest


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(p := os.path.join(SF_SMALL, f"{t}.parquet")):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    found = con.execute(ORACLE_SQL[name])
    columns, want = [d[0] for d in found.description], found.fetchall()
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(columns) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(columns, want)[0]
