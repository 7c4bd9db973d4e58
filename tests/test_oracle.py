"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01), plus the flagship entry smoke check."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from likeness.plans.registry import QUERIES as LIBRARY
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
# the library's own queries: the optional ones have tests of their own
QUERIES = {name: fn for name, fn in entry.queries().items() if name in LIBRARY}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in LIBRARY}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_oracle_or_is_a_fit():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only == {"als_explicit", "als_implicit", "als_grid"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["min_ratings", "rank", "id1", "id2", "estimated_jaccard", "n1", "n2"]
    assert df.count() >= 0


def test_random_pairs_small_population_matches_oracle(spark, tmp_path):
    import pandas as pd

    pd.DataFrame({"doc_id": list(range(1, 16)),
                  "text": [f"w{i} x y" for i in range(15)],
                  "lang": ["en"] * 15, "source": ["s"] * 15, "n_chars": [5] * 15}).to_parquet(
        tmp_path / "documents.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet')")
    for name in ("random_pairs", "random_pair_baseline"):
        df = QUERIES[name](spark, str(tmp_path))
        res = c.execute(SQL[name])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        rows = [tuple(r) for r in df.collect()]
        assert len(rows) == len(orows) and len(rows) > 0
        assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


PLAN_SMELLS = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in
                                        ("als_explicit", "als_implicit", "als_grid")))
def test_no_cartesian_or_row_udf_in_plan(spark, name):
    # ALS's own top-k is Spark ML's blocked cross product and is excluded
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [s for s in PLAN_SMELLS if s in plan]
