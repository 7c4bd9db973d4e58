"""Snapshot facts of the reports and the expected values of FIXTURES.md at sf0.01."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.conftest import SF_ORACLE

Q = entry.queries()


def test_top_pair_report_invariants(spark):
    rows = Q["top_pairs_by_threshold"](spark, SF_ORACLE).collect()
    by_t = {}
    for r in rows:
        by_t.setdefault(r["min_ratings"], []).append(r)
    assert sorted(by_t) == [5, 10, 20, 30, 40, 50]
    for t, rs in by_t.items():
        rs.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rs] == list(range(1, len(rs) + 1))
        for r in rs:
            assert r["id1"] < r["id2"]
            assert r["n1"] > t and r["n2"] > t
            assert r["estimated_jaccard"] * 128 == round(r["estimated_jaccard"] * 128)
        keys = [(-r["estimated_jaccard"], r["id1"], r["id2"]) for r in rs]
        assert keys == sorted(keys)


def test_fixture_facts_sf001(spark):
    pp = {r["min_ratings"]: r["n_pairs"] for r in Q["pairs_per_threshold"](spark, SF_ORACLE).collect()}
    assert pp == {5: 173, 10: 171, 20: 171, 30: 169, 40: 169, 50: 164}
    top = Q["top_pairs_by_threshold"](spark, SF_ORACLE).where(F.col("rank") == 100)
    hundredth = {r["min_ratings"]: r["estimated_jaccard"] for r in top.collect()}
    assert hundredth == pytest.approx({5: 0.960938, 10: 0.953125, 20: 0.953125, 30: 0.953125,
                                       40: 0.953125, 50: 0.945313}, abs=1e-6)
    sizes = {r["split"]: (r["n_rows"], r["n_users"])
             for r in Q["split_summary"](spark, SF_ORACLE).collect()}
    assert sizes == {"train": (46914, 1498), "val": (5861, 1497), "test": (6610, 1498)}
    best = Q["best_beta_test"](spark, SF_ORACLE).collect()[0]
    assert best["best_beta"] == 267
    assert best["val_ndcg"] == pytest.approx(0.039897, abs=1e-6)
    assert best["test_ndcg"] == pytest.approx(0.045045, abs=1e-6)
    cold = {r["split"]: r["count"] for r in Q["cold_items"](spark, SF_ORACLE)
            .groupBy("split").count().collect()}
    assert cold == {"val": 6463, "test": 6776}
    sets = Q["signature_groups"](spark, SF_ORACLE)
    assert sets.count() == 1000
