"""Pair statistics: correlation status rules, exact re-check, edge rows."""

import pytest

from likeness.operators import pairs


def _inter(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item long, rating double")


def _pairs(spark, rows):
    return spark.createDataFrame(rows, "id1 long, id2 long")


def _corr(spark, rows, prs):
    inter = _inter(spark, rows)
    p = _pairs(spark, prs)
    out = pairs.correlation(pairs.common_ratings(inter, p), p).collect()
    return {(r["id1"], r["id2"]): r for r in out}


def test_constant_side(spark):
    r = _corr(spark, [(1, 1, 3.0), (1, 2, 3.0), (2, 1, 1.0), (2, 2, 5.0)], [(1, 2)])[(1, 2)]
    assert r["status"] == "constant_user1"
    assert r["corr"] is None
    assert r["constant_items"] == "1,2"


def test_one_common_item(spark):
    r = _corr(spark, [(1, 1, 4.0), (2, 1, 2.0), (2, 2, 3.0)], [(1, 2)])[(1, 2)]
    assert r["status"] == "too_few" and r["n_common"] == 1 and r["corr"] is None


def test_perfect_but_not_identical(spark):
    r = _corr(spark, [(1, 1, 1.0), (1, 2, 2.0), (2, 1, 2.0), (2, 2, 4.0)], [(1, 2)])[(1, 2)]
    assert r["status"] == "ok"
    assert r["corr"] == pytest.approx(1.0)
    assert r["perfect_corr"] is True
    assert r["identical_ratings"] is False


def test_no_common_items_still_reported(spark):
    r = _corr(spark, [(1, 1, 1.0), (2, 2, 2.0)], [(1, 2)])[(1, 2)]
    assert r["status"] == "too_few" and r["n_common"] == 0


def test_pearson_value(spark):
    rows = [(1, 1, 1.0), (1, 2, 2.0), (1, 3, 4.0), (2, 1, 2.0), (2, 2, 1.0), (2, 3, 5.0)]
    r = _corr(spark, rows, [(1, 2)])[(1, 2)]
    import numpy as np

    assert r["corr"] == pytest.approx(np.corrcoef([1, 2, 4], [2, 1, 5])[0, 1], abs=1e-6)


def test_mean_correlation_null_when_nothing_qualifies(spark):
    inter = _inter(spark, [(1, 1, 3.0), (2, 1, 3.0)])
    p = _pairs(spark, [(1, 2)])
    corr = pairs.correlation(pairs.common_ratings(inter, p), p)
    out = pairs.mean_correlation(corr).collect()[0]
    assert out["n_pairs"] == 0 and out["avg_corr"] is None


def test_validation_unknown_and_empty(spark):
    inter = spark.createDataFrame([(1, 7), (1, 7), (1, 8)], "user_id long, item long")
    p = _pairs(spark, [(1, 999), (998, 999)])
    out = {(r["id1"], r["id2"]): r for r in pairs.validate(inter, p).collect()}
    a = out[(1, 999)]
    assert a["exists1"] and not a["exists2"] and a["n2"] == 0 and a["jaccard"] == 0.0
    assert a["n1"] == 2  # duplicate interaction counts once in the set
    b = out[(998, 999)]
    assert b["jaccard"] == 0.0 and b["same_set"] is True


def test_validation_exact_jaccard(spark):
    inter = spark.createDataFrame([(1, i) for i in range(10)] + [(2, i) for i in range(5, 15)],
                                  "user_id long, item long")
    r = pairs.validate(inter, _pairs(spark, [(1, 2)])).collect()[0]
    assert r["common"] == 5 and r["jaccard"] == pytest.approx(5 / 15, abs=1e-6)
    assert r["sample1"] == "0,1,2,3,4,5,6,7,8,9"


def test_noted_ratings_list_every_item(spark):
    rows = [(1, i, 3.0) for i in range(30)] + [(2, i, float(i)) for i in range(30)]
    rows += [(3, i, 2.0 * i) for i in range(30)] + [(4, i, float(i * i)) for i in range(30)]
    p = _pairs(spark, [(1, 2), (2, 3), (2, 4)])
    common = pairs.common_ratings(_inter(spark, rows), p)
    out = sorted(map(tuple, pairs.noted_ratings(common, pairs.correlation(common, p)).collect()))
    assert out == ([(1, 2, "constant_user1", False, i, 3.0, float(i)) for i in range(30)]
                   + [(2, 3, "ok", True, i, float(i), 2.0 * i) for i in range(30)])
