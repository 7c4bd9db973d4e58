"""Seeded random pairs."""

from pyspark.sql import functions as F

from likeness.operators import sampling


def test_dense_index(spark):
    ids = spark.createDataFrame([(x,) for x in [40, 10, 30, 20]], "id long").repartition(3)
    got = sorted((r["idx"], r["id"]) for r in sampling.dense_index(ids).collect())
    assert got == [(0, 10), (1, 20), (2, 30), (3, 40)]


def test_fewer_pairs_than_asked(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    out = sampling.random_pairs(ids, trials=2, k=100)
    for t in (0, 1):
        pairs = {(r["id1"], r["id2"]) for r in out.where(F.col("trial") == t).collect()}
        assert pairs == {(1, 2), (1, 3), (2, 3)}


def test_pairs_distinct_ordered_and_seeded(spark):
    ids = spark.range(50).select(F.col("id"))
    a = sampling.random_pairs(ids, trials=3, k=20)
    rows = a.collect()
    assert len(rows) == 60
    assert all(r["id1"] < r["id2"] for r in rows)
    assert a.select("trial", "id1", "id2").distinct().count() == 60
    b = sampling.random_pairs(ids.repartition(5), trials=3, k=20)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, b.collect()))


def test_single_entity_gives_no_pairs(spark):
    ids = spark.createDataFrame([(1,)], "id long")
    assert sampling.random_pairs(ids).count() == 0


def test_small_population_follows_the_same_rule(spark):
    ids = spark.createDataFrame([(x,) for x in range(10, 25)], "id long")  # 105 pairs
    out = sampling.random_pairs(ids, trials=2, k=100)
    drawn = sampling.draws(spark, 15, trials=2, per_trial=2000).collect()
    for t in (0, 1):
        first = {}
        for r in sorted(r for r in drawn if r.trial == t):
            first.setdefault((10 + min(r.i1, r.i2), 10 + max(r.i1, r.i2)), r.draw)
        want = sorted((d, *p) for p, d in first.items())[:100]
        assert sorted((r.draw, r.id1, r.id2) for r in out.where(F.col("trial") == t).collect()) == want
    assert sampling.random_pairs(ids, trials=1, k=200, per_trial=10).count() == 105


def test_dense_index_takes_no_python_rows(spark):
    plan = sampling.dense_index(spark.range(100).toDF("id"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ExistingRDD" not in plan


def test_short_trials_draw_again(spark):
    ids = spark.range(50).select(F.col("id"))          # 1,225 pairs
    few = sampling.random_pairs(ids, trials=3, k=100, per_trial=100)
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, sampling.random_pairs(ids, trials=3, k=100).collect()))
    assert few.count() == 300


def test_every_index_of_a_large_table_can_be_drawn(spark):
    n = 1 << 40
    rows = sampling.draws(spark, n, trials=2, per_trial=500).collect()
    for side in ("i1", "i2"):
        at = [r[side] for r in rows]
        assert all(0 <= i < n for i in at) and sum(i >= n // 2 for i in at) > 400
