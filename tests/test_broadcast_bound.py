from likeness.operators import als, personal, ranking
from likeness.session import bounded_broadcast


def test_a_side_beyond_the_bound_is_not_broadcast(spark):
    small, rows = spark.range(500), spark.range(2000)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan(rows.join(bounded_broadcast(small, 100), "id"))
    assert "BroadcastHashJoin" in plan(rows.join(bounded_broadcast(small, 500), "id"))


def test_groups_of_many_items_meet_in_a_shuffle_join(spark, monkeypatch):
    train = spark.createDataFrame([(u, i, 1.0 + i % 3) for u in range(4) for i in range(9)], "user_id long, item_id long, rating double")
    groups = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(9)], "item_id long, grp string")
    want = sorted(map(tuple, personal.personal_lists(train, groups, min_ratings=1).collect()))
    monkeypatch.setattr(personal, "GROUP_ROWS", 3)
    plan = personal.favourites(train, groups, 1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, personal.personal_lists(train, groups, min_ratings=1).collect())) == want


def test_lists_that_compress_well_are_not_broadcast_by_their_file(spark, tmp_path):
    """The lists of 20,000 users in a file of a few KB, far below the size that Spark broadcasts."""
    rows = spark.range(20_000).selectExpr("id as user_id", "explode(sequence(1L, 20L)) as rank")
    rows.selectExpr("user_id", "rank", "rank * 7 as item").write.parquet(str(tmp_path / "lists"))
    lists = spark.read.parquet(str(tmp_path / "lists"))
    truth = spark.createDataFrame([("val", 1, 7), ("val", 2, 1), ("test", 3, 14), ("test", 90_000, 7)],
                                  "split string, user_id long, item long")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    mean = ranking.mean_personal(lists, truth, 20, ["split"])
    assert "BroadcastHashJoin" not in plan(mean)
    inner = ranking.inner_personal(lists, truth, 20, ["split"])
    assert not [x for x in plan(inner).splitlines() if "BroadcastHashJoin" in x and "user_id" in x]
    assert "BroadcastHashJoin" not in plan(als.evaluate(lists.withColumnRenamed("user_id", "user"), truth, 20))
    got = {r.split: tuple(r)[1:4] for r in inner.collect()}
    assert got == {"val": (2, 0, 19_998), "test": (1, 1, 19_999)}
    assert {r.split: r.n_users for r in mean.collect()} == {"val": 2, "test": 2}
