"""Per-entity split: sizes, determinism, skew-safe rank equals a plain window."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from likeness.operators import split


def _interactions(spark, sizes):
    rows = [(u, u * 1000 + i, 1.0) for u, n in sizes.items() for i in range(n)]
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def test_split_sizes(spark):
    sizes = {1: 4, 2: 5, 3: 9, 4: 10, 5: 15}
    out = split.assign_split(_interactions(spark, sizes))
    got = {}
    for r in out.groupBy("user_id", "split").count().collect():
        got.setdefault(r["user_id"], {})[r["split"]] = r["count"]
    assert 1 not in got
    expect = {2: (4, 0, 1), 3: (7, 1, 1), 4: (8, 1, 1), 5: (12, 1, 2)}
    for u, (tr, va, te) in expect.items():
        g = got[u]
        assert (g.get("train", 0), g.get("val", 0), g.get("test", 0)) == (tr, va, te)


def test_split_is_complete_disjoint_and_deterministic(spark):
    df = _interactions(spark, {u: 5 + u for u in range(1, 30)})
    a = split.assign_split(df)
    b = split.assign_split(df.repartition(7), heavy_rows=3)
    assert a.count() == df.count()
    assert a.select("user_id", "item_id").distinct().count() == df.count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_bucketed_rank_equals_window_rank(spark):
    # one very active entity next to small ones
    df = _interactions(spark, {1: 5000, 2: 7, 3: 12})
    key = split.shuffle_key(F.col("user_id"), F.col("item_id"))
    ours = split.ranked_within(df, "user_id", key, "item_id", heavy_rows=90).select(
        "user_id", "item_id", "rn")
    w = Window.partitionBy("user_id").orderBy(key, "item_id")
    plain = df.withColumn("rn", F.row_number().over(w)).select("user_id", "item_id", "rn")
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_tags_flag(spark):
    df = _interactions(spark, {1: 5})
    tags = spark.createDataFrame([(1, 1000), (1, 1000), (1, 99)], "user_id long, item_id long")
    out = split.with_tags(split.assign_split(df), tags)
    flags = {r["item_id"]: r["tagged"] for r in out.collect()}
    assert flags[1000] == 1 and sum(flags.values()) == 1


def test_slices_of_a_heavy_entity_give_the_same_split(spark):
    df = _interactions(spark, {1: 300, 2: 6})
    a = split.assign_split(df, heavy_rows=7)
    b = split.assign_split(df)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_a_heavy_entity_is_dealt_over_tasks(spark):
    df = _interactions(spark, {1: 4000, 2: 9})
    plan = split.ranked_within(df, "user_id", split.shuffle_key(F.col("user_id"), F.col("item_id")), "item_id",
                               heavy_rows=100)
    sizes = [r["count"] for r in plan.groupBy("user_id", (F.col("rn") / 100).cast("int")).count().collect()]
    assert max(sizes) <= 100 and plan.where("user_id = 1").agg(F.countDistinct("rn"), F.max("rn"), F.min("n")).first()[:] == (
        4000, 4000, 4000)
