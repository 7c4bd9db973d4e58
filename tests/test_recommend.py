import threading
import time

import numpy as np

from likeness.operators import als
from likeness.plans import recommend
from likeness.plans import recommend


def _lists(users, items, k):
    scores = users.astype(np.float64) @ items.T.astype(np.float64)
    return [sorted(range(len(items)), key=lambda j: (-row[j], -j))[:k] for row in scores]


def test_recommendations_are_the_best_of_all_items(spark, monkeypatch):
    """Whole numbers: the sums are exact and many scores are equal."""
    monkeypatch.setattr(als, "SLICE", 16)
    monkeypatch.setattr(als, "CHUNK", 32)
    rng = np.random.default_rng(2)
    users, items = rng.integers(-3, 4, (70, 4)).astype(np.float32), rng.integers(-3, 4, (300, 4)).astype(np.float32)

    class Model:
        userFactors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(users)], "id int, features array<float>")
        itemFactors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id int, features array<float>")

    wanted = spark.createDataFrame([(i,) for i in [*range(0, 70, 2), 0, 999]], "user int")
    for k in (5, 400):
        got = {}
        for r in als.recommend(Model, wanted, k).collect():
            got.setdefault(r.user, {})[r["rank"]] = r["item"]
        want = _lists(users, items, k)
        assert {u: [x[i + 1] for i in range(len(x))] for u, x in got.items()} == {u: want[u] for u in range(0, 70, 2)}


def _model(spark, users, items):
    class Model:
        userFactors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(users)], "id int, features array<float>")
        itemFactors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(items)], "id int, features array<float>")
    return Model


def test_items_are_not_written_for_every_block_of_users(spark, monkeypatch):
    monkeypatch.setattr(als, "USERS", 10)
    rng = np.random.default_rng(3)
    users, items = rng.integers(-3, 4, (70, 4)).astype(np.float32), rng.integers(-3, 4, (300, 4)).astype(np.float32)
    recs = als.recommend(_model(spark, users, items), spark.range(70).selectExpr("cast(id as int) as user"), 5)
    assert "Exchange" not in recs._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in recs.collect():
        got.setdefault(r.user, []).append((r["rank"], r.item, r.score))
    want = _lists(users, items, 5)
    assert len(got) == 70 and all([i for _, i, _ in sorted(got[u])] == want[u] for u in got)
    assert all(s == float(users[u] @ items[i]) for u in got for _, i, s in got[u])
    empty = als.recommend(_model(spark, users, items), spark.range(0).selectExpr("cast(id as int) as user"), 5)
    assert empty.count() == 0


def test_groups_of_chunks_hold_every_chunk_once_the_longest_first(spark):
    lengths = [float(x) for x in [9, 9, 9, 8, 7, 7, 6, *range(5, -15, -1)]]
    chunks = spark.createDataFrame([(v, bytes([i])) for i, v in enumerate(lengths)], "length double, ids binary")
    read = [r.length for r in als._longest_first(chunks).collect()]
    assert sorted(read) == sorted(lengths) and read[0] == 9.0
    assert als._longest_first(chunks.limit(1)).count() == 1 and als._longest_first(chunks.limit(0)).count() == 0


def test_a_fit_leaves_few_shuffle_files(spark):
    rows = [(u, i, float((u * i) % 5), 0) for u in range(40) for i in range(20) if (u + i) % 3]
    train = spark.createDataFrame(rows, "user int, item int, rating float, tagged int").cache()
    train.count()
    files = lambda: {b.name().split("_")[1] for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks())
        if b.name().startswith("shuffle_")}
    for mode in ("explicit", "implicit"):
        before = files()
        model = als.fit(train, als.AlsConfig(mode, rank=2, max_iter=5))
        for _ in range(50):                        # the cleaner works beside
            if len(left := files() - before) <= 8:
                break
            time.sleep(0.2)
        assert len(left) <= 8 and model.rank == 2, (mode, left)


def test_marked_lists_are_evaluated_without_being_written_whole(spark, monkeypatch):
    rng = np.random.default_rng(4)
    users, items = rng.normal(size=(60, 4)).astype(np.float32), rng.normal(size=(200, 4)).astype(np.float32)
    truth = spark.createDataFrame([(s, u, int(i)) for u in range(0, 80, 2) for s in ("val", "test")
                                   for i in rng.integers(0, 210, 12)] + [("val", 0, 2 ** 40), ("test", 2, 5), ("test", 2, 5)],
                                  "split string, user_id long, item long")
    wanted, model = spark.range(60).selectExpr("cast(id as int) as user"), _model(spark, users, items)
    whole, marked = als.recommend(model, wanted, 20), als.recommend(model, wanted, 20, truth)
    pairs = {(r.user_id, r.item) for r in truth.collect()}
    assert {(r.user, r.item) for r in marked.where("held").collect()} == {
        (r.user, r.item) for r in whole.collect() if (r.user, r.item) in pairs}
    assert sorted(map(tuple, marked.drop("held").collect())) == sorted(map(tuple, whole.collect()))
    want = sorted((r.split, r.n_users, round(r.ndcg_truth, 12)) for r in als.evaluate(whole, truth, 20).collect())
    written, write = [], als.materialize
    monkeypatch.setattr(als, "materialize", lambda df, name: written.append(write(df, name)) or written[-1])
    assert sorted((r.split, r.n_users, round(r.ndcg_truth, 12)) for r in als.evaluate(marked, truth, 20).collect()) == want
    assert written[0].count() < 60 * 20 / 4


def test_fits_over_many_rows_run_one_after_the_other(spark, monkeypatch, tmp_path):
    at_once, most, fit = [0], [0], als.fit
    lock = threading.Lock()

    def counted(*args):
        with lock:
            at_once[0] += 1
            most[0] = max(most[0], at_once[0])
        try:
            return fit(*args)
        finally:
            with lock:
                at_once[0] -= 1

    monkeypatch.setattr(als, "fit", counted)
    monkeypatch.setattr(recommend, "OVERLAP_ROWS", 10)
    configs = [als.AlsConfig("explicit", rank=r, max_iter=1) for r in (2, 3)]
    assert recommend.als_grid(spark, "/root/testdata/sf0.001", configs, str(tmp_path / "results")).count() == 2
    assert most[0] == 1
