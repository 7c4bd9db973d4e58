"""Split, popularity baseline, ranking metrics, backfill and ALS queries."""

from __future__ import annotations

import os
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from likeness.operators import als, personal, popularity, ranking, split
from likeness.plans import common
from likeness.session import collect_garbage, materialize, scratch_path, written
from likeness.sources import files, tables

# The betas shown by the top-k query and the list of the
# per-user metric queries.
SHOWN_BETAS = (250, 500)
LIST_BETA = 250


def _paths(sf_dir, *names):
    return [os.path.join(sf_dir, f"{n}.parquet") for n in names]


def _split(spark, sf_dir):
    """The ratings split (train / val / test), written once: the popularity,
    metric and ALS reports all read it."""
    return written(spark, "ratings_split", _paths(sf_dir, "lineitem", "orders"),
                   (split.MIN_ITEMS, split.TRAIN_TENTHS, split.VAL_TENTHS),
                   lambda: split.assign_split(materialize(tables.ratings(spark, sf_dir), "ratings"),
                                              "user_id", "item_id"))


def _doc_split(spark, sf_dir):
    return written(spark, "doc_split", _paths(sf_dir, "documents"),
                   (split.MIN_ITEMS, split.TRAIN_TENTHS, split.VAL_TENTHS),
                   lambda: split.assign_split(common.docs(spark, sf_dir), "user_id", "item"))


def q_split_assignment(spark, sf_dir):
    return _split(spark, sf_dir).select("user_id", "item_id", "split")


def q_split_summary(spark, sf_dir):
    return split.summary(_split(spark, sf_dir))


def q_enriched_split(spark, sf_dir):
    return _split(spark, sf_dir).select("user_id", "item_id", "split", "rating")


def _tagged(spark, sf_dir):
    return written(spark, "tagged_split", _paths(sf_dir, "lineitem", "orders"),
                   (split.MIN_ITEMS, split.TRAIN_TENTHS, split.VAL_TENTHS),
                   lambda: split.with_tags(_split(spark, sf_dir), tables.tags(spark, sf_dir)))


def q_tagged_split(spark, sf_dir):
    return _tagged(spark, sf_dir).select("user_id", "item_id", "split", "rating", "tagged")


def _stats(spark, sf_dir):
    s = _split(spark, sf_dir)
    return s, popularity.item_stats(s.where(F.col("split") == "train"))


def _truth(s, which):
    return (s.where(F.col("split").isin(*which))
            .select("split", "user_id", F.col("item_id").alias("item")))


def q_item_stats(spark, sf_dir):
    return _stats(spark, sf_dir)[1]


def q_popularity_topk(spark, sf_dir):
    _, stats = _stats(spark, sf_dir)
    lists = popularity.topk_lists(stats, SHOWN_BETAS)
    return lists.withColumn("score", F.round("score", 6))


def _sweep(spark, sf_dir):
    """(split, item stats, validation metrics per beta); the metrics table
    (251 rows) is written once and read by both the sweep and the best-beta
    report."""
    s, stats = _stats(spark, sf_dir)
    sw = written(spark, "beta_sweep", _paths(sf_dir, "lineitem", "orders"),
                 (popularity.BETA_MIN, popularity.BETA_MAX, popularity.TOP_K),
                 lambda: popularity.sweep(stats, _truth(s, ["val"]).drop("split")))
    return s, stats, sw


def q_beta_sweep(spark, sf_dir):
    _, _, sw = _sweep(spark, sf_dir)
    return sw.select("beta", F.round("ndcg", 6).alias("ndcg"))


def q_best_beta_test(spark, sf_dir):
    s, stats, sw = _sweep(spark, sf_dir)
    row = popularity.best_beta(sw).first()           # one row
    best = spark.createDataFrame([tuple(row)], "best_beta bigint, val_ndcg double")
    b = row["best_beta"]
    lst = popularity.topk_lists(stats, [b]).select(
        "rank", F.col("item_id").alias("item"))
    test = ranking.mean_ndcg(lst, _truth(s, ["test"]).drop("split"), popularity.TOP_K)
    return best.select(F.col("best_beta").cast("bigint").alias("best_beta"),
                       F.round("val_ndcg", 6).alias("val_ndcg"),
                       test.select(F.round("ndcg_hits", 6)).scalar().alias("test_ndcg"))


def _fixed_list(spark, sf_dir):
    s, stats = _stats(spark, sf_dir)
    lst = popularity.topk_lists(stats, [LIST_BETA]).select(
        "rank", F.col("item_id").alias("item"))
    return s, lst


def q_ndcg_by_user(spark, sf_dir):
    s, lst = _fixed_list(spark, sf_dir)
    out = ranking.per_user(lst, _truth(s, ["val", "test"]), popularity.TOP_K, tkeys=["split"])
    return out.select("user_id", "split", "hits", F.round("ndcg_hits", 6).alias("ndcg_hits"),
                      F.round("ndcg_truth", 6).alias("ndcg_truth"))


def q_ndcg_mean(spark, sf_dir):
    s, lst = _fixed_list(spark, sf_dir)
    out = ranking.mean_ndcg(lst, _truth(s, ["val", "test"]), popularity.TOP_K, tkeys=["split"])
    return out.select("split", "n_users", F.round("ndcg_hits", 6).alias("ndcg_hits"),
                      F.round("ndcg_truth", 6).alias("ndcg_truth"))


def _doc_parts(spark, sf_dir):
    ds = _doc_split(spark, sf_dir)
    return ds.where(F.col("split") == "train"), ds.where(F.col("split") != "train")


def q_cold_items(spark, sf_dir):
    train, held = _doc_parts(spark, sf_dir)
    return als.cold_items(train, held, "item")


def q_backfill_rows(spark, sf_dir):
    train, held = _doc_parts(spark, sf_dir)
    return als.backfill(train, held, "user_id", "item", "rating")


def q_train_with_backfill(spark, sf_dir):
    train, held = _doc_parts(spark, sf_dir)
    full = als.train_with_backfill(train, als.backfill(train, held, "user_id", "item", "rating"))
    return full.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"))


def als_train(spark, sf_dir):
    """Tagged ratings train split + backfill, cast for ALS (written once)."""
    t = _tagged(spark, sf_dir)

    def build():
        train = t.where(F.col("split") == "train")
        held = t.where(F.col("split") != "train")
        full = als.train_with_backfill(
            train, als.backfill(train, held, "user_id", "item_id", "rating"),
            "user_id", "item_id", "rating")
        return als.als_input(full, "user_id", "item_id", "rating", "tagged")

    return t, written(spark, "als_train", _paths(sf_dir, "lineitem", "orders"),
                      (split.MIN_ITEMS,), build)


def q_als_input(spark, sf_dir):
    return als_train(spark, sf_dir)[1]


def q_implicit_confidence(spark, sf_dir):
    c = als.confidence(als_train(spark, sf_dir)[1])
    return c.select("user", "item", F.round("rating", 6).alias("confidence"))


def q_implicit_confidence_avg(spark, sf_dir):
    c = als.confidence(als_train(spark, sf_dir)[1])
    return c.agg(F.round(F.avg("rating"), 6).alias("avg_confidence"))


def _als_recs(spark, sf_dir, cfg):
    t, train = als_train(spark, sf_dir)
    model = als.fit(train, cfg)
    users = (t.where(F.col("split") != "train")
             .select(F.col("user_id").cast("int").alias("user")).distinct())
    return t, als.recommend(model, users, als.TOP_K)


def q_als_explicit(spark, sf_dir):
    return _als_recs(spark, sf_dir, als.AlsConfig("explicit"))[1]


def q_als_implicit(spark, sf_dir):
    return _als_recs(spark, sf_dir, als.AlsConfig("implicit"))[1]


def _personal(spark, sf_dir):
    s = _split(spark, sf_dir)
    groups = tables.part_brands(spark, sf_dir).withColumnRenamed("brand", "grp")
    return s, written(spark, "personal_lists", _paths(sf_dir, "lineitem", "orders", "part"),
                      (personal.TOP_K, personal.BETA, personal.MIN_RATINGS),
                      lambda: personal.personal_lists(s.where(F.col("split") == "train"), groups))


def q_personal_lists(spark, sf_dir):
    lists = ranking.as_lists(_personal(spark, sf_dir)[1])
    return lists.select("user_id", F.array_join(
        F.transform("recommendations", lambda x: x.cast("bigint").cast("string")), ",").alias("items"))


def q_personal_ndcg(spark, sf_dir):
    s, lists = _personal(spark, sf_dir)
    # truth that a first order line of a kind brings: some listed users have none
    truth = _truth(s.where(F.col("rating") >= 4.0), ["val", "test"])
    out = ranking.inner_personal(lists, truth, personal.TOP_K, tkeys=["split"])
    return out.select("split", "n_users", "n_truth_only", "n_lists_only",
                      F.round("ndcg_hits", 6).alias("ndcg_hits"), F.round("ndcg_truth", 6).alias("ndcg_truth"))


def q_split_roundtrip(spark, sf_dir):
    """The split written by ``split``, its validation part replaced by the rows of
    one star or more, and each part read back from its own folder."""
    s = _split(spark, sf_dir)
    path = scratch_path(spark, "split")
    files.write_split(s.select("user_id", "item_id", "rating", "split"), path)
    better = s.where((F.col("split") == "val") & (F.col("rating") >= 1.0))
    files.replace_split(better.select("user_id", "item_id", "rating", "split"), path)
    val, test = (files.read_split(spark, path, which) for which in ("val", "test"))
    return val.unionByName(test).select("user_id", "item_id", "rating", "split")


def q_metric_results(spark, sf_dir):
    """The results table of a few betas, one of them saved twice: a run again of a
    configuration replaces its row."""
    _, _, sw = _sweep(spark, sf_dir)
    path = scratch_path(spark, "metric_results")
    for beta in (*SHOWN_BETAS, SHOWN_BETAS[0]):
        row = sw.where(F.col("beta") == beta).select(F.round("ndcg", 6).alias("val_ndcg"))
        files.save_result(row, path, {"beta": beta, "k": popularity.TOP_K})
    return files.read_results(spark, path).select(
        F.col("beta").cast("bigint").alias("beta"), F.col("k").cast("bigint").alias("k"), "val_ndcg")


DEFAULT_GRID = (als.AlsConfig("explicit"), als.AlsConfig("implicit"))


FITS_AT_ONCE = 4
OVERLAP_ROWS = 10_000_000      # of train; an iteration over more leaves no core idle, and two need twice the disk


def als_grid(spark, sf_dir, configs=DEFAULT_GRID, path=None, at_once: int = FITS_AT_ONCE):
    """One row per configuration in the results table at ``path``.  Fits run
    ``at_once`` side by side, each in a scheduler pool of its own: an iteration of
    one fills the cores that the last tasks of another leave idle.  Over more than
    ``OVERLAP_ROWS`` they run one after the other.  Each saves its
    own row, so a run that is broken off and started again adds nothing twice."""
    t, train = als_train(spark, sf_dir)
    truth = (t.where(F.col("split") != "train")
             .select("split", "user_id", F.col("item_id").alias("item")))
    users = truth.select(F.col("user_id").cast("int").alias("user")).distinct()
    path = path or scratch_path(spark, "als_results")

    def one(cfg):
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"als-{cfg.mode}-{cfg.rank}-{cfg.reg_param}")
        recs = als.recommend(als.fit(train, cfg), users, als.TOP_K, truth)
        found = als.evaluate(recs, truth, als.TOP_K)
        ndcg = lambda which: F.max(F.when(F.col("split") == which, F.col("ndcg_truth")))
        files.save_result(found.agg(ndcg("val").alias("val_ndcg"), ndcg("test").alias("test_ndcg")), path, {
            "mode": cfg.mode, "rank": cfg.rank, "reg_param": cfg.reg_param, "max_iter": cfg.max_iter,
            "alpha": cfg.alpha if cfg.implicit else None, "tag_bonus": cfg.tag_bonus if cfg.implicit else None})
        del recs, found
        collect_garbage(spark)                  # before the next fit

    with ThreadPoolExecutor(max_workers=at_once if train.count() <= OVERLAP_ROWS else 1) as pool:
        # a thread that inherits the caller's properties per fit: they do not leak between fits
        for done in [pool.submit(inheritable_thread_target(spark)(one), cfg) for cfg in configs]:
            done.result()
    found = files.read_results(spark, path)
    held = lambda c: (F.col(c) if c in found.columns else F.lit(None)).cast("double").alias(c)
    return found.select("mode", "rank", "reg_param", "max_iter", held("alpha"), held("tag_bonus"),
                        "val_ndcg", "test_ndcg")


def q_als_grid(spark, sf_dir):
    return als_grid(spark, sf_dir)
