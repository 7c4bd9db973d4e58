"""Checks on similar pairs and the random control group (docs fixture), plus
per-entity item sets (ratings_raw fixture)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from likeness.operators import pairs, sampling, sets, toppairs
from likeness.plans import common
from likeness.plans.similarity import top_pairs_docs
from likeness.session import materialize, scratch_path, written
from likeness.sources import files, tables

# The pair file the source project re-checks is the top-100 of
# its strictest threshold.
CHECKED_THRESHOLD = 50


def checked_pairs(spark, sf_dir):
    """The re-checked pair list (<= 100 rows), written once per input: every
    check below reads it (the source project hands it over as a file)."""
    return written(spark, "checked_pairs", [os.path.join(sf_dir, "documents.parquet")],
                   (CHECKED_THRESHOLD, toppairs.TOP_K),
                   lambda: top_pairs_docs(spark, sf_dir, thresholds=(CHECKED_THRESHOLD,))
                   .select("id1", "id2"))


def q_grouped_items(spark, sf_dir):
    return sets.item_sets(tables.ratings_raw(spark, sf_dir), "user_id", "item_id")


def q_item_lists(spark, sf_dir):
    found = sets.item_lists(tables.ratings_raw(spark, sf_dir), "user_id", "item_id")
    return found.select("user_id", "chunk", *(
        F.array_join(F.col(c).cast("array<string>"), ",").alias(c) for c in ("items", "times")))


def q_grouped_audit(spark, sf_dir):
    return sets.audit(sets.item_counts(tables.ratings_raw(spark, sf_dir), "user_id", "item_id"))


def q_pair_validation(spark, sf_dir):
    docs = common.docs(spark, sf_dir)
    # two pairs with ids no document has: one known + one unknown member,
    # and two unknown members (both sets empty)
    bounds = docs.agg(F.min("user_id").alias("lo"), F.max("user_id").alias("hi"))
    unknown = bounds.select(F.explode(F.array(
        F.struct(F.col("lo").alias("id1"), (F.col("hi") + 1).alias("id2")),
        F.struct((F.col("hi") + 1).alias("id1"), (F.col("hi") + 2).alias("id2")))).alias("p")
    ).select("p.id1", "p.id2")
    found = pairs.validate(docs, checked_pairs(spark, sf_dir).unionByName(unknown))
    return found.withColumn("jaccard", F.round("jaccard", 6))


def q_pair_common_ratings(spark, sf_dir):
    return pairs.common_ratings(common.docs(spark, sf_dir), checked_pairs(spark, sf_dir))


def _pair_corr(spark, sf_dir):
    docs = common.docs(spark, sf_dir)
    p = checked_pairs(spark, sf_dir)
    # read for the sums and for the items of constant sides: the documents are scanned once
    return pairs.correlation(materialize(pairs.common_ratings(docs, p), "common_ratings"), p)


def q_pair_correlation(spark, sf_dir):
    return _pair_corr(spark, sf_dir).withColumn("corr", F.round("corr", 6))


def q_pair_noted_ratings(spark, sf_dir):
    p = checked_pairs(spark, sf_dir)
    common_rows = materialize(pairs.common_ratings(common.docs(spark, sf_dir), p), "common_ratings")
    return pairs.noted_ratings(common_rows, pairs.correlation(common_rows, p))


def q_avg_pair_correlation(spark, sf_dir):
    return pairs.mean_correlation(_pair_corr(spark, sf_dir)).withColumn(
        "avg_corr", F.round("avg_corr", 6))


def q_eligible_users(spark, sf_dir):
    return sets.activity(tables.ratings_raw(spark, sf_dir), "user_id", sampling.MIN_RATINGS)


def _random_pairs(spark, sf_dir):
    docs = common.docs(spark, sf_dir)
    elig = sets.activity(docs, "user_id", sampling.MIN_RATINGS).select(
        F.col("user_id").alias("id"))
    return docs, sampling.random_pairs(elig)


def q_random_pairs(spark, sf_dir):
    return _random_pairs(spark, sf_dir)[1]


def q_random_pair_baseline(spark, sf_dir):
    docs, rp = _random_pairs(spark, sf_dir)
    rp = materialize(rp, "random_pairs")
    keys = ["trial", "id1", "id2"]
    corr = pairs.correlation(pairs.common_ratings(docs, rp, keys=keys), rp, keys=keys)
    per_trial = pairs.mean_correlation(corr, by=["trial"])
    trials = rp.sparkSession.range(sampling.TRIALS).select(F.col("id").alias("trial"))
    out = (trials.join(per_trial, "trial", "left")
           .select("trial", F.coalesce("n_pairs", F.lit(0)).cast("bigint").alias("n_pairs"),
                   F.coalesce("avg_corr", F.lit(0.0)).alias("avg_corr")))
    final = out.agg(F.round(F.sum("avg_corr") / F.lit(float(sampling.TRIALS)), 6)).scalar()
    return out.withColumn("avg_corr", F.round("avg_corr", 6)).withColumn("final_corr", final)


def q_csv_roundtrip(spark, sf_dir):
    # the bounded report of the strictest threshold: at most TOP_K rows
    sp = top_pairs_docs(spark, sf_dir, thresholds=(CHECKED_THRESHOLD,))
    path = scratch_path(spark, "top_pairs_csv")
    files.write_csv(sp.select(F.col("id1").cast("double").alias("userId1"),
                              F.col("id2").alias("userId2"), "estimated_jaccard",
                              F.col("n1").alias("user1_ratings"),
                              F.col("n2").alias("user2_ratings")), path)
    return files.read_pairs_csv(spark, path)


def _ratings_file(spark, sf_dir):
    """The lines of a written ratings file, read with its declared schema."""
    paths = [os.path.join(sf_dir, f"{n}.parquet") for n in ("lineitem", "orders")]

    def build():
        path = scratch_path(spark, "ratings_csv")
        tables.ratings_lines(spark, sf_dir).write.text(path)
        return files.read_ratings_csv(spark, path, header=False)
    return written(spark, "ratings_file", paths, (), build)


def q_ratings_from_csv(spark, sf_dir):
    return _ratings_file(spark, sf_dir).where("reason is null").select("user_id", "item_id", "rating")


def q_ratings_csv_rejects(spark, sf_dir):
    return _ratings_file(spark, sf_dir).where("reason is not null").groupBy("reason").agg(
        F.count(F.lit(1)).alias("n_lines"))
