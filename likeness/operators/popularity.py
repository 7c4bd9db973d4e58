"""Damped-popularity recommender and its beta sweep (A16, P8, W2, W3, M1,
M4, M5).

score_beta(item) = rating_sum / (rating_count + beta).  One global top-K list
per beta; ties broken by item id.

Sweep plan:
* Pruning - with non-negative sums the score falls with beta, so at every
  beta in a run [lo, hi] at least K items score >= theta, the K-th best
  score at hi.  An item whose best score in the run (at lo) is below theta
  can never enter a list there: only the survivors are expanded.
* Scores are curves in beta, and a list changes only where two of them cross
  within it or at its end.  The lists along beta are cut into segments of equal
  lists, and every item into intervals of segments where it keeps its rank.  A
  user meets the intervals of their own held-out items: each is a gain that
  comes and goes, so a user is evaluated once per change that concerns them,
  not once per list (``swept_gains``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.functions.scalar import discount, ideal_dcg
from likeness.session import bounded_broadcast, materialize

# List length and the beta range of the sweep.
TOP_K = 100
BETA_MIN = 250
BETA_MAX = 500


def item_stats(train: DataFrame, item: str = "item_id", value: str = "rating") -> DataFrame:
    """(item_id, rating_sum, rating_count) - partial aggregate."""
    return train.groupBy(F.col(item).alias("item_id")).agg(
        F.sum(value).alias("rating_sum"), F.count(F.lit(1)).alias("rating_count"))


def _score(beta) -> F.Column:
    return F.col("rating_sum") / (F.col("rating_count") + beta)


SEGMENTS = 16


def topk_lists(stats: DataFrame, betas, k: int = TOP_K, segments: int = SEGMENTS) -> DataFrame:
    """(beta, rank, item_id, score) for each beta in ``betas``.

    The betas are cut into at most ``segments`` runs [l, h].  With
    non-negative sums the score falls with beta, so for every beta in a run
    at least k items score >= theta_h, the k-th best score at h; an item
    whose score at l is below theta_h cannot enter any list of that run.  Only
    the survivors are expanded over the run's betas: the work is
    items x segments plus survivors x betas, not items x betas.
    """
    spark = stats.sparkSession
    betas = sorted({int(b) for b in betas})
    size = -(-len(betas) // max(1, min(segments, len(betas))))
    runs = [betas[i:i + size] for i in range(0, len(betas), size)]
    run_rows = F.array(*[F.struct(F.lit(r).alias("run"), F.lit(c[0]).alias("lo"),
                                  F.lit(c[-1]).alias("hi")) for r, c in enumerate(runs)])
    per_run = stats.select("item_id", "rating_sum", "rating_count",
                           F.explode(run_rows).alias("r")).select(
        "item_id", "rating_sum", "rating_count", "r.run", "r.lo", "r.hi")
    at_hi = Window.partitionBy("run").orderBy(F.desc("_s"), F.asc("item_id"))
    theta = (per_run.withColumn("_s", _score(F.col("hi")))
             .withColumn("_rk", F.row_number().over(at_hi)).where(F.col("_rk") <= k)
             .groupBy("run").agg(F.min("_s").alias("theta"), F.count(F.lit(1)).alias("_n")))
    # a run whose table has fewer than k items keeps every item
    theta = theta.select("run", F.when(F.col("_n") >= k, F.col("theta")).alias("theta"))
    keep = ((_score(F.col("lo")) >= F.col("theta")) | F.col("theta").isNull()
            | (F.col("rating_sum") < 0))
    # one row per run: a broadcast bounded by ``segments``
    cand = per_run.join(F.broadcast(theta), "run", "left").where(keep)
    run_betas = F.array(*[F.array(*[F.lit(b) for b in c]) for c in runs])
    per_beta = cand.select("item_id", "rating_sum", "rating_count",
                           F.explode(F.element_at(run_betas, F.col("run") + 1)).alias("beta"))
    w = Window.partitionBy("beta").orderBy(F.desc("score"), F.asc("item_id"))
    return (per_beta.withColumn("score", _score(F.col("beta")))
            .withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select(F.col("beta").cast("bigint").alias("beta"),
                    F.col("rank").cast("bigint").alias("rank"), "item_id", "score"))


def list_segments(lists: DataFrame) -> DataFrame:
    """(beta, segment): neighbouring betas with equal lists share a segment;
    segments count from 0.  One row per beta."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "item_id")))
    digests = lists.groupBy("beta").agg(F.sha2(F.to_json(ordered), 256).alias("lst"))
    along = Window.orderBy("beta")
    new = F.when(F.col("lst") == F.lag("lst").over(along), 0).otherwise(1)
    return digests.withColumn("_new", new).select("beta", (F.sum("_new").over(along) - 1).alias("segment"))


def rank_intervals(lists: DataFrame, segments: DataFrame) -> DataFrame:
    """(item, rank, start, stop): the segments in which an item keeps a rank."""
    first = segments.groupBy("segment").agg(F.min("beta").alias("beta"))
    held = lists.join(F.broadcast(first), "beta").select(F.col("item_id").alias("item"), "rank", "segment")
    # within (item, rank), segments in a row differ from their place by a constant
    place = F.row_number().over(Window.partitionBy("item", "rank").orderBy("segment"))
    return held.withColumn("_run", F.col("segment") - place).groupBy("item", "rank", "_run").agg(
        F.min("segment").alias("start"), F.max("segment").alias("stop")).drop("_run")


# Gains and scores are summed as decimals: exact, so neither the order of the
# changes nor that of the users can move a mean.
_EXACT = "decimal(28,18)"


def swept_gains(truth: DataFrame, intervals: DataFrame) -> DataFrame:
    """(segment, change): at ``segment`` the sum of all users' NDCG ('hits' ideal)
    moves by ``change``.  ``truth``: distinct (user_id, item)."""
    met = truth.join(bounded_broadcast(intervals), "item")
    gain = discount(F.col("rank")).cast(_EXACT)
    moves = met.select("user_id", F.explode(F.array(
        F.struct(F.col("start").alias("segment"), gain.alias("gain"), F.lit(1).alias("hit")),
        F.struct((F.col("stop") + 1).alias("segment"), (-gain).cast(_EXACT).alias("gain"), F.lit(-1).alias("hit")))
    ).alias("m")).select("user_id", "m.*")
    at = moves.groupBy("user_id", "segment").agg(F.sum("gain").alias("gain"), F.sum("hit").alias("hit"))
    along = Window.partitionBy("user_id").orderBy("segment")
    dcg, hits = F.sum("gain").over(along).cast("double"), F.sum("hit").over(along)
    scored = at.select("user_id", "segment", dcg.alias("dcg"), hits.alias("hits")).withColumn(
        "ndcg", F.when(F.col("hits") > 0, F.col("dcg") / ideal_dcg(F.col("hits"))).otherwise(F.lit(0.0)).cast(_EXACT))
    before = F.coalesce(F.lag("ndcg").over(along), F.lit(0).cast(_EXACT))
    return scored.withColumn("_d", F.col("ndcg") - before).groupBy("segment").agg(F.sum("_d").alias("change"))


def sweep(stats: DataFrame, truth: DataFrame, lo: int = BETA_MIN, hi: int = BETA_MAX,
          k: int = TOP_K) -> DataFrame:
    """M4: (beta, ndcg) with the 'hits' ideal, every beta in [lo, hi]; users
    without a hit score 0 and count."""
    lists = materialize(topk_lists(stats, range(lo, hi + 1), k), "beta-lists")
    segments = materialize(list_segments(lists), "list-segments")
    pairs = materialize(truth.select("user_id", "item").distinct(), "truth")
    moved = swept_gains(pairs, materialize(rank_intervals(lists, segments), "rank-intervals"))
    n_users = pairs.agg(F.count_distinct("user_id").alias("n")).scalar()
    along = Window.orderBy("segment")               # one row per segment
    totals = (segments.select("segment").distinct().join(moved, "segment", "left")
              .select("segment", F.sum(F.coalesce("change", F.lit(0).cast(_EXACT))).over(along).alias("total")))
    mean = F.coalesce(F.try_divide(F.col("total").cast("double"), n_users), F.lit(0.0))
    return segments.join(F.broadcast(totals), "segment").select("beta", mean.alias("ndcg"))


def best_beta(sweep_df: DataFrame) -> DataFrame:
    """First maximum (smallest beta among equal means, compared at 12
    decimals so summation-order noise cannot pick the winner)."""
    return (sweep_df.orderBy(F.desc(F.round("ndcg", 12)), F.asc("beta")).limit(1)
            .select(F.col("beta").alias("best_beta"), F.col("ndcg").alias("val_ndcg")))
