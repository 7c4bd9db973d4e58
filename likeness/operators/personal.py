"""Personal recommendation lists without a fitted model.

A user's list holds the most popular items of the user's favourite group of
items (a brand, a genre).  The lists of all users are deterministic and plain SQL
can state them, so what surrounds a model's lists - the top K of each user, the
join with held-out truth, the denominator of the mean - is checked exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.operators.popularity import item_stats
from likeness.session import bounded_broadcast, materialize

# List length, damping of the scores and least activity of a listed user.
TOP_K = 20
BETA = 250
MIN_RATINGS = 30
GROUP_ROWS = 100_000            # items whose groups are broadcast; more meet in a shuffle join


def favourites(train: DataFrame, groups: DataFrame, min_ratings: int = MIN_RATINGS) -> DataFrame:
    """(user_id, grp): the group with the largest sum of a user's ratings, ties to
    the smaller name, of users with at least ``min_ratings`` of them.  ``groups``:
    (item_id, grp)."""
    sums = (train.join(bounded_broadcast(groups, GROUP_ROWS), "item_id").groupBy("user_id", "grp")
            .agg(F.sum("rating").alias("_s"), F.count(F.lit(1)).alias("_n")))
    best = F.min(F.struct((-F.col("_s")).alias("s"), "grp"))
    return (sums.groupBy("user_id").agg(best.alias("_b"), F.sum("_n").alias("_n"))
            .where(F.col("_n") >= min_ratings).select("user_id", F.col("_b.grp").alias("grp")))


def group_lists(train: DataFrame, groups: DataFrame, k: int = TOP_K, beta: float = BETA) -> DataFrame:
    """(grp, rank, item): the k items of each group with the best damped score."""
    scored = item_stats(train).join(bounded_broadcast(groups, GROUP_ROWS), "item_id").withColumn(
        "_s", F.col("rating_sum") / (F.col("rating_count") + beta))
    order = Window.partitionBy("grp").orderBy(F.desc("_s"), "item_id")
    return (scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("grp", F.col("rank").cast("bigint").alias("rank"), F.col("item_id").alias("item")))


def personal_lists(train: DataFrame, groups: DataFrame, k: int = TOP_K, beta: float = BETA,
                   min_ratings: int = MIN_RATINGS) -> DataFrame:
    """(user_id, rank, item).  The groups' lists are few rows and broadcast (after
    a size check); users meet them by group name, so a group that a third of all
    users like best is no single task."""
    lists = bounded_broadcast(materialize(group_lists(train, groups, k, beta), "group-lists"))
    return favourites(train, groups, min_ratings).join(lists, "grp").select("user_id", "rank", "item")
