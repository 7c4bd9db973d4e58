"""Top similar pairs per minimum-activity threshold.

The candidate set is held compactly: exact-copy groups (members) and the
signatures of their representatives.  The expanded pair list - every member of
one group against every member of another, and all pairs inside a group - is
never materialised, because one group of copies may hold a third of all
entities.  ``copy_groups`` keeps, per group, how many members pass each
threshold and the smallest of their ids: one row per group, whatever its size.

* Counts (A18): the pairs inside a group are ``e(e-1)/2`` at 1.0, those between
  two groups ``e1*e2`` at the representatives' score, summed by score inside the
  tasks that compare signatures (``buckets.histogram``).
* Top K (W1), without scoring every candidate:

  1. Every representative is compared with the least fellow member of each of its
     buckets.  With the pairs inside groups that gives a lower bound s*(t) of the
     K-th best score.
  2. A pair at s* or above differs in at most ``d`` of the slots, so it agrees on
     one of ``d + 1`` spans that cover them: an upper bound on the score of all
     pairs that share none.  The spans are longer than the LSH bands while s* is
     high, which takes hot band buckets apart; if s* is 1 for every threshold no
     two signatures need comparing at all.
  3. The cells of those buckets keep their K leading pairs per threshold.

* Expansion is bounded: K pairs of groups and K groups per threshold, each over
  the ids of its K + 1 smallest eligible members that can still reach the list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.functions.hashing import NUM_PERM
from likeness.operators import buckets
from likeness.session import materialize

# Minimum-rating thresholds and list length of the top-pair report.
THRESHOLDS = (5, 10, 20, 30, 40, 50)
TOP_K = 100
NO_ID = 2**63 - 1              # smallest eligible id of a group without one


def product(a, b):
    """Exact product of two counts, beyond 2^63 as well."""
    return a.cast("decimal(19,0)") * b.cast("decimal(19,0)")


def pairs_within(size: str):
    """size * (size - 1) / 2, exactly: the even factor is halved first."""
    even = F.col(size) % 2 == 0
    return product(F.when(even, F.expr(f"{size} div 2")).otherwise(F.col(size)),
                    F.when(even, F.col(size) - 1).otherwise(F.expr(f"({size} - 1) div 2")))


def copy_groups(members: DataFrame, reps: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """(group_id, sig, e ARRAY, lo ARRAY): per threshold the members with more
    rows, and the smallest of their ids."""
    passes = [F.col("n") > t for t in thresholds]
    sizes = members.groupBy("group_id").agg(
        F.array(*[F.count_if(p) for p in passes]).alias("e"),
        F.array(*[F.coalesce(F.min(F.when(p, F.col("id"))), F.lit(NO_ID)) for p in passes]).alias("lo"))
    return reps.select("group_id", "sig").join(sizes, "group_id")


def _by_threshold(groups: DataFrame, thresholds) -> DataFrame:
    """(min_ratings, group_id, e, lo) of the groups of two eligible members or more."""
    ts = F.array(*[F.lit(int(t)).cast("bigint") for t in thresholds])
    return groups.select("group_id", F.explode(F.arrays_zip(ts.alias("t"), "e", "lo")).alias("x")).select(
        F.col("x.t").alias("min_ratings"), "group_id", F.col("x.e").alias("e"), F.col("x.lo").alias("lo")
    ).where("e >= 2")


def _inside(groups: DataFrame, thresholds) -> DataFrame:
    """The histogram rows of the pairs inside groups."""
    return _by_threshold(groups, thresholds).groupBy("min_ratings").agg(
        F.sum(pairs_within("e")).cast("decimal(38,0)").alias("cnt")).select(
        "min_ratings", F.lit(1.0).alias("estimated_jaccard"), "cnt")


def score_histogram(members: DataFrame, reps: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """(min_ratings, estimated_jaccard, cnt) over all expanded candidate pairs."""
    groups = materialize(copy_groups(members, reps, thresholds), "copy-groups")
    return (_inside(groups, thresholds).unionByName(buckets.histogram(groups, thresholds))
            .groupBy("min_ratings", "estimated_jaccard").agg(F.sum("cnt").cast("decimal(38,0)").alias("cnt")))


def pairs_per_threshold(hist: DataFrame, thresholds=THRESHOLDS, k: int = TOP_K) -> DataFrame:
    """(min_ratings, n_pairs, n_kept): expanded candidate pairs with both
    counts > t, and how many of them the top-k report keeps.  ``n_pairs`` is a
    DECIMAL: a group of 5 billion copies has more pairs than a BIGINT holds."""
    spark = hist.sparkSession
    ts = spark.createDataFrame([(int(t),) for t in thresholds], "min_ratings bigint")
    counts = hist.groupBy("min_ratings").agg(F.sum("cnt").cast("decimal(38,0)").alias("n_pairs"))
    n = F.coalesce("n_pairs", F.lit(0)).cast("decimal(38,0)")
    return (ts.join(counts, "min_ratings", "left")
            .select("min_ratings", n.alias("n_pairs"), F.least(n, F.lit(k)).cast("bigint").alias("n_kept")))


def _hub_histogram(groups: DataFrame, thresholds) -> DataFrame:
    """Histogram rows of some candidate pairs: every representative with the
    least member of each of its band buckets (rows linear in the groups)."""
    spans = buckets.BANDS
    keys = F.array(*[F.xxhash64(F.lit(j), F.slice("sig", a + 1, n)) for j, (a, n) in enumerate(spans)])
    posted = groups.select(F.col("group_id").alias("id2"), F.explode(keys).alias("key"))
    hubs = posted.groupBy("key").agg(F.min("id2").alias("id1"), F.max("id2").alias("last")).where("id1 < last")
    pairs = materialize(posted.join(hubs.select("key", "id1"), "key").where("id1 < id2").select("id1", "id2")
                        .distinct(), "hub-pairs")
    side = lambda i: groups.select(F.col("group_id").alias(f"id{i}"), F.col("sig").alias(f"s{i}"),
                                   F.col("e").alias(f"e{i}"))
    equal = F.zip_with("s1", "s2", lambda x, y: x == y)
    agree = F.lit(False)
    for a, n in spans:                       # a digest may collide: the slots decide
        agree = agree | F.forall(F.slice("same", a + 1, n), lambda x: x)
    ts = F.array(*[F.lit(int(t)).cast("bigint") for t in thresholds])
    scored = pairs.join(side(1), "id1").join(side(2), "id2").withColumn("same", equal).where(agree).select(
        (F.size(F.filter("same", lambda x: x)) / F.size("same")).alias("estimated_jaccard"),
        F.explode(F.arrays_zip(ts.alias("t"), "e1", "e2")).alias("x"))
    return scored.where("x.e1 > 0 and x.e2 > 0").groupBy(
        F.col("x.t").alias("min_ratings"), "estimated_jaccard").agg(
        F.sum(product(F.col("x.e1"), F.col("x.e2"))).cast("decimal(38,0)").alias("cnt"))


def _needed_slots(groups: DataFrame, thresholds, k: int, slots: int) -> list[int]:
    """Per threshold the equal slots that a pair of groups needs to reach the
    list: those of the K-th best pair known so far, all and one more when K pairs
    at 1.0 are known, 0 when fewer than K pairs are."""
    known = _inside(groups, thresholds).unionByName(_hub_histogram(groups, thresholds))
    rows = known.groupBy("min_ratings", "estimated_jaccard").agg(F.sum("cnt").alias("cnt")).collect()
    out = []                                  # at most thresholds x (slots + 1) rows
    for t in thresholds:
        left, least = k, 0
        for r in sorted((r for r in rows if r.min_ratings == t), key=lambda r: -r.estimated_jaccard):
            left -= int(r.cnt)
            if left <= 0:
                equal = round(r.estimated_jaccard * slots)
                least = slots + 1 if equal == slots else equal
                break
        out.append(least)
    return out


def leading_pairs(groups: DataFrame, thresholds=THRESHOLDS, k: int = TOP_K, slots: int = NUM_PERM) -> DataFrame:
    """(min_ratings, id1, id2, estimated_jaccard): per threshold the K pairs of
    groups that lead by score, then by their lowest expanded pair."""
    least = _needed_slots(groups, thresholds, k, slots)
    apart = slots - min(least)
    if apart < 0:
        return groups.sparkSession.createDataFrame(
            [], "min_ratings bigint, id1 bigint, id2 bigint, estimated_jaccard double")
    # d + 1 spans hold every pair at the bound; beyond the number of bands the bands themselves do
    spans = buckets.equal_spans(apart + 1, slots) if apart < len(buckets.BANDS) else buckets.BANDS
    by_score = Window.partitionBy("min_ratings").orderBy(F.desc("estimated_jaccard"), "a", "b")
    found = buckets.best(groups, [int(t) for t in thresholds], least, k, spans, slots=slots)
    return (found.withColumn("_p", F.row_number().over(by_score)).where(F.col("_p") <= k)
            .select("min_ratings", "id1", "id2", "estimated_jaccard"))


def top_pairs(members: DataFrame, reps: DataFrame, thresholds=THRESHOLDS, k: int = TOP_K,
              slots: int = NUM_PERM) -> DataFrame:
    """(min_ratings, rank, id1, id2, estimated_jaccard, n1, n2).

    ``members`` (id, n, group_id); ``reps`` (group_id, sig) of the distinct
    signatures.  Ties are broken by (id1, id2), so the result is a total order.

    Whenever k groups (or k pairs of groups at the same score) have a lower
    lowest pair than some pair p, p cannot be in the top k.  A group's lowest pair
    begins with its smallest eligible id, so the k groups with the smallest ones
    suffice.
    """
    groups = materialize(copy_groups(members, reps, thresholds), "copy-groups")
    by_least = Window.partitionBy("min_ratings").orderBy("lo")
    inner = materialize(_by_threshold(groups, thresholds).withColumn("_g", F.row_number().over(by_least))
                        .where(F.col("_g") <= k).select("min_ratings", "group_id"), "leading-groups")
    wanted = materialize(leading_pairs(groups, thresholds, k, slots), "leading-pairs")
    # at most 3k groups per threshold are expanded, each to its k + 1 smallest ids
    asked = inner.union(wanted.select("min_ratings", "id1")).union(wanted.select("min_ratings", "id2")).distinct()
    by_group = Window.partitionBy("min_ratings", "group_id").orderBy("id")
    ranked = materialize(
        members.join(F.broadcast(asked), "group_id").where("n > min_ratings").select("min_ratings", "group_id", "id")
        .withColumn("rk", F.row_number().over(by_group)).where(F.col("rk") <= k + 1), "leading-ids")

    # pair (i, j) of a group has all pairs of its first i - 1 ids before it, and
    # those of i up to j: beyond k of them it is out
    sized = ranked.join(F.broadcast(inner), ["min_ratings", "group_id"]).withColumn(
        "size", F.count(F.lit(1)).over(Window.partitionBy("min_ratings", "group_id")))
    a = sized.select("min_ratings", "group_id", F.col("id").alias("id1"), F.col("rk").alias("i"), "size")
    b = sized.select("min_ratings", "group_id", F.col("id").alias("id2"), F.col("rk").alias("j"))
    inside = (a.join(b, ["min_ratings", "group_id"])
              .where("i < j").where(F.expr("(i - 1) * size - (i - 1) * i div 2 + (j - i)") <= k)
              .select("min_ratings", "id1", "id2", F.lit(1.0).alias("estimated_jaccard")))
    # of two groups, i * j - 1 pairs are lower than that of their i-th and j-th ids
    side = lambda n, x, at: ranked.where(F.col("rk") <= k).select(
        "min_ratings", F.col("group_id").alias(n), F.col("id").alias(x), F.col("rk").alias(at))
    across = (F.broadcast(wanted).join(side("id1", "x", "i"), ["min_ratings", "id1"])
              .join(side("id2", "y", "j"), ["min_ratings", "id2"]).where(F.col("i") * F.col("j") <= k)
              .select("min_ratings", F.least("x", "y").alias("id1"), F.greatest("x", "y").alias("id2"),
                      "estimated_jaccard"))
    order = Window.partitionBy("min_ratings").orderBy(
        F.desc("estimated_jaccard"), F.asc("id1"), F.asc("id2"))
    top = (inside.unionByName(across).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    n1 = members.select(F.col("id").alias("id1"), F.col("n").alias("n1"))
    n2 = members.select(F.col("id").alias("id2"), F.col("n").alias("n2"))
    # the report holds at most k rows per threshold
    return (F.broadcast(top).join(n1, "id1").join(n2, "id2")
            .select("min_ratings", F.col("rank").cast("bigint").alias("rank"), "id1", "id2",
                    "estimated_jaccard", "n1", "n2"))
