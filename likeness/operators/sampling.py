"""Seeded random pairs of entities.

Draw j of trial t over n eligible entities indexed 0..n-1 in id order::

    i1 = h('seed:t:j:a') mod n
    i2 = h('seed:t:j:b') mod (n-1), plus 1 when i2 >= i1
    pair = (least(id[i1], id[i2]), greatest(...))

The first draw of a pair counts and the ``k`` lowest draws of each trial are
kept.  Every trial makes 20*k draws, and twice as many whenever a trial is left
short of min(k, n(n-1)/2) pairs: one rule for every n.  ``h`` has 60 bits.
All trials are one job: the draw table grows with trials x draws only, is
broadcast (after a size check), and meets the entity index in an equi-join on
the index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.functions.hashing import SEED, wide_seeded_hash
from likeness.session import bounded_broadcast, materialize

# Trials, pairs per trial and the minimum activity of the
# random control group.
TRIALS = 20
PAIRS_PER_TRIAL = 100
MIN_RATINGS = 1


def dense_index(ids: DataFrame, id_col: str = "id") -> DataFrame:
    """(idx BIGINT, id) numbered 0..n-1 in id order.

    A global ``row_number`` would run in one task.  The ids are range-
    partitioned and sorted, and written with their place in their partition; a
    partition's offset is the number of rows in the partitions before it (one
    row per partition, whatever the table's size).
    """
    spot = F.monotonically_increasing_id()       # partition << 33 | place in it
    run = materialize(ids.select(F.col(id_col).alias("id")).repartitionByRange("id").sortWithinPartitions("id")
                      .withColumn("_spot", spot).withColumn("_part", F.shiftright("_spot", 33)), "dense-index")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (run.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_spot").alias("_first"))
               .select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return run.join(F.broadcast(offsets), "_part").select(
        (F.col("_before") + F.col("_spot") - F.col("_first")).alias("idx"), "id")


def draws(spark, n: int, trials: int = TRIALS, per_trial: int = 20 * PAIRS_PER_TRIAL,
          seed: int = SEED) -> DataFrame:
    """(trial, draw, i1, i2) for every draw; needs n >= 2."""
    r = spark.range(0, trials * per_trial)
    trial = (F.col("id") / per_trial).cast("bigint")
    j = F.col("id") % per_trial
    base = r.select(trial.alias("trial"), j.alias("draw"))
    i1 = wide_seeded_hash(F.lit(seed), F.col("trial"), F.col("draw"), F.lit("a")) % F.lit(n)
    i2 = wide_seeded_hash(F.lit(seed), F.col("trial"), F.col("draw"), F.lit("b")) % F.lit(n - 1)
    return (base.withColumn("i1", i1).withColumn("_i2", i2)
            .withColumn("i2", F.when(F.col("_i2") >= F.col("i1"), F.col("_i2") + 1)
                        .otherwise(F.col("_i2")))
            .drop("_i2"))


def random_pairs(eligible_ids: DataFrame, trials: int = TRIALS, k: int = PAIRS_PER_TRIAL,
                 seed: int = SEED, per_trial: int | None = None) -> DataFrame:
    """(trial, draw, id1, id2): k distinct unordered pairs per trial (fewer
    only when fewer exist).  ``eligible_ids`` has one column ``id``."""
    spark = eligible_ids.sparkSession
    index = dense_index(eligible_ids)
    n = index.count()
    if n < 2:
        return spark.createDataFrame([], "trial bigint, draw bigint, id1 bigint, id2 bigint")
    per_trial, wanted = per_trial or 20 * k, trials * min(k, n * (n - 1) // 2)
    while True:
        found = materialize(_drawn(index, draws(spark, n, trials, per_trial, seed), k), "drawn-pairs")
        if found.count() >= wanted:
            return found
        per_trial *= 2


def _drawn(index: DataFrame, drawn: DataFrame, k: int) -> DataFrame:
    """The first ``k`` distinct pairs of each trial."""
    d = bounded_broadcast(drawn)
    a = index.select(F.col("idx").alias("i1"), F.col("id").alias("u1"))
    b = index.select(F.col("idx").alias("i2"), F.col("id").alias("u2"))
    pairs = (a.join(d, "i1").join(b, "i2")
             .select("trial", "draw", F.least("u1", "u2").alias("id1"),
                     F.greatest("u1", "u2").alias("id2")))
    first = pairs.groupBy("trial", "id1", "id2").agg(F.min("draw").alias("draw"))
    w = Window.partitionBy("trial").orderBy("draw")
    return (first.withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k)
            .select("trial", "draw", "id1", "id2"))
