"""Statistics of given entity pairs.

Pair lists here are bounded (a top-k report, or k draws per trial), so they
are broadcast (after a size check; a larger list is shuffle-joined) and the
interaction table is scanned once for all pairs -
never per pair and never as an all-entities self-join.  The two members'
rows meet in an equi-join keyed by (pair, item), which spreads a very
active entity over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.functions.scalar import safe_jaccard
from likeness.operators.sets import SAMPLE_SIZE, first_items
from likeness.session import bounded_broadcast

PAIR_KEYS = ["id1", "id2"]


def _sides(inter: DataFrame, pairs: DataFrame, entity: str, item: str, value: str | None,
           keys: list[str]):
    """Rows of member 1 and member 2 of every pair, keyed by (keys, item)."""
    p = bounded_broadcast(pairs.select(*keys).distinct())
    cols = [F.col(entity), F.col(item).alias("item")]
    if value is not None:
        cols.append(F.col(value).alias("v"))
    rows = inter.select(*cols)
    a = rows.join(p, rows[entity] == p["id1"]).drop(entity)
    b = rows.join(p, rows[entity] == p["id2"]).drop(entity)
    return a, b


def common_ratings(inter: DataFrame, pairs: DataFrame, entity: str = "user_id",
                   item: str = "item", value: str = "rating",
                   keys: list[str] = PAIR_KEYS) -> DataFrame:
    """(keys..., item, r1, r2) for items both members rated."""
    a, b = _sides(inter, pairs, entity, item, value, keys)
    a = a.withColumnRenamed("v", "r1")
    b = b.withColumnRenamed("v", "r2")
    return a.join(b, keys + ["item"]).select(*keys, "item", "r1", "r2")


def correlation(common: DataFrame, pairs: DataFrame, keys: list[str] = PAIR_KEYS) -> DataFrame:
    """A7 + P13 + A10 + A11 per pair:
    (keys..., n_common, status, corr, perfect_corr, identical_ratings, constant_items).

    status: too_few (<= 1 common item), constant_user1, constant_user2 (first
    match wins), ok.  corr is Pearson's r, NULL unless ok: under ANSI a bare
    ``corr`` raises on a constant side, so it is covar / (sd1 * sd2) through
    ``try_divide`` and then gated by the status.
    """
    g = common.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_common"),
        F.min("r1").alias("lo1"), F.max("r1").alias("hi1"),
        F.min("r2").alias("lo2"), F.max("r2").alias("hi2"),
        F.try_divide(F.covar_pop("r1", "r2"),
                     F.stddev_pop("r1") * F.stddev_pop("r2")).alias("_r"),
        F.bool_and(F.col("r1") == F.col("r2")).alias("_same"))
    status = (F.when(F.coalesce(F.col("n_common"), F.lit(0)) <= 1, F.lit("too_few"))
              .when(F.col("lo1") == F.col("hi1"), F.lit("constant_user1"))
              .when(F.col("lo2") == F.col("hi2"), F.lit("constant_user2"))
              .otherwise(F.lit("ok")))
    out = pairs.select(*keys).distinct().join(g, keys, "left").withColumn("status", status)
    # the items of the pairs with a constant side alone are listed
    pair_key = F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).alias("_pk")
    constant = g.withColumn("status", status).where(F.col("status").startswith("constant")).select(*keys)
    sample = first_items(common.join(constant, keys, "left_semi").select(pair_key, "item"), "_pk", "item",
                         SAMPLE_SIZE, "constant_items")
    out = out.withColumn("_pk", pair_key).join(sample, "_pk", "left")
    corr = F.when(F.col("status") == "ok", F.col("_r"))
    return out.select(
        *keys,
        F.coalesce("n_common", F.lit(0)).cast("bigint").alias("n_common"),
        "status",
        corr.alias("corr"),
        F.coalesce(corr >= F.lit(1.0 - 1e-9), F.lit(False)).alias("perfect_corr"),
        F.coalesce(F.col("_same"), F.lit(False)).alias("identical_ratings"),
        F.when(F.col("status").startswith("constant"), F.col("constant_items"))
        .alias("constant_items"))


def noted_ratings(common: DataFrame, corr: DataFrame, keys: list[str] = PAIR_KEYS) -> DataFrame:
    """A10 + A11 in full: (keys..., status, perfect_corr, item, r1, r2), every
    common item of the pairs with a constant side or a perfect correlation."""
    noted = corr.where(F.col("status").startswith("constant") | F.col("perfect_corr"))
    return (common.join(noted.select(*keys, "status", "perfect_corr"), keys)
            .select(*keys, "status", "perfect_corr", "item", "r1", "r2"))


def mean_correlation(corr: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by..., n_pairs, avg_corr) over pairs with status ok."""
    ok = corr.where(F.col("status") == "ok")
    aggs = [F.count(F.lit(1)).alias("n_pairs"), F.avg("corr").alias("avg_corr")]
    return ok.groupBy(*(by or [])).agg(*aggs)


def validate(inter: DataFrame, pairs: DataFrame, entity: str = "user_id",
             item: str = "item") -> DataFrame:
    """Exact re-check of pairs (U2, U3, F1, P11, W7):
    (id1, id2, exists1, exists2, n1, n2, common, same_set, jaccard, sample1, sample2).
    Set semantics: duplicate interactions count once."""
    p = pairs.select("id1", "id2").distinct()
    ids = bounded_broadcast(p.select(F.col("id1").alias("id"))
                            .union(p.select(F.col("id2").alias("id"))).distinct())
    # restrict to the pair members first (map-side, broadcast semi-join), so
    # only their rows are de-duplicated and shuffled
    mine = (inter.select(F.col(entity).alias("id"), F.col(item).alias("item"))
            .join(ids, "id", "left_semi").distinct())
    sizes = mine.groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    samples = first_items(mine, "id", "item", SAMPLE_SIZE, "sample")
    a, b = _sides(mine.withColumnRenamed("id", "user_id"), p, "user_id", "item", None, PAIR_KEYS)
    common = a.join(b, PAIR_KEYS + ["item"]).groupBy(*PAIR_KEYS).agg(
        F.count(F.lit(1)).alias("common"))

    def side(i):
        return (sizes.join(samples, "id", "left")
                .select(F.col("id").alias(f"id{i}"), F.col("n").alias(f"_n{i}"),
                        F.col("sample").alias(f"sample{i}")))

    out = p.join(side(1), "id1", "left").join(side(2), "id2", "left").join(common, PAIR_KEYS, "left")
    n1 = F.coalesce("_n1", F.lit(0)).cast("bigint")
    n2 = F.coalesce("_n2", F.lit(0)).cast("bigint")
    k = F.coalesce("common", F.lit(0)).cast("bigint")
    return out.select(
        "id1", "id2",
        F.col("_n1").isNotNull().alias("exists1"), F.col("_n2").isNotNull().alias("exists2"),
        n1.alias("n1"), n2.alias("n2"), k.alias("common"),
        ((k == n1) & (k == n2)).alias("same_set"),
        safe_jaccard(k, n1, n2).alias("jaccard"),
        F.coalesce("sample1", F.lit("")).alias("sample1"),
        F.coalesce("sample2", F.lit("")).alias("sample2"))
