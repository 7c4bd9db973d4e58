"""Per-entity train / validation / test split.

Each entity's rows are ordered by ``md5('seed:entity:item')`` (ties by
item) and cut positionally: the first ``n*8 div 10`` rows train, up to
``n*9 div 10`` validate, the rest test.  Entities with fewer than 5 rows are
dropped.

One plan for entities of every size.  Entities of more than ``HEAVY_ROWS`` rows
(found by one partial aggregate; there are at most rows / HEAVY_ROWS of them) are
cut into slices by the leading bits of their md5 key, about ``HEAVY_ROWS`` rows
each; every other entity is one slice.  A window numbers the rows of a slice, and
a slice's offset is the number of rows in the slices before it.  Slices follow
the key's order, so offset + place is the exact rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from likeness.functions.hashing import SEED
from likeness.session import bounded_broadcast, materialize

# Minimum items per entity and the 80/10/10 cut, in tenths.
MIN_ITEMS = 5
TRAIN_TENTHS = 8
VAL_TENTHS = 9
LEADING_HEX_DIGITS = 7
HEAVY_ROWS = 5_000_000


def shuffle_key(entity: Column, item: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), entity.cast("string"), item.cast("string")))


def ranked_within(df: DataFrame, entity: str, key: Column, tiebreak: str,
                  heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Adds ``rn`` (1-based rank of the row inside its entity by (key,
    tiebreak)) and ``n`` (rows of the entity).  ``key`` is an md5 text;
    ``heavy_rows``: rows of one entity that one task sorts.  ``df`` is read more
    than once: pass it written."""
    heavy = materialize(
        df.groupBy(entity).agg(F.count(F.lit(1)).alias("_total")).where(F.col("_total") > heavy_rows)
        .withColumn("_slices", F.ceil(F.col("_total") / heavy_rows).cast("bigint")), "heavy-entities")
    # rows are dealt before they get their keys: a key is as long as a row, and its
    # bytes sort as its text does
    bytes_ = F.unhex(key)
    if heavy.isEmpty():
        inside = Window.partitionBy(entity)
        return (df.repartition(entity).withColumn("_key", bytes_)
                .withColumn("rn", F.row_number().over(inside.orderBy("_key", tiebreak)))
                .drop("_key").withColumn("n", F.count(F.lit(1)).over(inside)))
    lead = F.conv(F.substring(key, 1, LEADING_HEX_DIGITS), 16, 10).cast("bigint")
    sliced = df.join(bounded_broadcast(heavy), entity, "left").withColumn(
        "_slice", F.when(F.col("_slices").isNull(), F.lit(0).cast("bigint"))
        .otherwise(F.shiftright(lead * F.col("_slices"), 4 * LEADING_HEX_DIGITS)))
    sizes = sliced.where("_slices is not null").groupBy(entity, "_slice").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(entity).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.select(entity, "_slice", F.sum("_c").over(before).alias("_before")), "slice-offsets")
    inside = Window.partitionBy(entity, "_slice")
    return (sliced.repartition(entity, "_slice").withColumn("_key", bytes_)
            .withColumn("_place", F.row_number().over(inside.orderBy("_key", tiebreak)))
            .withColumn("n", F.coalesce("_total", F.count(F.lit(1)).over(inside)))
            .join(bounded_broadcast(offsets), [entity, "_slice"], "left")
            .withColumn("rn", F.coalesce("_before", F.lit(0)) + F.col("_place"))
            .drop("_key", "_slice", "_slices", "_total", "_place", "_before"))


def assign_split(df: DataFrame, entity: str = "user_id", item: str = "item_id",
                 seed: int = SEED, min_items: int = MIN_ITEMS,
                 heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """df + ``split`` ('train' | 'val' | 'test'); other columns are carried."""
    ranked = ranked_within(df, entity, shuffle_key(F.col(entity), F.col(item), seed), item,
                           heavy_rows)
    split = (F.when(F.col("rn") <= F.expr(f"n * {TRAIN_TENTHS} div 10"), F.lit("train"))
             .when(F.col("rn") <= F.expr(f"n * {VAL_TENTHS} div 10"), F.lit("val"))
             .otherwise(F.lit("test")))
    return ranked.where(F.col("n") >= min_items).withColumn("split", split).drop("rn", "n")


def with_tags(split_df: DataFrame, tag_pairs: DataFrame, entity: str = "user_id",
              item: str = "item_id") -> DataFrame:
    """``tagged`` 1 when (entity, item) is among the distinct tag pairs."""
    t = tag_pairs.select(entity, item).distinct().withColumn("_t", F.lit(1))
    return (split_df.join(t, [entity, item], "left")
            .withColumn("tagged", F.coalesce("_t", F.lit(0)).cast("int")).drop("_t"))


def summary(split_df: DataFrame, entity: str = "user_id") -> DataFrame:
    """(split, n_rows, n_users)."""
    return split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                         F.countDistinct(entity).alias("n_users"))
