"""Per-entity item sets.

The source project materialises each entity's full item list.  Here the
list is summarised instead - row count, set size, an order-free digest of the
set and its smallest items - because one entity may hold a third of all
rows, and a single row holding that list cannot exist.  Every column is a
partial-then-final aggregate or a window with a group limit, so a hot entity
is combined map-side.  ``item_lists`` has the whole lists, in chunks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.functions.hashing import element_hash
from likeness.session import bounded_broadcast, materialize

SAMPLE_SIZE = 10
CHUNK_SIZE = 1000              # items of one row of a whole list, on average


def first_items(df: DataFrame, entity: str, item: str, k: int = SAMPLE_SIZE,
                out: str = "first_items") -> DataFrame:
    """(entity, out STRING): the k smallest distinct items, comma-joined.

    ``row_number() <= k`` is planned with a window group limit, which trims
    every map partition to k rows per entity before the shuffle.
    """
    w = Window.partitionBy(entity).orderBy(item)
    head = (df.select(entity, item).distinct()
            .withColumn("_rk", F.row_number().over(w)).where(F.col("_rk") <= k))
    return head.groupBy(entity).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rk", item))),
                                 lambda s: s[item].cast("string")), ",").alias(out))


def item_sets(df: DataFrame, entity: str = "user_id", item: str = "item_id") -> DataFrame:
    """(user_id, n_rows, n_items, items_digest, first_items)."""
    per_item = df.groupBy(entity, item).agg(F.count(F.lit(1)).alias("_c"))
    stats = per_item.groupBy(entity).agg(
        F.sum("_c").alias("n_rows"),
        F.count(F.lit(1)).alias("n_items"),
        F.sum(element_hash(F.col(item))).alias("items_digest"))
    # the per-(entity, item) counts are already distinct and partitioned:
    # the sample reads them instead of de-duplicating the raw rows again
    return (stats.join(first_items(per_item, entity, item), entity)
            .select(F.col(entity).alias("user_id"), "n_rows", "n_items", "items_digest",
                    "first_items"))


def item_lists(df: DataFrame, entity: str = "user_id", item: str = "item_id",
               size: int = CHUNK_SIZE) -> DataFrame:
    """(user_id, chunk, items ARRAY, times ARRAY): every item of every entity,
    ascending within a row, and the number of its rows.  An entity of n items
    has ceil(n / size) chunks, and an item is in chunk element_hash mod that."""
    per_item = materialize(df.where(F.col(entity).isNotNull()).groupBy(entity, item)
                           .agg(F.count(F.lit(1)).alias("_c")), "item-counts")
    large = (per_item.groupBy(entity).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size)
             .select(entity, F.ceil(F.col("_n") / size).alias("_k")))
    chunk = F.coalesce(element_hash(F.col(item)) % F.col("_k"), F.lit(0)).cast("bigint")
    return (per_item.join(bounded_broadcast(large), entity, "left")
            .groupBy(F.col(entity).alias("user_id"), chunk.alias("chunk"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col(item).alias("i"), "_c"))).alias("_l"))
            .select("user_id", "chunk", F.col("_l.i").alias("items"), F.col("_l._c").alias("times")))


def item_counts(df: DataFrame, entity: str = "user_id", item: str = "item_id") -> DataFrame:
    """(user_id, n_items): the size of every entity's item set."""
    return df.select(entity, item).distinct().groupBy(F.col(entity).alias("user_id")).agg(
        F.count(item).alias("n_items"))


def audit(sets: DataFrame) -> DataFrame:
    """A2 over every row of (user_id, n_items): ids unique, no entity without items."""
    return sets.agg(
        F.countDistinct("user_id").alias("unique_users"),
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("n_items").isNull() | (F.col("n_items") == 0)).alias("null_lists"),
    ).withColumn("ok", (F.col("unique_users") == F.col("row_count")) & (F.col("null_lists") == 0))


def activity(df: DataFrame, entity: str = "user_id", min_rows: int = 1) -> DataFrame:
    """A4 + P6: (user_id, n_rows) for entities with more than ``min_rows`` rows."""
    return (df.groupBy(F.col(entity).alias("user_id")).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > min_rows))
