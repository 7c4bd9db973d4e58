"""Readers for the driver's Parquet tables and the interaction fixtures
derived from them.

Every fixture is an interaction table in long form.  Column names:

* ``user_id``  BIGINT  - the entity (customer, document)
* ``item_id`` / ``item`` - the item (part BIGINT, word STRING)
* ``rating`` DOUBLE    - the value (half-star rating, term count)

Null entities or items are removed at the source, because Spark would keep
them as a group where the original tools drop them.
"""

from __future__ import annotations

import os
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from likeness.session import bounded_broadcast, input_parallelism, materialize


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order's customer; both sides are large, so this
    stays a shuffle join on the order key (Catalyst decides)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
            .where(F.col("o_custkey").isNotNull() & F.col("l_partkey").isNotNull()))


def _half_stars(quantity):
    """Quantity 1..50 -> rating 0.5..5.0 in half steps."""
    return (F.ceil(quantity / F.lit(5.0)) / F.lit(2.0)).cast("double")


def ratings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line as one interaction; duplicates are kept."""
    return _order_lines(spark, sf_dir).select(
        F.col("o_custkey").cast("bigint").alias("user_id"),
        F.col("l_partkey").cast("bigint").alias("item_id"),
        _half_stars(F.col("l_quantity")).alias("rating"),
    )


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating per (user, item): the mean quantity mapped to half stars."""
    return (_order_lines(spark, sf_dir)
            .groupBy(F.col("o_custkey").cast("bigint").alias("user_id"),
                     F.col("l_partkey").cast("bigint").alias("item_id"))
            .agg(_half_stars(F.avg("l_quantity")).alias("rating")))


def part_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, item): the size of every part a customer ordered, one row per
    order line; customers with like tastes share most sizes."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_size").where("p_size is not null")
    lines = _order_lines(spark, sf_dir)
    return lines.join(part, lines.l_partkey == part.p_partkey).select(
        F.col("o_custkey").cast("bigint").alias("user_id"), F.col("p_size").cast("bigint").alias("item"))


def part_brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(item_id, brand) of every part."""
    return read_table(spark, sf_dir, "part").where("p_partkey is not null and p_brand is not null").select(
        F.col("p_partkey").cast("bigint").alias("item_id"), F.col("p_brand").alias("brand"))


def ratings_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value STRING): the order lines as the lines of a ratings file, ids of some
    as floats, and some lines with a fault of each kind."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    rows = li.join(od, li.l_orderkey == od.o_orderkey)
    user, item = F.col("o_custkey").cast("string"), F.col("l_partkey").cast("string")
    rating = _half_stars(F.col("l_quantity")).cast("string")
    kind = F.col("l_orderkey") * 7 + F.col("l_linenumber")
    fault = kind % 41
    return rows.where("o_custkey is not null and l_partkey is not null").select(F.concat_ws(
        ",",
        F.when(fault == 1, F.concat(user, F.lit(".5"))).when(kind % 3 == 0, F.concat(user, F.lit(".0"))).otherwise(user),
        F.when(fault == 2, F.lit("")).otherwise(item),
        F.when(fault == 3, F.lit("n/a")).when(fault == 4, F.lit("NaN")).otherwise(rating),
        F.when(fault == 5, F.lit("0,extra")).otherwise(F.lit("0"))).alias("value"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, item) pairs the user 'tagged': a returned order line."""
    return (_order_lines(spark, sf_dir)
            .where(F.col("l_returnflag") == "R")
            .select(F.col("o_custkey").cast("bigint").alias("user_id"),
                    F.col("l_partkey").cast("bigint").alias("item_id"))
            .distinct())


def document_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, words ARRAY<STRING>): one row per document, the whole text
    split on single spaces.  ``doc_id`` is the table's key."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    docs = input_parallelism(docs)
    return docs.select(F.col("doc_id").cast("bigint").alias("user_id"),
                       F.split(F.col("text"), " ").alias("words"))


def doc_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as interactions: (doc, word, term count).

    Words are the pieces of ``split(text, ' ')`` over the whole text; the empty
    string is a word and line breaks stay inside words.  The words of a document
    that has its id alone are counted where its row lies, and no word moves; those
    of an id's several rows in a partial-then-final aggregate.
    """
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").where(
        F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    docs = input_parallelism(docs.select(F.col("doc_id").cast("bigint").alias("user_id"), "text"))
    several = materialize(docs.groupBy("user_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                          .select("user_id"), "repeated-documents")
    side = bounded_broadcast(several)
    words = docs.join(side, "user_id", "left_semi").select("user_id", F.explode(F.split(F.col("text"), " ")).alias("item"))
    counted = words.groupBy("user_id", "item").agg(F.count(F.lit(1)).cast("double").alias("rating"))
    return docs.join(side, "user_id", "left_anti").select("user_id", "text").mapInArrow(
        _counted_words, "user_id long, item string, rating double").unionByName(counted)


WORDS_AT_ONCE = 1 << 17        # words of one Arrow batch, but for a longer text


def _counted_words(batches):
    def rows():
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array(ids, np.int64), sizes)), pa.array(words, pa.string()),
             pa.array(counts, pa.float64())], ["user_id", "item", "rating"])

    ids, sizes, words, counts = [], [], [], []
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = Counter(text.as_py().split(" "))
            ids.append(doc)
            sizes.append(len(found))
            words.extend(found)
            counts.extend(found.values())
            if len(words) >= WORDS_AT_ONCE:
                yield rows()
                ids, sizes, words, counts = [], [], [], []
    if ids:
        yield rows()
