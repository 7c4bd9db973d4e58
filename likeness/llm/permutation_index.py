"""Approximate nearest neighbours by a permutation index (operator 2).

Every vector is represented by its ``PREFIX`` nearest of ``PIVOTS`` pivots, in
order of distance.  The index deals all vectors to blocks of about ``ROWS`` by a
hash of their id; within a block, a pivot's inverted file posts the vectors that
have it in their prefix, with its place there.  A query walks the files of its
own prefix and adds up what each shared pivot saves of the footrule distance
(places beyond the prefix count as its end):

    footrule(q, x) = constant - 2 * sum over shared pivots of (PREFIX - larger place).

The ``SHARE`` of a block with the smallest footrule distance (ties included, no
fewer than ``LEAST``) is reranked by the exact Euclidean distance.

The pivots come from a sample of at most ``SAMPLE`` vectors with the smallest
hashes (the only thing fitted, and of fixed size), each the farthest from those
before it, so that a large group of near copies does not fill the prefixes.
Vectors of each length have a sample, pivots and blocks of their own.  Equal vectors are indexed once, with
the ``k + 1`` smallest ids, which is all that a list of ``k`` can hold of them;
equal queries are searched once.  Rows and queries meet as (block of rows, block
of queries), so a task holds one block of each whatever the table's size.

``SHARE`` 0.12 finds 0.95 of the true ten nearest among unclustered vectors of 64
components, where neighbours are hardest to tell apart.

Edge cases: vectors that are null, zero or hold null or non-finite components
take no part, and the others meet those of their own length; repeated rows count once,
an id repeated with another vector is a candidate per vector; ties go to the
smaller id; with fewer candidates than asked all are returned; an empty table
gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm.common import materialize
from likeness.llm.vectors import matrix, written_vectors

SAMPLE, PIVOTS, PREFIX = 1024, 128, 64
SHARE, LEAST = 0.12, 256
ROWS, QUERIES = 16384, 16384


def spread(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows, each the farthest from those taken before it."""
    taken, far = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(taken) < min(count, len(sample)) and far.max() > 0:
        taken.append(int(far.argmax()))
        far = np.minimum(far, ((sample - sample[taken[-1]]) ** 2).sum(axis=1))
    return sample[taken]


def prefixes(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Nearest pivots of each vector, nearest first, ties to the earlier one."""
    far = (pivots ** 2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(far, axis=1, kind="stable")[:, :prefix]


class Postings:
    """Inverted files of one block: per pivot, vectors and the pivot's place."""

    def __init__(self, near: np.ndarray, pivots: int):
        self.size, self.prefix = near.shape
        order = np.argsort(near.ravel(), kind="stable")
        self.row, self.place = np.divmod(order, self.prefix)
        self.start = np.searchsorted(near.ravel()[order], np.arange(pivots + 1))

    def saved(self, query: np.ndarray) -> np.ndarray:
        """Half of what each vector saves of the largest footrule distance."""
        out = np.zeros(self.size, np.int64)
        for place, pivot in enumerate(query):
            at = slice(self.start[pivot], self.start[pivot + 1])
            out[self.row[at]] += self.prefix - np.maximum(place, self.place[at])
        return out


def _search(ids, vectors, query_ids, queries, pivots, k, share):
    """(query, id, distance) of the ``k`` nearest reranked vectors per query."""
    prefix = min(PREFIX, len(pivots))
    files = Postings(prefixes(vectors, pivots, prefix), len(pivots))
    wanted = min(len(ids), max(LEAST, math.ceil(share * len(ids))))
    out: list[list] = [[], [], []]
    for q, vector, near in zip(query_ids, queries, prefixes(queries, pivots, prefix)):
        saved = files.saved(near)
        found = np.flatnonzero(saved >= np.partition(saved, len(ids) - wanted)[len(ids) - wanted])
        far = np.sqrt(((vectors[found] - vector) ** 2).sum(axis=1))
        best = np.lexsort((ids[found], far))[:k]
        out[0] += [q] * len(best)
        out[1] += ids[found][best].tolist()
        out[2] += far[best].tolist()
    return out


def nearest(rows: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
            share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row for
    which ``is_query`` (a condition on ``id``) holds, itself left out."""
    spark = rows.sparkSession
    all_rows = written_vectors(rows, id_col, vector_col)
    by_vector = Window.partitionBy("vec").orderBy("id")
    dim = F.size("vec").alias("dim")
    few = materialize(all_rows.withColumn("n", F.row_number().over(by_vector)).where(F.col("n") <= k + 1)
                      .withColumn("rep", F.min("id").over(Window.partitionBy("vec"))), "vector-groups")
    reps = few.where("n = 1").select("id", "vec", dim)
    asked = materialize(all_rows.where(is_query).groupBy("vec").agg(F.min("id").alias("query")).withColumn("dim", dim), "queries")
    members = few.select("rep", "id", dim)

    by_hash = Window.partitionBy("dim").orderBy("h", "id")
    taken = (reps.withColumn("h", F.xxhash64("id", F.lit(5))).withColumn("n", F.row_number().over(by_hash))
             .where(F.col("n") <= SAMPLE).orderBy("dim", "n"))
    sample: dict[int, list] = {}
    for r in taken.select("dim", "vec").collect():           # SAMPLE rows per length
        sample.setdefault(r.dim, []).append(r.vec)
    pivots = {n: spread(np.array(v), PIVOTS) for n, v in sample.items()}
    sizes = (reps.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / ROWS).cast("int").alias("blocks"))
             .join(asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts")), "dim"))
    sizes = F.broadcast(materialize(sizes, "lengths"))       # one row per length
    block = F.pmod(F.xxhash64("id", F.lit(6)), F.col("blocks")).cast("int")
    part = F.pmod(F.xxhash64("query", F.lit(7)), F.col("parts")).cast("int")
    left = reps.join(sizes, "dim").select("dim", block.alias("block"), F.explode(
        F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "id", "vec")
    right = asked.join(sizes, "dim").select("dim", F.explode(
        F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), part.alias("part"), "query", "vec")
    key = ["dim", "block", "part"]

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.float64())
        out: list[list] = [[], [], [], []]
        if index.num_rows and queries.num_rows:
            n = index.column("dim")[0].as_py()
            out = _search(index.column("id").to_numpy(), matrix(index.column("vec")), queries.column("query").to_pylist(),
                          matrix(queries.column("vec")), pivots[n], k + 1, share)
            out = [[n] * len(out[0]), *out]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["dim", "query", "rep", "score"])

    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(run, "dim int, query long, rep long, score double")
    by_query = Window.partitionBy("dim", "query").orderBy("score", "rep")
    best = met.withColumn("n", F.row_number().over(by_query)).where(F.col("n") <= k + 1).select("dim", "query", "rep", "score")
    # an id with several vectors can be the first of several groups: the vector tells them apart by distance
    wide = materialize(best.join(members.select("dim", "rep", F.col("id").alias("vec_id")), ["dim", "rep"])
                       .groupBy("dim", "query", "vec_id").agg(F.min("score").alias("score")), "found")
    ids = all_rows.where(is_query).join(asked, "vec").select("dim", "query", F.col("id").alias("query_id")).distinct()
    own = Window.partitionBy("query_id").orderBy("score", "vec_id")
    short = Window.partitionBy("dim", "query").orderBy("score", "vec_id")
    lists = wide.withColumn("n", F.row_number().over(short)).where(F.col("n") <= k + 1).drop("n")
    return (ids.join(lists, ["dim", "query"]).where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def q_nearest(rows: DataFrame) -> DataFrame:
    return nearest(rows, F.col("id") % 100 == 0)
