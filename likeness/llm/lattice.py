"""Near-duplicate vectors by lattice hashing (operator 10).

1. Each vector is read once for a digest, a sign sketch and its cells; equal
   digests collapse to the smallest id with their number.  Vectors themselves
   never move but those of a pair whose sketches allow a link.
2. In each of a few tables a vector's direction is projected at random to
   twice eight dimensions, scaled and shifted, and each half is decoded to its
   nearest point of the E8 lattice; the pair of points is its cell.
3. A cell's smallest id is a hub.  A vector joins the class of the smallest hub
   it meets with a cosine of at least ``INNER`` (verified in double precision).
   Half the angle of ``THRESHOLD`` is more than ``INNER``'s, so by the triangle
   inequality all members of one class are linked: a large group of near copies
   is linked in full without a single pair being written.
4. Vectors of different classes meet by probing: each is posted under its own cell
   and asks that cell and the two in which one half is replaced by its next-nearest
   lattice point.  A task compares the 128-bit sign sketches of those that meet
   (a pair at the threshold differs in 18 bits on average, sd 4; ``SKETCH_BITS``
   may differ, which one pair in two thousand exceeds) and lets only the pairs within them out; then the cosine of the
   original vectors decides.

Disk against comparisons: tables are rows to shuffle, large cells are comparisons
of two words in memory.  So a table of vectors gets few tables with large cells
(``RUNGS``): what is written per vector does not grow up to two million vectors,
where a vector is compared with about one in fifteen of the others.

Hot cells are dealt as blocks of about ``CELL`` vectors, each met by all probes
of the cell, which stream past it.  A pair at cosine 0.90 is missed with
probability 0.008, at 0.92 0.003, at 0.95 below 0.0005, in a table of any size.

Edge cases: vectors that are null, zero or hold null or non-finite components
link with nothing and are their own component; vectors of different lengths
share no cell and do not link; repeated rows count once, as does an id repeated with another vector
(its smallest vector stands for it); rows without an id are left out; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.common import arrow_map, materialize, release_memory
from likeness.llm.graph import components
from likeness.llm.vectors import by_length, matrix, usable
from likeness.session import bounded_broadcast

THRESHOLD, INNER = 0.9, 0.9752        # cos(acos(0.9) / 2) = 0.97468
# (vectors up to, scale of the projections, tables).  A larger scale makes smaller
# cells; the tables hold the chance that a pair at cosine 0.90 shares a probed cell
# at 0.99 at every size: it does not fall as a table grows.  One setting serves up to
# two million vectors; beyond, smaller cells in more tables bound the comparisons.
SETTING = (0.28, 6)
RUNGS = (*((most, *SETTING) for most in (100, 200, 300, 400, 2_000_000)),
         (6_000_000, 0.34, 9), (20_000_000, 0.4, 12), (200_000_000, 0.5, 23), (None, 0.6, 44))
SKETCH_BITS = 32
CELL = 4096
SLICE = 1 << 18                # sketch comparisons held in memory at once


def _checkerboard(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest integer points with an even sum, and the rounding errors."""
    near = np.rint(x)
    gap = x - near
    worst = np.abs(gap).argmax(axis=1)[:, None]
    odd = (near.sum(axis=1).astype(np.int64) & 1)[:, None]
    turn = np.where(np.take_along_axis(gap, worst, 1) >= 0, 1.0, -1.0) * odd
    np.put_along_axis(near, worst, np.take_along_axis(near, worst, 1) + turn, 1)
    return near, x - near


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8 (integers, or integers and a half, with even sum)."""
    whole, gap = _checkerboard(x)
    half, gap_half = _checkerboard(x - 0.5)
    closer = ((gap ** 2).sum(axis=1) <= (gap_half ** 2).sum(axis=1))[:, None]
    return np.where(closer, whole, half + 0.5)


def next_nearest(x: np.ndarray, home: np.ndarray) -> np.ndarray:
    """The best of the cells on the far side of the two most likely walls: the
    point reflected a little beyond the home cell is decoded again."""
    gap = x - home
    size = np.sqrt((gap ** 2).sum(axis=1, keepdims=True))
    beyond = decode(home + gap / np.maximum(size, 1e-12) * 1.01)
    # straight out may end at home again (a deep hole's direction): step along the two largest errors
    order = np.argsort(-np.abs(gap), axis=1)[:, :2]
    step = np.zeros_like(gap)
    np.put_along_axis(step, order, np.where(np.take_along_axis(gap, order, 1) >= 0, 1.0, -1.0), 1)
    root = home + step
    same = (beyond == home).all(axis=1)
    nearer = ((x - root) ** 2).sum(axis=1) < ((x - beyond) ** 2).sum(axis=1)
    return np.where((same | nearer)[:, None], root, beyond)


def _keys(points: np.ndarray, factors: np.ndarray) -> np.ndarray:
    whole = np.rint(points * 2).astype(np.int64).astype(np.uint64)
    h = (whole * factors).sum(axis=1, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def rung(n: int) -> tuple[float, int]:
    """(scale, tables) for ``n`` distinct vectors."""
    return next((scale, tables) for most, scale, tables in RUNGS if most is None or n <= most)


def cells(vectors: np.ndarray, scale: float = RUNGS[0][1], tables: int = RUNGS[0][2],
          seed: int = 31) -> tuple[np.ndarray, np.ndarray]:
    """(own cell, probed cells) of each unit vector: n x tables, n x tables x 3."""
    rng = np.random.default_rng(seed)
    n, dim = vectors.shape
    own, asked = np.empty((n, tables), np.uint64), np.empty((n, tables, 3), np.uint64)
    for t in range(tables):
        turn, shift = rng.normal(size=(dim, 16)) * scale, rng.uniform(0, 1, 16)
        factors = rng.integers(0, 2**63, 16, dtype=np.uint64) | np.uint64(1)
        x = vectors @ turn + shift
        a, b = decode(x[:, :8]), decode(x[:, 8:])
        ha, hb = _keys(a, factors[:8]), _keys(b, factors[8:])
        oa, ob = _keys(next_nearest(x[:, :8], a), factors[:8]), _keys(next_nearest(x[:, 8:], b), factors[8:])
        salt = np.uint64(t + 1) * np.uint64(0x9E3779B97F4A7C15 & (2**60 - 1))
        mix = np.uint64(0x94D049BB133111EB)
        own[:, t] = (ha * mix + hb) ^ salt
        asked[:, t] = np.stack([own[:, t], (oa * mix + hb) ^ salt, (ha * mix + ob) ^ salt], axis=1)
    return own, asked


def _sketch(unit: np.ndarray) -> np.ndarray:
    planes = np.random.default_rng(32).normal(size=(unit.shape[1], 128))
    return np.packbits(unit @ planes > 0, axis=1).view(np.int64)


def _hashed(good: DataFrame) -> DataFrame:
    """(id, d1, d2, own, asked, s1, s2) per vector: its digest, cells (``asked``
    without its own) and sketch."""
    cell = pa.list_(pa.int64())
    scale, tables = rung(good.count())

    def run(whole):
        for batch in by_length(whole, "vec"):
            yield hashed(batch)

    def hashed(batch):
        x = matrix(batch.column("vec")) + 0.0          # -0.0 equals 0.0
        digest = np.frombuffer(b"".join(hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in x), np.int64)
        digest = digest.reshape(-1, 2)
        # scaled first: squares of very large or small components stay finite
        x = x / np.abs(x).max(axis=1, keepdims=True)
        unit = x / np.sqrt((x ** 2).sum(axis=1, keepdims=True))
        length = np.uint64(x.shape[1] * 0x9E3779B97F4A7C15 % 2**64)
        own, asked = (c ^ length for c in cells(unit, scale, tables))
        sketch = _sketch(unit)
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array(list(own.view(np.int64)), cell),
             pa.array(list(np.ascontiguousarray(asked[:, :, 1:]).reshape(len(x), -1).view(np.int64)), cell),
             pa.array(sketch[:, 0]), pa.array(sketch[:, 1])], ["id", "d1", "d2", "own", "asked", "s1", "s2"])

    return arrow_map(good.select("id", "vec"), run,
                     "id long, d1 long, d2 long, own array<long>, asked array<long>, s1 long, s2 long")


def _cosines(pairs: DataFrame, good: DataFrame) -> DataFrame:
    """(id1, id2, cosine) in double precision on the original vectors; ``pairs``
    is written.  Only the vectors of its ids are joined."""
    def run(whole):
        for batch in by_length(whole, "v1"):
            yield cosines(batch)

    def cosines(batch):
        a, b = matrix(batch.column("v1")), matrix(batch.column("v2"))
        # a power of two changes no digit: squares of very large or small components stay finite
        a, b = (x / 2.0 ** np.ceil(np.log2(np.abs(x).max(axis=1, keepdims=True))) for x in (a, b))
        cos = (a * b).sum(axis=1) / np.sqrt((a * a).sum(axis=1) * (b * b).sum(axis=1))
        return pa.RecordBatch.from_arrays([batch.column("id1"), batch.column("id2"), pa.array(cos)], ["id1", "id2", "cosine"])

    needed = materialize(pairs.select(F.col("id1").alias("id")).union(pairs.select("id2")).distinct(), "paired-ids")
    v = good.select("id", "vec").join(bounded_broadcast(needed), "id", "left_semi")
    met = pairs.join(v.toDF("id1", "v1"), "id1").join(v.toDF("id2", "v2"), "id2").where("size(v1) = size(v2)")
    return arrow_map(met.select("id1", "id2", "v1", "v2"), run, "id1 long, id2 long, cosine double")


def _classes(hashed: DataFrame, good: DataFrame) -> DataFrame:
    """(id, class) of the vectors that join a hub."""
    home = hashed.select(F.explode("own").alias("cell"), "id", "s1", "s2")
    hub = home.groupBy("cell").agg(F.min(F.struct("id", "s1", "s2")).alias("hub"), F.max("id").alias("last")).where(
        "hub.id <> last")
    bits = F.bit_count(F.col("s1").bitwiseXOR(F.col("hub.s1"))) + F.bit_count(F.col("s2").bitwiseXOR(F.col("hub.s2")))
    first = (home.join(hub, "cell").where((F.col("id") != F.col("hub.id")) & (bits <= SKETCH_BITS))
             .groupBy(F.col("id").alias("id2")).agg(F.min("hub.id").alias("id1")))
    joined = _cosines(materialize(first.select("id1", "id2"), "hub-pairs"), good).where(F.col("cosine") >= INNER)
    return materialize(joined.select(F.col("id2").alias("id"), F.col("id1").alias("class")), "classes")


def _meetings(batches):
    """Pairs of different classes whose sketches allow a link, from rows sorted by
    (cell, block, asks).  A block's posted vectors are held; those that ask
    stream past them.  Where a cell is one block, the posted ask each other."""
    held, last, single = [], None, False

    def compared(asking, posted):
        ids, classes, s1, s2 = posted
        step = max(1, SLICE // max(1, len(ids)))
        for at in range(0, len(asking[0]), step):
            i, c, a1, a2 = (x[at:at + step] for x in asking)
            bits = np.bitwise_count(a1[:, None] ^ s1) + np.bitwise_count(a2[:, None] ^ s2)
            p, q = np.nonzero(bits <= SKETCH_BITS)
            other = c[p] != classes[q]
            x, y = i[p[other]], ids[q[other]]
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["id1", "id2"])

    def block():
        return [np.concatenate(c) for c in zip(*held)]

    posted = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cell, at, asks, blocks, ids, classes, s1, s2 = (batch.column(k).to_numpy() for k in range(8))
        new = (cell[1:] != cell[:-1]) | (at[1:] != at[:-1]) | (asks[1:] != asks[:-1])
        cuts = np.r_[0, np.flatnonzero(new) + 1, batch.num_rows]
        values = ids, classes, s1.view(np.uint64), s2.view(np.uint64)
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            key = cell[lo], at[lo]
            if key != last:
                if posted is None and held and single:        # nobody else asked
                    posted = block()
                    if len(posted[0]) > 1:
                        yield from compared(posted, posted)
                held, last, single, posted = [], key, blocks[lo] == 1, None
            part = [x[lo:hi] for x in values]
            if not asks[lo]:
                held.append(part)
            elif held:
                if posted is None:
                    posted = block()
                    if single and len(posted[0]) > 1:
                        yield from compared(posted, posted)
                yield from compared(part, posted)
    if posted is None and held and single:
        posted = block()
        yield from compared(posted, posted)
    release_memory()


def _meeting_pairs(hashed: DataFrame, classes: DataFrame) -> DataFrame:
    """(id1, id2) of vectors of different classes that meet in a probed cell, with
    sketches that allow a link."""
    known = hashed.join(bounded_broadcast(classes), "id", "left").select(
        "id", F.coalesce("class", "id").alias("class"), "s1", "s2", "own", "asked")
    large = materialize(hashed.select(F.explode("own").alias("cell")).groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / CELL).cast("int").alias("blocks")).where("blocks > 1"), "large-cells")
    blocks = F.coalesce("blocks", F.lit(1))
    posted = known.select(F.explode("own").alias("cell"), "id", "class", "s1", "s2").join(
        bounded_broadcast(large), "cell", "left").withColumn("blocks", blocks)
    asked = known.select(F.explode("asked").alias("cell"), "id", "class", "s1", "s2").join(
        bounded_broadcast(large), "cell", "left").withColumn("blocks", blocks)
    # a large cell's own vectors ask all its blocks as well
    asked = asked.union(posted.where("blocks > 1").select(*asked.columns)).select(
        "cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(1).alias("asks"),
        "blocks", "id", "class", "s1", "s2")
    home = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    rows = posted.select("cell", home.alias("block"), F.lit(0).alias("asks"), "blocks", "id", "class", "s1", "s2").union(asked)
    return (rows.repartition("cell", "block").sortWithinPartitions("cell", "block", "asks")
            .mapInArrow(_meetings, "id1 long, id2 long").distinct())


def vector_links(hashed: DataFrame, good: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((id, class) of the vectors in a class of another id, links between vectors
    of different classes)."""
    classes = _classes(hashed, good)
    near = materialize(_meeting_pairs(hashed, classes), "near-vectors")
    return classes, materialize(_cosines(near, good).where(F.col("cosine") >= THRESHOLD), "vector-links")


def _one_per_id(rows: DataFrame) -> DataFrame:
    """(id, vec), the smallest vector of an id with several.  Only their rows move."""
    several = materialize(rows.groupBy("id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("id"), "repeated-ids")
    side = bounded_broadcast(several)
    return rows.join(side, "id", "left_anti").union(
        rows.join(side, "id", "left_semi").groupBy("id").agg(F.min("vec").alias("vec")))


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) per distinct id."""
    good = _one_per_id(usable(rows, id_col, vector_col, widen=False))
    every = materialize(_hashed(good), "cells")
    groups = every.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    groups = materialize(groups, "vector-groups")
    copied = materialize(every.select("id", "d1", "d2").join(groups, ["d1", "d2"]).select("id", "rep", "copies"), "copies")
    hashed = every.join(bounded_broadcast(copied.where("id <> rep").select("id")), "id", "left_anti")
    classes, across = vector_links(hashed, good)
    named = materialize(
        hashed.select("id").join(classes, "id", "left")
        .join(copied.where("id = rep").select("id", "copies"), "id", "left")
        .select("id", F.coalesce("class", "id").alias("class"), F.coalesce("copies", F.lit(1)).alias("copies")), "named")
    sizes = named.groupBy("class").agg(F.sum("copies").alias("size"))
    copies = named.select("id", "copies")
    beside = (across.select("id1", "id2").union(across.select("id2", "id1")).toDF("id", "other")
              .join(copies.toDF("other", "copies"), "other").groupBy("id").agg(F.sum("copies").alias("beside")))
    whole = components(classes.select(F.col("id").alias("id1"), F.col("class").alias("id2"))
                       .union(across.select("id1", "id2")), "id1", "id2")
    found = materialize(
        named.join(sizes, "class").join(beside, "id", "left").join(whole, "id", "left")
        .select("id", (F.col("size") - 1 + F.coalesce("beside", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component_id")), "vector-result")
    ids = rows.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id")).where("vec_id is not null").distinct()
    out = (ids.join(copied.select(F.col("id").alias("vec_id"), "rep"), "vec_id", "left")
           .withColumn("rep", F.coalesce("rep", "vec_id"))
           .join(found.withColumnRenamed("id", "rep"), "rep", "left"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))
