"""MinHash signatures and exact-copy groups (A3).

Plan shape:

* signatures: ``num_perm`` ``min`` aggregates per entity; ``min`` is
  idempotent, so duplicate interactions need no ``distinct``.  Long form:
  16-byte (entity, hash) rows are shuffled by entity (salted for entities
  above a row budget) and aggregated after the shuffle.  Row form (all items
  of an entity in one row): a map-only vectorized UDF, no shuffle.
* exact copies: entities with identical signatures collapse to one
  representative (the smallest id) before banding, so a group of m copies
  costs m rows, not m^2/2 pairs per band.
* pairs of representatives that share a band: see ``buckets``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.functions.hashing import (  # noqa: F401  (re-exported parameters)
    MERSENNE_PRIME,
    NUM_PERM,
    SEED,
    element_hash,
    minhash_params,
    wide_element_hash,
    wide_params,
    wide_permute,
)
from likeness.session import bounded_broadcast, materialize


# Fixed budget: rows of one entity aggregated by one task before it is split
# into salted slices.
HEAVY_ROWS = 5_000_000


def _slot_aggs(params, src: str = "h"):
    return [F.min((F.col(src) * F.lit(a) + F.lit(b)) % F.lit(MERSENNE_PRIME)).alias(f"s{i}")
            for i, (a, b) in enumerate(params)]


def signatures(df: DataFrame, entity: str = "user_id", item: str = "item",
               num_perm: int = NUM_PERM, seed: int = SEED,
               heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(id BIGINT, n BIGINT, sig ARRAY<BIGINT>) from long-form interactions.

    Slot i is the min over the entity's items of ``(a_i * h(item) + b_i) mod p``
    (set semantics: duplicates change nothing); ``n`` is the entity's row
    count (bag semantics, duplicates counted).

    Plan: the 16-byte (entity, hash) rows are shuffled by entity and each
    entity is aggregated completely after the shuffle - a map-side partial
    aggregate would ship one 1 KB partial signature per (entity, input
    partition), up to 64x the input for entities spread thin.  Entities with
    more than ``heavy_rows`` rows are found first (one cheap count); their rows
    are counted by item map-side, so that an item repeated a million times is one
    row per map task, and salted by item hash into ceil(n / heavy_rows) slices,
    so no task aggregates more than about ``heavy_rows`` rows; their few
    slice signatures are merged in a second aggregate.
    """
    params = minhash_params(num_perm, seed)
    _ensure_codegen_width(df.sparkSession, num_perm)
    hashed = df.select(F.col(entity).alias("id"), element_hash(F.col(item)).alias("h"))
    light, heavy = _light_and_heavy(hashed, heavy_rows)
    slices = (heavy.repartition("id", "salt").groupBy("id", "salt")
              .agg(F.sum("c").alias("_n"), *_slot_aggs(params)))
    merged = slices.groupBy("id").agg(
        F.sum("_n").alias("n"), *[F.min(f"s{i}").alias(f"s{i}") for i in range(num_perm)])
    wide = (light.repartition("id").groupBy("id").agg(F.count(F.lit(1)).alias("n"), *_slot_aggs(params))
            .unionByName(merged))
    return wide.select("id", "n",
                       F.array(*[F.col(f"s{i}") for i in range(num_perm)]).alias("sig"))


def _light_and_heavy(hashed: DataFrame, heavy_rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``hashed`` (id, h) of light entities, and those of heavy ones
    counted by item and spread over slices: (id, h, salt, c)."""
    counts = hashed.groupBy("id").agg(F.count(F.lit(1)).alias("_c"))
    heavy = materialize(counts.where(F.col("_c") > heavy_rows).select(
        "id", F.ceil(F.col("_c") / F.lit(heavy_rows)).cast("bigint").alias("_slices")), "heavy-entities")
    # at most rows / heavy_rows entries: broadcast under a checked size, else a shuffle join
    side = bounded_broadcast(heavy)
    split = hashed.join(side, "id").groupBy("id", "h").agg(
        F.count(F.lit(1)).alias("c"), F.first("_slices").alias("_slices"))
    return (hashed.join(side.select("id"), "id", "left_anti"),
            split.select("id", "h", (F.col("h") % F.col("_slices")).alias("salt"), "c"))


def wide_signatures(df: DataFrame, entity: str = "user_id", item: str = "item", num_perm: int = NUM_PERM,
                    seed: int = SEED, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(id, n, sig) like ``signatures``, over 60-bit element hashes and the
    modulus 2^61 - 1 (F3).  The rows of an entity meet sorted in one task, which
    folds them into one signature with numpy; the slices of a heavy entity are
    merged by the smallest value of each slot."""
    params = wide_params(num_perm, seed)
    hashed = df.select(F.col(entity).alias("id"), wide_element_hash(F.col(item)).alias("h"))

    def run(batches):
        last, n, least = None, 0, None
        for batch in batches:
            ids, salt, h, c = (batch.column(k).to_numpy() for k in range(4))
            start = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]) | (salt[1:] != salt[:-1])])
            made = np.empty((len(start), num_perm), np.int64)
            h = h.astype(np.uint64)
            for k, (a, b) in enumerate(params):
                made[:, k] = np.minimum.reduceat(wide_permute(h, a, b), start).astype(np.int64)
            sizes = np.add.reduceat(c, start)
            keys = list(zip(ids[start].tolist(), salt[start].tolist()))
            if last == keys[0]:                       # the last batch's entity goes on
                sizes[0] += n
                np.minimum(made[0], least, out=made[0])
            elif last is not None:
                yield _signature_rows([last[0]], [n], least[None, :])
            if len(keys) > 1:
                yield _signature_rows([i for i, _ in keys[:-1]], sizes[:-1], made[:-1])
            last, n, least = keys[-1], int(sizes[-1]), made[-1]
        if last is not None:
            yield _signature_rows([last[0]], [n], least[None, :])

    def folded(rows):
        return (rows.select("id", "salt", "h", "c").repartition("id", "salt").sortWithinPartitions("id", "salt")
                .mapInArrow(run, "id long, n long, sig array<long>"))

    one = F.lit(1).cast("bigint")
    light, heavy = _light_and_heavy(hashed, heavy_rows)
    merged = folded(heavy).groupBy("id").agg(F.sum("n").alias("n"), F.array(*[
        F.min(F.col("sig")[k]) for k in range(num_perm)]).alias("sig"))
    return folded(light.withColumn("salt", one - 1).withColumn("c", one)).unionByName(merged)


def _signature_rows(ids, sizes, made) -> pa.RecordBatch:
    flat = pa.array(made.ravel())
    offsets = pa.array(np.arange(0, made.size + 1, made.shape[1], dtype=np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, flat)],
        ["id", "n", "sig"])


def _ensure_codegen_width(spark, num_perm: int) -> None:
    # one aggregate with num_perm + 1 outputs: keep it inside whole-stage
    # codegen (the default field limit of 100 would drop it to the
    # interpreted path, ~1.5x slower)
    limit = int(spark.conf.get("spark.sql.codegen.maxFields", "100"))
    if limit < num_perm + 8:
        spark.conf.set("spark.sql.codegen.maxFields", str(num_perm + 8))


def signatures_of_rows(df: DataFrame, entity: str, items: str,
                       num_perm: int = NUM_PERM, seed: int = SEED,
                       vectorized: bool = True) -> DataFrame:
    """(id, n, sig) for tables holding each entity's items in ONE row
    (``items`` an array column, ``entity`` the table's key).

    The whole item set of an entity sits in one row, so no aggregate is
    needed: the element hashes are computed JVM-side, then an Arrow-batched
    pandas UDF evaluates the num_perm permutations with numpy - a map-only
    stage, no shuffle.  ``vectorized=False`` keeps everything in the JVM (an
    aggregate whose map side already holds each complete signature).
    ``n`` is the number of distinct items (the long-form row count); rows
    without items produce no signature, as in the long form.
    """
    hashed = (df.select(F.col(entity).alias("id"),
                        F.transform(F.array_distinct(F.col(items)),
                                    lambda x: element_hash(x)).alias("_hs"))
              .where(F.size("_hs") > 0))
    if vectorized:
        udf = _slots_udf(num_perm, seed)
        return hashed.select("id", F.size("_hs").cast("bigint").alias("n"),
                             udf("_hs").alias("sig"))
    params = minhash_params(num_perm, seed)
    _ensure_codegen_width(df.sparkSession, num_perm)
    # the set size is computed once per row, before the explode (a
    # projection next to the generator would be evaluated per exploded item)
    base = hashed.select("id", F.size("_hs").cast("bigint").alias("_n"),
                         F.explode("_hs").alias("h"))
    slots = [F.min((F.col("h") * F.lit(a) + F.lit(b)) % F.lit(MERSENNE_PRIME)).alias(f"s{i}")
             for i, (a, b) in enumerate(params)]
    wide = base.groupBy("id").agg(F.max("_n").alias("n"), *slots)
    return wide.select("id", "n",
                       F.array(*[F.col(f"s{i}") for i in range(num_perm)]).alias("sig"))


# elements per numpy block: CHUNK x num_perm int64 values in memory at once
CHUNK = 1 << 14


def _slots_udf(num_perm: int, seed: int):
    params = minhash_params(num_perm, seed)
    a = np.array([p[0] for p in params], dtype=np.int64)
    b = np.array([p[1] for p in params], dtype=np.int64)

    def block_mins(flat, starts):
        m = (flat[:, None] * a[None, :] + b[None, :]) % MERSENNE_PRIME
        return np.minimum.reduceat(m, starts, axis=0)

    @F.pandas_udf("array<bigint>")
    def slots(hs: pd.Series) -> pd.Series:
        rows = [np.asarray(x, dtype=np.int64) for x in hs]
        out = []
        i = 0
        while i < len(rows):
            if len(rows[i]) > CHUNK:  # one long row: fold its slices
                acc = None
                for s in range(0, len(rows[i]), CHUNK):
                    part = block_mins(rows[i][s:s + CHUNK], np.array([0]))[0]
                    acc = part if acc is None else np.minimum(acc, part)
                out.append(acc)
                i += 1
                continue
            j, total = i, 0
            while j < len(rows) and len(rows[j]) <= CHUNK and total + len(rows[j]) <= CHUNK:
                total += len(rows[j])
                j += 1
            lens = np.array([len(r) for r in rows[i:j]])
            starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
            out.extend(block_mins(np.concatenate(rows[i:j]), starts))
            i = j
        return pd.Series(out)

    return slots


def signatures_long(sig: DataFrame) -> DataFrame:
    """(id, perm, h) - one row per slot."""
    return sig.select("id", F.posexplode("sig").alias("perm", "h")).select(
        "id", F.col("perm").cast("bigint").alias("perm"), "h")


def _with_sig_key(sig: DataFrame) -> DataFrame:
    # 64-bit digest as an extra equality key: spreads the shuffle and makes the
    # join compare one long before the 128-slot array.
    return sig.withColumn("sig_key", F.xxhash64("sig"))


def signature_groups(sig: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact-copy groups.

    Returns ``(members, reps)``:
    members (id, n, group_id, group_size) - one row per entity;
    reps (group_id, sig) - one row per distinct signature.
    The grouping is a partial aggregate and the join back is an equi-join on
    the signature, so a group of copies holding a third of all entities is
    split over tasks (AQE skew join) instead of landing in one.
    """
    reps = group_reps(sig)
    return group_members(sig, reps), reps.select("group_id", "sig")


def group_reps(sig: DataFrame) -> DataFrame:
    """(sig_key, sig, group_id, group_size): one row per distinct signature."""
    return _with_sig_key(sig).groupBy("sig_key", "sig").agg(
        F.min("id").alias("group_id"), F.count(F.lit(1)).alias("group_size"))


def group_members(sig: DataFrame, reps: DataFrame) -> DataFrame:
    """(id, n, group_id, group_size) from ``group_reps`` output (pass it
    written, so the grouping runs once)."""
    return _with_sig_key(sig).join(reps, ["sig_key", "sig"]).select(
        "id", "n", "group_id", "group_size")
