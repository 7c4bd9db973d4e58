"""Near-duplicates by MinHash and a multi-index Hamming join (operator 7).

1. ``signatures`` (map-only): the set of a document's word shingles as 64-bit
   hashes, its digest, and a b-bit MinHash signature of ``CHUNKS`` x ``SLOTS``
   slots of 16 bits.
2. Documents with equal sets (equal digests) collapse to the smallest id, so a
   group of copies costs one signature however large it is.
3. The signature is split into chunks.  By pigeonhole, two signatures with at
   most ``RADIUS`` = 2 * CHUNKS - 1 differing slots have a chunk with at most
   one difference, so every chunk is posted once with each slot left out: all
   pairs within the radius share a key.  A pair at similarity 0.8 shares one
   with probability above 0.999997.
4. Links are confirmed on the full sets (100 * intersection >= threshold *
   union), in three passes; each reads only pairs whose ends the links so far
   leave in different components.  First every document against its least
   fellow member of any key, then every member of a key against the key's
   least member (both linear in a key's size), then the members of a key that
   are still apart against each other: the exact rest, all but empty for
   groups of near-copies of one document.  The members of such a key come with
   their signatures and a long sketch, and numpy compares them inside the task:
   only pairs of different components whose sketches allow a link leave it.  Keys
   that share documents meet as one family, a very large family key by key, each
   pair at the first key the two share; both are dealt as triangles of blocks.

Signatures and sketches set a pair aside only if they differ in more slots than
a pair at the threshold does with probability 1e-9 or so (``limit``);
``sketches=False`` confirms every pair that shares a key on the full sets.

Edge cases: a null or empty text, or one without words, has an empty set and
links with nothing (its component is itself); with fewer words than a shingle
the whole sequence is one shingle; rows repeating an id are one vertex; rows
with a null id are returned with a null component, and kept; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.common import arrow_map, fresh, materialize
from likeness.llm.graph import components
from likeness.operators.buckets import by_cell
from likeness.session import bounded_broadcast

WORDS, SIMILARITY = 4, 80          # shingle length and per cent of the query
CHUNKS, SLOTS = 12, 6              # 72 slots of 16 bits
RADIUS = 2 * CHUNKS - 1
LONG_SLOTS = 512                   # 8-bit slots of the long sketch
KNOWN_WORDS = 100_000              # words whose hashes one worker remembers
WHOLE_SET = 1024                   # shingles up to which a set travels with its sketch
SIGMAS = 6.4                       # see limit
FAMILY = 1 << 14                   # documents up to which a family of keys is one triangle of blocks
BLOCK = 2048                       # members of a block of a family or key
SLICE = 1 << 22                    # slot comparisons held in memory at once

_ODD = np.random.default_rng(42).integers(0, 2**63, CHUNKS * SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = np.random.default_rng(43).integers(0, 2**63, CHUNKS * SLOTS, dtype=np.uint64)
_LONG_ODD = np.random.default_rng(46).integers(0, 2**63, LONG_SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LONG_ADD = np.random.default_rng(47).integers(0, 2**63, LONG_SLOTS, dtype=np.uint64)


class _WordHashes(dict):
    def __missing__(self, word):
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES = _WordHashes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text; words are
    split at ASCII white space, A-Z lower-cased."""
    if len(_HASHES) > KNOWN_WORDS:
        _HASHES.clear()
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(_HASHES.__getitem__, parts), np.uint64, len(parts))
    n = max(1, len(one) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(one))):
        out = _mix(out + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2**64) + one[k:k + n])
    return np.unique(out)


def _least(found: np.ndarray, odd: np.ndarray, add: np.ndarray) -> np.ndarray:
    least = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 2048):
        part = found[at:at + 2048]
        h = part[None, :] * odd[:, None] + add[:, None]
        np.minimum(least, (h ^ (h >> np.uint64(32))).min(axis=1), out=least)
    return _mix(least)


def signature(found: np.ndarray) -> np.ndarray:
    """16-bit MinHash slots of a non-empty set, in slices of bounded memory."""
    return (_least(found, _ODD, _ADD) & np.uint64(0xFFFF)).astype("<u2")


def long_sketch(found: np.ndarray) -> np.ndarray:
    """8-bit MinHash slots of a non-empty set."""
    return (_least(found, _LONG_ODD, _LONG_ADD) & np.uint64(0xFF)).astype(np.uint8)


def limit(slots: int, similarity: int) -> int:
    """Slots in which a pair at the threshold still differs, all but surely."""
    share = similarity / 100
    return int(slots * (1 - share) + SIGMAS * (slots * share * (1 - share)) ** 0.5)


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, digest, sig) per row; digest and sig are null for
    an empty set."""
    names = ["doc_id", "n_shingles", "digest", "sig"]

    def run(batch):
        out: list[list] = [[], [], [], []]
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = shingles(text, words)
            full = len(found) > 0
            row = (doc_id, len(found), hashlib.blake2b(found.tobytes(), digest_size=16).digest() if full else None,
                   signature(found).tobytes() if full else None)
            for column, value in zip(out, row):
                column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))], names)

    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return arrow_map(source, run, "doc_id long, n_shingles long, digest binary, sig binary")


_WEIGHT = np.random.default_rng(44).integers(0, 2**63, (CHUNKS, SLOTS), dtype=np.uint64) | np.uint64(1)
_SALT = np.random.default_rng(45).integers(0, 2**63, (CHUNKS, SLOTS), dtype=np.uint64)


def _keys_of(sig: np.ndarray) -> np.ndarray:
    """The keys of each signature: (rows, CHUNKS * SLOTS)."""
    each = _mix(sig.reshape(-1, CHUNKS, SLOTS).astype(np.uint64) + _SALT) * _WEIGHT
    return _mix(each.sum(axis=2, dtype=np.uint64)[:, :, None] - each + _SALT).reshape(len(sig), -1).view(np.int64)


def chunk_keys(reps: DataFrame) -> DataFrame:
    """(key, id): per representative and chunk, one key per slot left out."""
    def run(batch):
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), "<u2").reshape(-1, CHUNKS * SLOTS)
        ids = np.repeat(batch.column("id").to_numpy(), CHUNKS * SLOTS)
        yield pa.RecordBatch.from_arrays([pa.array(_keys_of(sig).ravel()), pa.array(ids)], ["key", "id"])

    return arrow_map(reps.select("id", "sig"), run, "key long, id long")


def _near(pairs: DataFrame, reps: DataFrame, similarity: int, sketches: bool = True) -> DataFrame:
    """Distinct pairs whose sizes and signatures allow a link.  Joins carry
    the short signatures, never texts."""
    sketch = reps.select("id", "n", "sig")
    most = limit(CHUNKS * SLOTS, similarity) if sketches else CHUNKS * SLOTS

    def run(batch):
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                for c in ("sig1", "sig2"))
        yield batch.filter(pa.array((a != b).sum(axis=1) <= most)).select(["id1", "id2"])

    sized = (pairs.select("id1", "id2").distinct()
             .join(sketch.toDF("id1", "n1", "sig1"), "id1").join(sketch.toDF("id2", "n2", "sig2"), "id2")
             .where(F.least("n1", "n2") * 100 >= F.greatest("n1", "n2") * similarity))
    return arrow_map(sized.select("id1", "id2", "sig1", "sig2"), run, "id1 long, id2 long")


def _confirmed(pairs: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """The pairs whose whole texts' sets are similar enough.  Texts of the
    documents in question alone are shuffled, once per side; a document in very
    many pairs is split by the adaptive skew join."""
    def run(batch):
        keep, cache = [], {}

        def of(i, text):
            if i not in cache:
                if len(cache) > 256:
                    cache.clear()
                cache[i] = shingles(text, words)
            return cache[i]

        for i, j, s, t in zip(*(batch.column(c).to_pylist() for c in ("id1", "id2", "text1", "text2"))):
            a, b = of(i, s), of(j, t)
            both = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * both >= similarity * (len(a) + len(b) - both))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["id1", "id2"])

    texts = docs.select("id", "text")
    met = (pairs.join(texts.toDF("id1", "text1"), "id1").join(texts.toDF("id2", "text2"), "id2")
           .select("id1", "id2", "text1", "text2"))
    return arrow_map(met, run, "id1 long, id2 long")


def _links(near: DataFrame, docs: DataFrame, words: int, similarity: int) -> DataFrame:
    """The links among ``near`` pairs.  The ids asked for are broadcast against the
    texts only while they are few (a checked count); else the texts shuffle."""
    near = materialize(near, "near-pairs")
    return _confirmed(near, _asked(near, docs), words, similarity)


def _asked(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    ids = materialize(pairs.select(F.col("id1").alias("id")).union(pairs.select("id2")).distinct(), "asked")
    return docs.join(bounded_broadcast(ids), "id", "left_semi")


def _apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs whose ends have different components (an id without one is its own)."""
    return (pairs.join(label.toDF("id1", "c1"), "id1", "left").join(label.toDF("id2", "c2"), "id2", "left")
            .where("coalesce(c1, id1) <> coalesce(c2, id2)").select("id1", "id2"))


def _sketched(ids: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(id, sketch, whole_set) of the given documents; a long set is null."""
    def run(batch):
        sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array([long_sketch(x).tobytes() for x in sets], pa.binary()),
             pa.array([x.tobytes() if len(x) <= WHOLE_SET else None for x in sets], pa.binary())],
            ["id", "sketch", "whole_set"])

    return arrow_map(docs.join(bounded_broadcast(ids), "id", "left_semi").select("id", "text"), run,
                     "id long, sketch binary, whole_set binary")


def _linked(sets: list, x: np.ndarray, y: np.ndarray, similarity: int) -> np.ndarray:
    """Whether the sets (sorted) of rows ``x`` and ``y`` are similar enough; ``x``
    ascends, and all partners of one row are compared with it at once."""
    out = np.zeros(len(x), bool)
    cuts = np.flatnonzero(np.r_[True, x[1:] != x[:-1], True]) if len(x) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        own, others = sets[x[a]], [sets[k] for k in y[a:b]]
        size = np.fromiter(map(len, others), np.int64, b - a)
        flat = np.concatenate(others)
        at = np.minimum(np.searchsorted(own, flat), len(own) - 1)
        both = np.add.reduceat((own[at] == flat).astype(np.int64), np.cumsum(size) - size)
        out[a:b] = 100 * both >= similarity * (len(own) + size - both)
    return out


def cells(members: DataFrame, block: int = BLOCK) -> DataFrame:
    """``members`` (key, id) once per cell they take part in: of a key's members,
    dealt to blocks of about ``block``, each pair of blocks is a cell (low, high);
    ``side`` is 1 for those of the higher block."""
    sizes = members.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (members.join(sizes, "key").withColumn("own", own).withColumn("other", other)
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
            .withColumn("side", (F.col("own") > F.col("other")).cast("int")).drop("blocks", "own", "other"))


def _meet(rows: pa.Table, most: int, most_long: int, similarity: int):
    """Slices of (id1, id2, sure): the cell's pairs of different components that
    share a key and whose sketches allow a link; in the cell of one key, those that
    this key is the first to bring together.  Pairs of whole sets are links
    (``sure``), the others are to be confirmed."""
    matrix = lambda c, t: np.frombuffer(b"".join(rows.column(c).to_pylist()), t).reshape(rows.num_rows, -1)
    ids, comp, n = (rows.column(c).to_numpy() for c in ("id", "component", "n"))
    sig, sketch = matrix("sig", "<u2"), matrix("sketch", np.uint8)
    sets = [None if x is None else np.frombuffer(x, np.uint64) for x in rows.column("whole_set").to_pylist()]
    short = np.array([x is not None for x in sets])
    place = None if rows.column("whole")[0].as_py() else int(
        np.flatnonzero(_keys_of(sig[:1])[0] == rows.column("key")[0].as_py())[0])
    if rows.column("low")[0].as_py() == rows.column("high")[0].as_py():
        # pairs inside the largest component are linked already: its members are met, but meet nobody
        names, at, size = np.unique(comp, return_inverse=True, return_counts=True)
        few, right = np.flatnonzero(at != size.argmax()), np.arange(len(ids))
        once = np.full(len(ids), -1)
        once[few] = few
    else:
        side = rows.column("side").to_numpy()
        few, right, once = np.flatnonzero(side == 0), np.flatnonzero(side == 1), None
    step = max(1, SLICE // (CHUNKS * SLOTS * max(1, len(right))))
    for a in range(0, len(few), step):
        left = few[a:a + step]
        ok = comp[left][:, None] != comp[right][None, :]
        if once is not None:
            ok &= (once[right] < 0)[None, :] | (left[:, None] < right[None, :])
        low, high = (f(n[left][:, None], n[right][None, :]) for f in (np.minimum, np.maximum))
        ok &= low * 100 >= high * similarity
        i, j = np.nonzero(ok)
        if not len(i):
            continue
        i, j = left[i], right[j]
        for b in range(0, len(i), SLICE // LONG_SLOTS):
            x, y = i[b:b + SLICE // LONG_SLOTS], j[b:b + SLICE // LONG_SLOTS]
            differs = sig[x] != sig[y]
            chunk = differs.reshape(len(x), CHUNKS, SLOTS)
            near = chunk.sum(axis=2) <= 1
            own = near.any(axis=1) & (differs.sum(axis=1) <= most)
            if place is not None:
                first = near.argmax(axis=1)
                hit = chunk[np.arange(len(x)), first]
                own &= first * SLOTS + np.where(hit.any(axis=1), hit.argmax(axis=1), 0) == place
            x, y = x[own], y[own]
            close = (sketch[x] != sketch[y]).sum(axis=1) <= most_long
            x, y = x[close], y[close]
            sure = short[x] & short[y]
            keep = ~sure
            keep[sure] = _linked(sets, x[sure], y[sure], similarity)
            x, y = x[keep], y[keep]
            yield np.minimum(ids[x], ids[y]), np.maximum(ids[x], ids[y]), sure[keep]


def families(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``members`` (key, id, component) as rows for ``cells``.  Keys that share
    documents form a family: first those of families up to ``FAMILY`` documents,
    every document once under its family's least id, then those of larger ones,
    under each of their keys.  Near copies of one text share dozens of keys, so
    the first form carries a document once instead of dozens of times."""
    hubs = members.groupBy("key").agg(F.min("id").alias("hub"))
    family = materialize(components(members.join(hubs, "key").select("hub", "id"), "hub", "id")
                         .toDF("id", "family"), "families")
    large = (family.groupBy("family").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > FAMILY)
             .select("family"))
    small = family.join(bounded_broadcast(materialize(large, "large-families")), "family", "left_anti")
    whole = members.select("id", "component").distinct().join(small, "id").select(
        F.col("family").alias("key"), "id", "component", F.lit(True).alias("whole"))
    return whole, members.join(small.select("id"), "id", "left_anti").select(
        "key", "id", "component", F.lit(False).alias("whole"))


def _across(members: DataFrame, reps: DataFrame, docs: DataFrame, words: int, similarity: int,
            sketches: bool = True) -> DataFrame:
    """(id1, id2, sure): pairs of members (key, id, component) of one key in
    different components that are (``sure``) or may be linked, each once."""
    ids = materialize(members.select("id").distinct(), "mixed-ids")
    known = materialize(reps.select("id", "n", "sig").join(_sketched(ids, docs, words), "id"), "mixed-sketches")
    most, most_long = ((limit(CHUNKS * SLOTS, similarity), limit(LONG_SLOTS, similarity)) if sketches
                       else (CHUNKS * SLOTS, LONG_SLOTS))
    order = ["key", "low", "high"]

    def run(batches):
        for rows in by_cell(batches, order):
            for a, b, sure in _meet(rows, most, most_long, similarity):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(sure)], ["id1", "id2", "sure"])

    def met(rows):
        return (cells(rows).join(known, "id").repartition(*order).sortWithinPartitions(*order)
                .select(*order, "side", "id", "component", "whole", "n", "sig", "sketch", "whole_set")
                .mapInArrow(run, "id1 long, id2 long, sure boolean"))

    whole, single = families(members)
    return met(whole).unionByName(met(single))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    similarity: int = SIMILARITY, sketches: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per distinct id."""
    found = materialize(signatures(docs, id_col, text_col, words), "signatures")
    sets = found.where("doc_id is not null and digest is not null")
    reps = materialize(sets.groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n")), "set-groups")
    # an id repeated with another text stands for several sets: they are one vertex
    several = (sets.groupBy("doc_id").agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
               .where("low <> high").select("doc_id"))
    shared = (sets.join(several, "doc_id", "left_semi").join(reps.select("digest", "id"), "digest")
              .select(F.col("doc_id").alias("id1"), F.col("id").alias("id2")).distinct())
    # an id that repeats brings all its texts: links of any of them are its own
    source = docs.where(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))

    keys = materialize(chunk_keys(reps), "chunk-keys")
    hubs = keys.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub <> last")
    members = materialize(keys.join(hubs.select("key", "hub"), "key"), "key-members")

    # each pass reads only pairs whose ends still lie in different components
    spokes = members.where("id <> hub").select(F.col("hub").alias("id1"), F.col("id").alias("id2"))
    first = spokes.groupBy("id2").agg(F.min("id1").alias("id1")).select("id1", "id2")
    links = materialize(shared.union(_links(_near(first, reps, similarity, sketches), source, words, similarity)), "links-1")
    label = materialize(components(links, "id1", "id2"), "labels-1")

    second = _apart(spokes.distinct().join(first, ["id1", "id2"], "left_anti"), label)
    links = materialize(links.union(_links(_near(second, reps, similarity, sketches), source, words, similarity)), "links-2")
    label = materialize(components(links, "id1", "id2"), "labels-2")

    placed = (members.join(label, "id", "left")
              .select("key", "id", "hub", F.coalesce("component", "id").alias("component")))
    mixed = (placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low <> high").select("key"))
    apart = materialize(placed.join(mixed, "key", "left_semi").select("key", "id", "component"), "mixed-keys")
    third = materialize(_across(apart, reps, source, words, similarity, sketches), "across")
    open_ = _links(third.where("not sure").select("id1", "id2"), source, words, similarity)
    links = materialize(links.union(third.where("sure").select("id1", "id2")).union(open_), "links-3")
    whole = materialize(components(links, "id1", "id2"), "labels-3")

    vertices = found.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("digest").alias("digest"))
    rep = vertices.join(reps.select("digest", "id"), "digest", "left")
    named = rep.join(whole, "id", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id"))
        .alias("component_id"))
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
             similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` without all but one of each group: the smallest id
    stays, and of rows repeating an id the one whose JSON text is smallest.  Rows
    without an id cannot be named as anyone's copy and stay."""
    name = fresh(docs, "near_id")
    found = near_duplicates(docs, id_col, text_col, words, similarity)
    gone = found.where("doc_id is not null and not kept").select(F.col("doc_id").alias(name))
    rows = docs.withColumn(name, F.col(f"`{id_col}`").cast("bigint")).join(gone, name, "left_anti")
    again = (docs.select(F.col(f"`{id_col}`").cast("bigint").alias(name)).where(F.col(name).isNotNull())
             .groupBy(name).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(name))
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    least = (rows.join(again, name, "left_semi").groupBy(name)
             .agg(F.min_by(whole, F.to_json(whole)).alias("row")).select("row.*"))
    return rows.join(again, name, "left_anti").drop(name).unionByName(least)
