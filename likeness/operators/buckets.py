"""Pairs of signatures that agree on a span of slots.

A signature is posted under every span; the members of one span value are a
bucket.  Buckets of one member leave before any signature moves.  A bucket of
more than ``BLOCK`` members is cut into blocks, and a task gets one cell of the
triangle block x block: no task sees a whole large bucket.  Inside a cell numpy
compares all slots of its pairs; a pair belongs to the first span it agrees on,
so a pair met in several buckets is counted once without a shuffle of pairs.

What leaves a cell is decided by a reducer that runs in the task:

* ``all_pairs``: the scored pairs themselves (a result as large as it is);
* ``histogram``: expanded pairs per threshold and score, at most
  thresholds x (slots + 1) rows per task;
* ``best``: the ``k`` leading pairs per threshold, at most thresholds x k rows
  per task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.functions.hashing import NUM_BANDS, NUM_PERM, ROWS_PER_BAND
from likeness.session import materialize

BLOCK = 2048                   # members of a block; a cell holds two
MOST_TASKS = 20_000            # tasks that cells are dealt to, each two blocks of members or more
SLICE = 1 << 22                # slot comparisons held in memory at once
BANDS = tuple((ROWS_PER_BAND * j, ROWS_PER_BAND) for j in range(NUM_BANDS))
CELL = ["band", "key", "low", "high"]


def equal_spans(parts: int, slots: int = NUM_PERM) -> tuple[tuple[int, int], ...]:
    """``parts`` adjacent spans that cover all slots: signatures that differ in
    fewer than ``parts`` slots agree on one of them."""
    cuts = [slots * i // parts for i in range(parts + 1)]
    return tuple((a, b - a) for a, b in zip(cuts, cuts[1:]))


def bucket_members(reps: DataFrame, spans=BANDS, block: int = BLOCK) -> DataFrame:
    """(band, key, low, high, side, id): the members of buckets of two or more,
    once per cell they take part in.  ``key`` is a digest of the span."""
    keys = F.array(*[F.xxhash64(F.lit(j), F.slice("sig", a + 1, n)) for j, (a, n) in enumerate(spans)])
    posted = materialize(reps.select(F.col("group_id").alias("id"), F.posexplode(keys).alias("band", "key")),
                         "span-keys")
    sizes = posted.groupBy("band", "key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    dealt = posted.join(sizes, ["band", "key"]).withColumn(
        "blocks", F.ceil(F.col("size") / block).cast("int")).withColumn(
        "own", F.pmod(F.xxhash64("id", F.lit(5)), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    return dealt.select("band", "key", "id", "own", other).select(
        "band", "key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "id")


class _Cell:
    """The rows of one cell as arrays."""

    def __init__(self, rows: pa.Table):
        self.band = rows.column("band")[0].as_py()
        self.whole = rows.column("low")[0].as_py() == rows.column("high")[0].as_py()
        self.id = rows.column("id").to_numpy()
        self.side = rows.column("side").to_numpy()
        self.sig = _matrix(rows.column("sig"))
        self.count = _matrix(rows.column("e"))
        self.least = _matrix(rows.column("lo"))

    def pairs(self, spans):
        """Slices of (row numbers a, row numbers b, equal slots) of the cell's own pairs."""
        if self.whole:
            left = right = np.arange(len(self.id))
        else:
            left, right = np.flatnonzero(self.side == 0), np.flatnonzero(self.side == 1)
        if not len(left) or not len(right):
            return
        step = max(1, SLICE // (self.sig.shape[1] * len(right)))
        for at in range(0, len(left), step):
            part = left[at:at + step]
            same = self.sig[part][:, None, :] == self.sig[right][None, :, :]
            own = np.triu(np.ones(same.shape[:2], bool), at + 1) if self.whole else np.ones(same.shape[:2], bool)
            a, n = spans[self.band]
            own &= same[:, :, a:a + n].all(axis=2)
            for a, n in spans[:self.band]:
                own &= ~same[:, :, a:a + n].all(axis=2)
            i, j = np.nonzero(own)
            if len(i):
                yield part[i], right[j], same.sum(axis=2, dtype=np.int16)[i, j].astype(np.int64)


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def by_cell(batches, keys=tuple(CELL)):
    """One table per run of equal ``keys`` (integers) in a sorted partition."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in keys])
        cuts = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:]):
            now = tuple(key[:, a].tolist())
            if last is not None and now != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = now
    if held:
        yield pa.Table.from_batches(held)


def _reduced(members: DataFrame, groups: DataFrame, spans, make, schema: str) -> DataFrame:
    """``make()`` gives a reducer per task: ``add(cell, a, b, equal)`` for each
    slice of pairs, then ``rows()``, record batches of ``schema``."""
    spans = tuple(spans)

    def run(batches):
        reducer = make()
        for rows in by_cell(batches):
            cell = _Cell(rows)
            for found in cell.pairs(spans):
                yield from reducer.add(cell, *found)
        yield from reducer.rows()

    payload = groups.select(F.col("group_id").alias("id"), "sig", "e", "lo")
    members = materialize(members, "cell-members")
    # a task's work is its cells' pairs, not its bytes: tasks grow in number with the members
    tasks = min(MOST_TASKS, members.count() // (2 * BLOCK))
    deal = (tasks, *CELL) if tasks > int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")) else CELL
    return (members.join(payload, "id").repartition(*deal).sortWithinPartitions(*CELL)
            .select(*CELL, "side", "id", "sig", "e", "lo").mapInArrow(run, schema))


class _AllPairs:
    def __init__(self, slots):
        self.slots = slots

    def add(self, cell, a, b, equal):
        x, y = cell.id[a], cell.id[b]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(equal / self.slots)],
            ["id1", "id2", "estimated_jaccard"])

    def rows(self):
        return ()


class _Histogram:
    """Exact counts: Python integers, as a product of two sizes may pass 2^63."""

    def __init__(self, thresholds, slots):
        self.found, self.thresholds, self.slots = {}, thresholds, slots

    def add(self, cell, a, b, equal):
        for t in range(len(self.thresholds)):
            x, y = cell.count[a, t], cell.count[b, t]
            if float(x.max()) * float(y.max()) * len(x) < 2.0 ** 62:
                sums = np.zeros(self.slots + 1, np.int64)
                np.add.at(sums, equal, x * y)
                some = [(int(s), int(sums[s])) for s in np.flatnonzero(sums)]
            else:
                some = [(int(s), int(p) * int(q)) for s, p, q in zip(equal, x, y) if p and q]
            for s, n in some:
                self.found[t, s] = self.found.get((t, s), 0) + n
        return ()

    def rows(self):
        if self.found:
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.thresholds[t] for t, _ in self.found], pa.int64()),
                 pa.array([s / self.slots for _, s in self.found]), pa.array([str(n) for n in self.found.values()])],
                ["min_ratings", "estimated_jaccard", "n"])


class _Best:
    """The k leading pairs per threshold: highest score, then smallest ids."""

    def __init__(self, thresholds, least, k, spans, slots):
        self.thresholds, self.least, self.k, self.spans, self.slots = thresholds, least, k, spans, slots
        self.held = [np.zeros((5, 0), np.int64) for _ in thresholds]

    def add(self, cell, a, b, equal):
        if self.spans is not None:       # the cell's spans are not the bands: keep candidates alone
            band = np.zeros(len(a), bool)
            for at, n in self.spans:
                band |= (cell.sig[a, at:at + n] == cell.sig[b, at:at + n]).all(axis=1)
            a, b, equal = a[band], b[band], equal[band]
        x, y = cell.id[a], cell.id[b]
        for t, least in enumerate(self.least):
            ok = (equal >= least) & (cell.count[a, t] > 0) & (cell.count[b, t] > 0)
            if ok.any():
                p, q = cell.least[a[ok], t], cell.least[b[ok], t]
                new = np.stack([-equal[ok], np.minimum(p, q), np.maximum(p, q), np.minimum(x, y)[ok],
                                np.maximum(x, y)[ok]])
                new = np.concatenate([self.held[t], new], axis=1)
                self.held[t] = new[:, np.lexsort(new[2::-1])[:self.k]]
        return ()

    def rows(self):
        for t, held in zip(self.thresholds, self.held):
            if held.shape[1]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(held.shape[1], t)), pa.array(held[3]), pa.array(held[4]),
                     pa.array(-held[0] / self.slots), pa.array(held[1]), pa.array(held[2])],
                    ["min_ratings", "id1", "id2", "estimated_jaccard", "a", "b"])


def all_pairs(groups: DataFrame, spans=BANDS, slots: int = NUM_PERM) -> DataFrame:
    """(id1, id2, estimated_jaccard), each pair once."""
    return _reduced(bucket_members(groups, spans), groups, spans, lambda: _AllPairs(slots),
                    "id1 long, id2 long, estimated_jaccard double")


def histogram(groups: DataFrame, thresholds, spans=BANDS, slots: int = NUM_PERM) -> DataFrame:
    """(min_ratings, estimated_jaccard, cnt DECIMAL) over the expanded pairs
    between groups."""
    thresholds = tuple(thresholds)
    found = _reduced(bucket_members(groups, spans), groups, spans, lambda: _Histogram(thresholds, slots),
                     "min_ratings long, estimated_jaccard double, n string")
    return found.groupBy("min_ratings", "estimated_jaccard").agg(
        F.sum(F.col("n").cast("decimal(38,0)")).cast("decimal(38,0)").alias("cnt"))


def best(groups: DataFrame, thresholds, least, k: int, spans=BANDS, bands=BANDS, slots: int = NUM_PERM) -> DataFrame:
    """(min_ratings, id1, id2, estimated_jaccard, a, b): per task and threshold
    the ``k`` leading pairs with at least ``least[t]`` equal slots that agree on
    one of ``bands``; ``a`` and ``b`` are the smallest eligible ids of the two."""
    thresholds, least = tuple(thresholds), tuple(least)
    check = None if tuple(spans) == tuple(bands) else tuple(bands)
    return _reduced(bucket_members(groups, spans), groups, spans,
                    lambda: _Best(thresholds, least, k, check, slots),
                    "min_ratings long, id1 long, id2 long, estimated_jaccard double, a long, b long")
