"""Ranked lexical search by pipelined term partitioning (operator 13).

Terms are runs of ASCII letters and digits and of all characters beyond ASCII,
with A-Z alone in lower case.  An item's score in a document is the sum, over
its distinct terms, of an integer weight times an integer saturation of the
term's count, so the order of addition cannot change it.

1. *Postings* (map-only): the documents of a task are cut into blocks of at most
   ``BLOCK`` documents; a block's postings are one row per term, documents as
   16-bit places in the block.  While the items' terms are few (a checked count)
   the tasks know them and keep no others; else the joins with them do that.
2. *Term owners*: by their weights, the terms are dealt to ``OWNERS`` successive
   owners, rare terms first.
3. *Pipeline*: items travel in bundles of about ``BUNDLE``.  A bundle carries, for
   each block, a sparse accumulator: the places that hold a term so far and their
   integer sums, item by item.  At each owner a cogroup by (bundle, block) brings
   that owner's postings of the bundle's terms; their contributions are added
   and the accumulator goes on to the next owner.  No stage sees a whole item or a
   whole posting list.
4. *Limits*: behind the first owner, an item's k-th best sum so far is a score it
   will reach in any case, and the later owners' terms can add no more than their
   weights times their largest saturations.  A document whose sum so far
   and that rest stay below the limit cannot be among the k best: it leaves the
   accumulator, and documents that would be new to it do not enter.  The result
   is exact; nothing is cut at a count.
5. *Selection*: the k best of each block, then of each item.

Edge cases: a null text has no terms and counts neither as a document nor in the
lengths; items without terms, or whose terms no document holds, return no rows;
an item repeated in full is ranked once, an id repeated with another text is
ranked for each; documents that repeat an id are ranked one by one, and a null id
follows the others among equal scores; terms in half of all documents or more may
weigh 0 and add nothing; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm.common import arrow_map, materialize
from likeness.session import bounded_broadcast

K = 50
BLOCK = 4096                       # documents of a block: places have 16 bits
BUNDLE = 256                       # items of a bundle, on average
KNOWN_TERMS = 500_000              # item terms up to which tasks know them all
SLICE = 1 << 20                    # bytes of a text that are split at once
# Fixed values of the ranking function.
UNIT, RISE, SLOPE, FLAT, HALF = 1_000_000_000, 1000, 20, 100, 50
# Lower bounds of a term's weight at the owners but the last.
OWNERS = (5000, 3000, 1500)

_KEPT = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))


def terms(text: str | None):
    """The terms of a text in order, as UTF-8, in slices of bounded memory."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_KEPT)
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= SLICE else data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split(b" ")
        at = end


def counted(text: str | None, known=None) -> tuple[int, Counter]:
    """(number of terms, counts of the terms that are ``known``)."""
    n, found = 0, Counter()
    for part in terms(text):
        part = [t for t in part if t]
        n += len(part)
        found.update(part if known is None else filter(known.__contains__, part))
    return n, found


def postings(docs: DataFrame, known, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of two kinds.  One per block (``term`` null): ``ids`` and ``sizes``, the
    documents with a term and their term numbers.  One per block and term:
    ``places`` (16 bits) and ``times`` (32 bits), ascending by place."""
    names = ["block", "term", "ids", "sizes", "places", "times"]
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
    block_size = BLOCK

    def close(block, ids, sizes, lists):
        rows = [(block, None, ids, sizes, None, None)]
        for term, found in lists.items():
            both = np.array(found, np.int64)
            rows.append((block, term, None, None, (both & 0xFFFF).astype("<u2").tobytes(),
                         (both >> 16).astype("<u4").tobytes()))
        for at in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows[at:at + 2000]), kinds)], names)

    def run(batches):
        vocabulary = None if known is None else known.value
        number, ids, sizes, lists = TaskContext.get().partitionId() << 33, [], [], {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                n, found = counted(text, vocabulary)
                if not n:
                    continue
                for term, times in found.items():
                    lists.setdefault(term, []).append(len(ids) | (times << 16))
                ids.append(doc_id)
                sizes.append(n)
                if len(ids) == block_size:
                    yield from close(number, ids, sizes, lists)
                    number, ids, sizes, lists = number + 1, [], [], {}
        if ids:
            yield from close(number, ids, sizes, lists)

    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return source.mapInArrow(
        run, "block long, term binary, ids array<long>, sizes array<long>, places binary, times binary")


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item, item_id, term) of the distinct items, each term once; ``item`` is
    a number of its own."""
    def run(batch):
        rows: list[list] = [[], [], []]
        for item, item_id, text in zip(*(batch.column(c).to_pylist() for c in ("item", "item_id", "text"))):
            for term in sorted(counted(text)[1]):
                for column, value in zip(rows, (item, item_id, term)):
                    column.append(value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.binary()))], ["item", "item_id", "term"])

    each = items.select(F.col(f"`{id_col}`").cast("bigint").alias("item_id"),
                        F.col(f"`{text_col}`").alias("text")).where("text is not null").distinct()
    return arrow_map(each.withColumn("item", F.monotonically_increasing_id()), run,
                     "item long, item_id long, term binary")


def damping(sizes, documents: int, total: int) -> np.ndarray:
    """m of each document; exact whatever the size of the product."""
    return np.array([FLAT - HALF + HALF * n * documents // total for n in sizes], np.int64)


def saturation(times: np.ndarray, m: np.ndarray) -> np.ndarray:
    return UNIT * times // (RISE * times + SLOPE * m)


# An accumulator: ``item`` and ``place`` (ascending, together distinct) and ``total``.
STATE = "bundle long, block long, ids binary, m binary, item binary, place binary, total binary"
_EMPTY = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def _read(column, kind):
    return np.frombuffer(column[0].as_py() or b"", kind).astype(np.int64)


def _added(state, new):
    """Both accumulators' sums by (item, place)."""
    item, place, total = (np.concatenate(x) for x in zip(state, new))
    key = item * 65536 + place
    order = np.argsort(key, kind="stable")
    key, total = key[order], total[order]
    start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[start] // 65536, key[start] % 65536, np.add.reduceat(total, start) if len(key) else total


def _stage(bars: bool):
    """One owner's cogroup: the bundle's accumulator over a block and the owner's
    postings of the bundle's terms in it."""
    def run(held, posted):
        if not held.num_rows:
            raise ValueError("postings of a block without its documents")
        m = _read(held.column("m"), "<i8")
        state = [_read(held.column(c), t) for c, t in (("item", "<u4"), ("place", "<u2"), ("total", "<i8"))]
        new = [_EMPTY]
        for places, times, weight, users in zip(*(posted.column(c).to_pylist() for c in (
                "places", "times", "weight", "users"))):
            place = np.frombuffer(places, "<u2").astype(np.int64)
            gain = weight * saturation(np.frombuffer(times, "<u4").astype(np.int64), m[place])
            users = np.array(users, np.int64)
            new.append((np.repeat(users, len(place)), np.tile(place, len(users)), np.tile(gain, len(users))))
        state = _added(state, [np.concatenate(x) for x in zip(*new)])
        if bars and len(state[0]):
            # an item's bar: what its k-th best reaches already less all that the
            # later owners can add
            bar = _read(held.column("bar"), "<i8")
            stays = state[2] >= bar[state[0]]
            state = [x[stays] for x in state]
        packed = [pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in zip(state, ("<u4", "<u2", "<i8"))]
        return pa.Table.from_arrays(
            [held.column(c) for c in ("bundle", "block", "ids", "m")] + packed,
            ["bundle", "block", "ids", "m", "item", "place", "total"])
    return run


def _best(state: DataFrame, k: int) -> DataFrame:
    """(bundle, user, doc_id, score): the k best sums of every item in each block."""
    def run(batch):
        rows: list[list] = [[], [], [], []]
        columns = [batch.column(c).to_pylist() for c in ("bundle", "ids", "item", "place", "total")]
        for bundle, ids, item, place, total in zip(*columns):
            ids = np.frombuffer(ids, "<i8")
            item, place, total = (np.frombuffer(x or b"", t).astype(np.int64) for x, t in (
                (item, "<u4"), (place, "<u2"), (total, "<i8")))
            doc = ids[place]
            order = np.lexsort((doc, -total, item))
            item, doc, total = item[order], doc[order], total[order]
            start = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
            nth = np.arange(len(item)) - np.repeat(start, np.diff(np.r_[start, len(item)]))
            keep = (nth < k) & (total > 0)
            rows[0].append(np.full(int(keep.sum()), bundle))
            for column, values in zip(rows[1:], (item, doc, total)):
                column.append(values[keep])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c).astype(np.int64)) for c in rows], ["bundle", "user", "doc_id", "score"])

    return arrow_map(state.select("bundle", "ids", "item", "place", "total"), run,
                     "bundle long, user long, doc_id long, score long")


NO_ID = 2**63 - 1                  # stands for a null id, behind all others


def search(docs: DataFrame, items: DataFrame, k: int = K, owners=OWNERS, bundle: int = BUNDLE,
           id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents."""
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item_col, item_text), "item-terms")
    wanted = asked.select("term").distinct()
    few = wanted.limit(KNOWN_TERMS + 1).count() <= KNOWN_TERMS
    known = spark.sparkContext.broadcast(
        frozenset(bytes(r.term) for r in wanted.toLocalIterator())) if few else None
    found = materialize(postings(docs, known, id_col, text_col), "postings")
    blocks = found.where("term is null").select("block", "ids", "sizes")
    posted = found.where("term is not null").select("block", "term", "places", "times")
    sums = blocks.agg(F.sum(F.size("sizes")).alias("documents"),
                      F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("total")).first()
    documents, total = sums.documents or 0, sums.total or 0
    if not documents:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    # term weights; owner 0 has the heaviest terms
    df = posted.join(bounded_broadcast(materialize(wanted, "wanted-terms")), "term", "left_semi").groupBy("term").agg(F.sum(F.length("places") / 2).cast("bigint").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * documents + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    owner = F.lit(len(owners))
    for at, least in reversed(list(enumerate(owners))):
        owner = F.when(F.col("weight") >= least, at).otherwise(owner)
    # items by bundle, numbered within it
    n_items = asked.select("item").distinct().count()
    bundles = max(1, -(-n_items // bundle))
    seats = materialize(asked.select("item", "item_id").distinct().withColumn(
        "bundle", F.pmod(F.xxhash64("item"), F.lit(bundles))).withColumn(
        "user", F.row_number().over(Window.partitionBy("bundle").orderBy("item")) - 1), "item-seats")
    use = materialize(asked.join(bounded_broadcast(seats.select("item", "bundle", "user")), "item")
                      .join(df, "term").withColumn("weight", weight).where("weight > 0").withColumn("owner", owner)
                      .groupBy("owner", "bundle", "term", "weight").agg(F.collect_list("user").alias("users")),
                      "term-owners")

    def begin(batch):
        ids = [np.array([NO_ID if i is None else i for i in x], "<i8") for x in batch.column("ids").to_pylist()]
        m = [damping(x, documents, total).astype("<i8") for x in batch.column("sizes").to_pylist()]
        size = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column("bundle"), batch.column("block"), *(pa.array([x.tobytes() for x in c], pa.binary())
                                                              for c in (ids, m)),
             *(pa.array([b""] * size, pa.binary()) for _ in range(3))],
            ["bundle", "block", "ids", "m", "item", "place", "total"])

    state = arrow_map(blocks.withColumn("bundle", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                                       F.lit(bundles - 1).cast("bigint")))),
                      begin, STATE)
    bar = None
    for at in range(len(owners) + 1):
        mine = bounded_broadcast(use.where(F.col("owner") == at).drop("owner"))
        coming = posted.join(mine, "term").select("bundle", "block", "places", "times", "weight", "users")
        if bar is not None:
            state = state.join(bounded_broadcast(bar[at]), "bundle")
        state = state.groupBy("bundle", "block").cogroup(coming.groupBy("bundle", "block")).applyInArrow(
            _stage(bar is not None), STATE)
        if at == 0 and owners:
            state = materialize(state, "accumulators")
            bar = _bars(state, use, seats, k, len(owners))
    last = Window.partitionBy("bundle", "user").orderBy(F.desc("score"), "doc_id")
    best = _best(state, k).withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    return best.join(bounded_broadcast(seats.select("bundle", "user", "item_id")), ["bundle", "user"]).select(
        "item_id", F.col("rank").cast("int").alias("rank"),
        F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")


def _bars(state: DataFrame, use: DataFrame, seats: DataFrame, k: int, last: int) -> dict[int, DataFrame]:
    """Per owner behind the first, (bundle, bar): for each item of the bundle the
    k-th best sum at the first owner less all that the owners behind this one can
    add (a saturation stays below ``UNIT // RISE``); 1 at least, as a sum of 0 is
    no result."""
    nth = Window.partitionBy("bundle", "user").orderBy(F.desc("score"), "doc_id")
    kth = _best(state, k).withColumn("_n", F.row_number().over(nth)).where(F.col("_n") == k).select(
        "bundle", "user", F.col("score").alias("kth"))
    each = use.select("bundle", "owner", (F.col("weight") * (UNIT // RISE)).alias("gain"),
                      F.explode("users").alias("user"))
    rest = [F.coalesce(F.sum(F.when(F.col("owner") > at, F.col("gain"))), F.lit(0)).alias(f"rest{at}")
            for at in range(1, last + 1)]
    both = materialize(seats.select("bundle", "user").join(kth, ["bundle", "user"], "left").join(
        each.groupBy("bundle", "user").agg(*rest), ["bundle", "user"], "left"), "item-bars")

    def of(at):
        level = F.greatest(F.lit(1), F.coalesce(F.col("kth"), F.lit(0)) - F.coalesce(F.col(f"rest{at}"), F.lit(0)))

        def run(rows):
            rows = rows.sort_by("user")
            return pa.Table.from_arrays(
                [rows.column("bundle").slice(0, 1),
                 pa.array([rows.column("level").to_numpy().astype("<i8").tobytes()], pa.binary())], ["bundle", "bar"])
        return materialize(both.select("bundle", "user", level.cast("bigint").alias("level")).groupBy("bundle")
                           .applyInArrow(run, "bundle long, bar binary"), "bundle-bars")
    return {at: of(at) for at in range(1, last + 1)}


# The same ranking over whole tables, term by term.
Q_LEXICAL_SQL = r"""WITH words AS (
  SELECT d.rowid AS uid, d.doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents) d),
sizes AS (SELECT uid, count(*) AS n FROM words GROUP BY uid),
nl AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
damp AS (SELECT uid, 50 + (50 * n * docs) // total AS m FROM sizes, nl),
tf AS (SELECT uid, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
item_terms AS (
  SELECT DISTINCT item_id, text, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (SELECT i.*, floor(1000 * ln((2.0 * docs + 2) / (2.0 * df + 1)))::BIGINT AS w
            FROM item_terms i JOIN df USING (term), nl),
scored AS (
  SELECT w.item_id, w.text, t.uid, t.doc_id,
         sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 20 * d.m)))::BIGINT AS score
  FROM weights w JOIN tf t USING (term) JOIN damp d USING (uid) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id)::INTEGER AS rank,
       doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 50"""


def term_weight(df: int, documents: int) -> int:
    """The weight of one term (the tests' plain form)."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))
