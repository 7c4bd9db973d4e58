"""Packing by vector bins (operator 5).

Every example is a vector: tokens, segments and loss-bearing tokens.  A
sequence (bin) has a capacity in each of the three dimensions.  ``pack`` fills
bins one after the other with the example whose vector has the largest dot
product with what the bin has left (both as shares of the capacities), until
nothing fits.  Examples are dealt to partitions by a hash of their id and
packed in groups of at most ``GROUP`` (a bound on one step's memory and time,
not on the input): only the last bin of a group is left with a gap that others
could have filled.

``token_pieces`` cuts tokenised documents: as many full pieces as fit, then one
tail, which is the example to be packed.

Edge cases: a null text is an empty one (a single end id); repeated rows are
packed one by one; an example above a capacity raises ``ValueError`` (cut it
first); an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from likeness.llm.common import materialize, release_memory

LENGTH, MAX_SEGMENTS, MAX_LOSS = 2048, 64, 2048
END_ID = 1
GROUP = 4096
# words, and their ids, that one Python worker finds before it forgets the earlier ones: about 100 MB
CACHE_WORDS, CACHE_IDS = 300_000, 2 << 20
TEXTS_AT_ONCE = 500     # texts that the table's reader holds, and whose repeated words are looked up once
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the code points from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Words(dict):
    """Ids of whitespace-separated words, segmented once as long as they are remembered.

    The tokenizer drops white space, and no piece spans it, so a text's ids are
    its words' ids in order.  Plain words (letters below U+0130, then ASCII
    punctuation) go to the merge model directly, letters and punctuation each
    as a word of its own; any other word goes through the whole tokenizer.
    ``dict`` values are places in ``flat``, which only grows at its end: where
    a word's ids begin, shifted by ``BITS``, and how many they are.  Before
    texts that find more than ``CACHE_WORDS`` words or ``CACHE_IDS`` ids, they
    become the earlier ones, and what was earlier is forgotten: words in use
    stay.
    """
    BITS = 32
    COUNT = (1 << BITS) - 1

    def __init__(self, path: str):
        super().__init__()
        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model
        self.letters = _byte_letters()
        self.flat = array("I")
        self.turn()

    def turn(self):
        self.earlier = dict(self), self.flat
        self.clear()
        self.flat = array("I")

    def __missing__(self, word: str) -> int:
        places, flat = self.earlier
        place = places.get(word)
        if place is not None:
            first = place >> self.BITS
            ids = flat[first:first + (place & self.COUNT)]
        else:
            body = word.rstrip(punctuation)
            if (body.isalpha() or not body) and (word.isascii() or max(word) < "İ"):
                lower = body.lower()
                if body and len(body) < len(word):
                    head, tail = self[lower], self[word[len(body):]]
                    first, then = head >> self.BITS, tail >> self.BITS
                    ids = self.flat[first:first + (head & self.COUNT)] + self.flat[then:then + (tail & self.COUNT)]
                elif body and lower != word:
                    place = self[word] = self[lower]
                    return place
                else:
                    shown = word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
                    ids = [t.id for t in self.merge.tokenize(shown)]
            else:
                ids = self.whole.encode(word, add_special_tokens=False).ids
        place = self[word] = len(self.flat) << self.BITS | len(ids)
        self.flat.extend(ids)
        return place

    def ids(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (none null); words that repeat are looked up once."""
        if len(self) > CACHE_WORDS or len(self.flat) > CACHE_IDS:
            self.turn()
        # the tokenizer does not take U+001C to U+001F for white space
        odd = pc.match_substring_regex(texts, "[\x1c-\x1f]")
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        words = split.flatten().dictionary_encode()
        distinct = words.dictionary.to_numpy(zero_copy_only=False)
        places = np.fromiter(map(self.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        # a view of the grown array: it cannot grow while a view lives, and none is returned
        flat = np.frombuffer(self.flat, np.uint32)
        first, n = places >> self.BITS, places & self.COUNT
        ends = np.append(0, np.cumsum(n))
        at = np.repeat(first - ends[:-1], n)
        at += np.arange(ends[-1])
        ids = flat[at]
        del flat, at
        bounds = ends[split.offsets.to_numpy() - split.offsets[0].as_py()]
        for text, is_odd, start, end in zip(texts, odd.to_pylist(), bounds, bounds[1:]):
            yield (np.array(self.whole.encode(text.as_py(), add_special_tokens=False).ids, np.uint32) if is_odd
                   else ids[start:end])


_WORDS: dict[str, _Words] = {}


def words_of(path: str) -> _Words:
    if path not in _WORDS:
        _WORDS[path] = _Words(path)
    return _WORDS[path]


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``length`` ids of every document (its ids, then
    ``END_ID``): full ones and one tail.  Map-only.  ``number`` is unique per
    piece; ``ids`` (with ``with_ids``) are the piece's ids."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "number"] + ["ids"] * with_ids
    types = [pa.int64()] * 6 + [pa.list_(pa.int32())] * with_ids

    def run(batches):
        words, number = words_of(tokenizer_path), TaskContext.get().partitionId() << 33
        cuts = (b.slice(at, TEXTS_AT_ONCE) for b in batches for at in range(0, b.num_rows, TEXTS_AT_ONCE))
        for cut in cuts:
            out: list[list] = [[] for _ in names]
            texts = cut.column(1).fill_null("")
            for doc_id, ids in zip(cut.column(0).to_pylist(), words.ids(texts)):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for at in range(0, len(ids), length):
                    piece = ids[at:at + length]
                    row = (doc_id, at, len(piece), zlib.crc32(piece.tobytes()), len(ids), number)
                    for column, value in zip(out, (*row, piece) if with_ids else row):
                        column.append(value)
                    number += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(out, types)], names)
        release_memory()

    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return source.mapInArrow(run, PIECE + ", number long" + ", ids array<int>" * with_ids)


def fill(vectors: np.ndarray, capacity: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bin, token offset) of each vector (rows: tokens, segments, loss) by the
    dot-product heuristic; ties go to the earlier row."""
    share = vectors / capacity
    if (share > 1).any():
        raise ValueError("an example is larger than a sequence")
    n = len(vectors)
    bins, offsets = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    # largest first, so that an open bin always sees the large examples first
    order = np.lexsort((np.arange(n), -share.max(axis=1))) if n else np.zeros(0, np.int64)
    left_share, left_rows, number = share[order], order, 0
    while len(left_rows):
        room, used, alive = np.ones(vectors.shape[1]), 0, np.ones(len(left_rows), bool)
        columns, fits = np.ascontiguousarray(left_share.T), alive.copy()
        while True:
            for column, limit in zip(columns, room + 1e-12):   # what no longer fits never will
                fits &= column <= limit
            if not fits.any():
                break
            best = int(np.argmax(np.where(fits, left_share @ room, -1.0)))
            row = left_rows[best]
            bins[row], offsets[row] = number, used
            used += int(vectors[row, 0])
            room = room - left_share[best]
            alive[best] = fits[best] = False
        left_share, left_rows, number = left_share[alive], left_rows[alive], number + 1
    return bins, offsets


def pack(examples: DataFrame, key: str, tokens: str, loss: str, length: int = LENGTH,
         max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS, group: int = GROUP) -> DataFrame:
    """``examples`` with ``sequence_id`` and ``offset`` (tokens before it in
    its sequence).  ``key`` deals and orders the examples; ``tokens`` and
    ``loss`` hold their sizes, and each is one segment."""
    parts = int(examples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = examples.columns

    def run(batches):
        part, groups, held, rows = TaskContext.get().partitionId(), 0, [], 0
        capacity = np.array([length, max_segments, max_loss], float)

        def close(held, groups):
            whole = pa.Table.from_batches(held).combine_chunks()
            size = [whole.column(c).to_numpy().astype(float) for c in (tokens, loss)]
            bins, offsets = fill(np.stack([size[0], np.ones(len(size[0])), size[1]], axis=1), capacity)
            base = (part << 40) | (groups << 16)
            whole = whole.append_column("sequence_id", pa.array(base + bins, pa.int64()))
            yield from whole.append_column("offset", pa.array(offsets, pa.int64())).to_batches()

        for batch in batches:
            for at in range(0, batch.num_rows, group):
                cut = batch.slice(at, group)
                while cut.num_rows:
                    take = cut.slice(0, group - rows)
                    held.append(take)
                    rows += take.num_rows
                    cut = cut.slice(take.num_rows)
                    if rows == group:
                        yield from close(held, groups)
                        groups, held, rows = groups + 1, [], 0
        if rows:
            yield from close(held, groups)

    schema = T.StructType([*examples.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType())])
    return (examples.repartition(parts, F.col(key)).sortWithinPartitions(key)
            .select(*kept).mapInArrow(run, schema))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, max_segments: int = MAX_SEGMENTS, max_loss: int = MAX_LOSS) -> DataFrame:
    """Pieces of all documents with their place: a full piece is a sequence of
    its own, the tails are packed.  A piece's first id bears no loss (nothing
    precedes it).  The pieces are written once: both branches read them.  While
    they are written, the reader holds ``TEXTS_AT_ONCE`` rows: its default of
    4,096 whole texts makes the heap grow."""
    conf = docs.sparkSession.conf
    rows = conf.get(READER_ROWS)
    conf.set(READER_ROWS, min(int(rows), TEXTS_AT_ONCE))
    try:
        pieces = materialize(token_pieces(docs, tokenizer_path, id_col, text_col, length), "token-pieces")
    finally:
        conf.set(READER_ROWS, rows)
    full = pieces.where(F.col("length") == length).select(
        "*", (F.col("number") * 2).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    tails = pieces.where(F.col("length") < length).withColumn("loss", F.col("length") - 1)
    packed = pack(tails, "number", "length", "loss", length, max_segments, max_loss).drop("loss").withColumn(
        "sequence_id", F.col("sequence_id") * 2 + 1)
    return full.unionByName(packed).drop("number")
