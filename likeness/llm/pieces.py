"""SentencePiece encoding and decoding by a distinct-chunk table (operator 1).

A model whose pieces hold the space marker only in front cannot merge across
a marked word, so every marked word (a run of markers and the characters up to
the next marker) is segmented alone.  The corpus is encoded in three steps:

1. *Blocks* (map-only): the documents of a partition are cut into blocks of
   about ``BLOCK_BYTES`` of text.  A block keeps one dictionary of its distinct
   marked words and, for each document, the dictionary positions of its words.
   The dictionary leaves in ``buckets`` parts by a hash of the word.  A block is
   named by a digest of its dictionary, so that positions never meet another
   dictionary than their own, whatever is read or run again.
2. *Distinct words*: dictionary parts meet by bucket; within a bucket each
   distinct marked word of the corpus is segmented once.  A frequent word
   comes once per block, never once per occurrence.
3. *Join by position*: each block's documents meet their segmented dictionary
   and the ids are gathered by position with numpy; decoding runs on whole
   id lists.

Memory is bounded by a block (or a single longer text) and a bucket.

Edge cases: null and empty texts have no ids and decode to the empty string;
rows with a null or repeated id are encoded one by one; an empty table gives an
empty result.  A model with pieces across markers raises ``ValueError``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from likeness.llm.common import arrow_map, materialize

MARK = "▁"
BLOCK_BYTES = 16 << 20
BUCKETS_PER_PARTITION = 4

_MODELS: dict[str, sentencepiece.SentencePieceProcessor] = {}


def model(path: str) -> sentencepiece.SentencePieceProcessor:
    if path not in _MODELS:
        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _MODELS[path]


def check_model(path: str) -> None:
    """Raise unless marked words are independent under this model."""
    sp = model(path)
    for i in range(sp.vocab_size()):
        if MARK in sp.id_to_piece(i).lstrip(MARK):
            raise ValueError(f"piece {i} of {path} crosses a space marker")
    if sp.normalize("a b") != f"{MARK}a{MARK}b" or sp.normalize(" a") != f"{MARK * 2}a":
        raise ValueError(f"{path} does not mark every space")


def marked_words(sp, text: str) -> list[str]:
    """Marked words of a text, each without its first marker, other markers as
    spaces; joined with one space they give the marked text back."""
    if not text:
        return []
    words = sp.normalize(text)[1:].replace(MARK, " ").split(" ")
    if "" not in words:
        return words
    out, lead = [], ""
    for word in words:
        if word:
            out.append(lead + word)
            lead = ""
        else:
            lead += " "
    if lead:                       # the text ends in markers: they form one last word
        out.append(lead[1:])
    return out


class _Numbers(dict):
    def __missing__(self, word):
        number = self[word] = len(self)
        return number


def _blocks(path: str, buckets: int, block_bytes: int):
    """Step 1 on one partition.  Within a block, words are numbered by falling
    frequency: a position is then mostly a small number and compresses well."""
    names = ["block", "doc_id", "positions", "bucket", "places", "words"]
    types = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def close(place, numbers, doc_ids, found):
        words = list(numbers)
        block = xxhash.xxh3_64_intdigest(MARK.join(words), seed=place & (2**64 - 1)) >> 1
        used = np.bincount(np.concatenate(found), minlength=len(words))
        order = np.argsort(-used, kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[order] = np.arange(len(words), dtype=np.uint32)
        n = len(doc_ids)
        yield _record(names, types, [[block] * n, doc_ids, [_squeeze(rank[at]) for at in found], *[[None] * n] * 3])
        bucket = np.fromiter((zlib.crc32(words[i].encode()) % buckets for i in order), np.int64, len(words))
        dealt = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(bucket[dealt]) > 0, True]) if len(words) else [0]
        parts = [dealt[a:b] for a, b in zip(cuts[:-1], cuts[1:])]      # ranks, ascending
        n = len(parts)
        yield _record(names, types, [
            [block] * n, [None] * n, [None] * n, [int(bucket[p[0]]) for p in parts],
            [_squeeze(np.diff(p, prepend=0)) for p in parts],
            [_pack(MARK.join(words[i] for i in order[p]).encode()) for p in parts]])

    def run(batches):
        sp, part = model(path), TaskContext.get().partitionId()
        count, numbers, held, doc_ids, found = 0, _Numbers(), 0, [], []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = marked_words(sp, text or "")
                doc_ids.append(doc_id)
                found.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
                held += len(text or "")
                if held >= block_bytes:
                    yield from close((part << 32) | count, numbers, doc_ids, found)
                    count, numbers, held, doc_ids, found = count + 1, _Numbers(), 0, [], []
        if doc_ids:
            yield from close((part << 32) | count, numbers, doc_ids, found)
    return run


def _record(names, types, columns):
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names)


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _squeeze(at: np.ndarray) -> bytes:
    """Numbers as compressed byte planes: the high bytes hardly vary."""
    return _pack(at.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unsqueeze(data: bytes) -> np.ndarray:
    planes = np.frombuffer(_unpack(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _segment(path: str):
    """Step 2 on dictionary parts sorted by bucket: every distinct word once."""
    names = ["block", "places", "counts", "ids"]
    types = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]

    def run(batches):
        sp, bucket, known = model(path), None, {}
        lone = sp.encode("x ")[len(sp.encode("x")):]          # a final marker by itself
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("block", "bucket", "places", "words")]
            rows: list[list] = [[], [], [], []]
            for block, b, places, packed in zip(*columns):
                words = _unpack(packed).decode().split(MARK)
                if b != bucket:
                    bucket, known = b, {}
                new = [w for w in words if w not in known]
                for w, ids in zip(new, sp.encode(new, num_threads=1)):
                    known[w] = np.array(ids if w else lone, "<u4").tobytes()
                found = [known[w] for w in words]
                counts = np.fromiter(map(len, found), np.uint32, len(found)) // 4
                flat = np.frombuffer(b"".join(found), "<u4")
                for column, value in zip(rows, (block, places, _squeeze(counts), _squeeze(flat))):
                    column.append(value)
            yield _record(names, types, rows)
    return run


def _gather(start: np.ndarray, count: np.ndarray, flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ids of the words ``at``, in order."""
    n = count[at]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(start[at] - (ends - n), n) + np.arange(total)]


def _restore(path: str, digest: bool):
    """Step 3: one block's documents and its segmented dictionary."""
    def run(docs, parts):
        sp, decimal = model(path), None
        starts, counts, flats, base = [], [], [], 0
        places = [np.cumsum(_unsqueeze(p).astype(np.int64)) for p in parts.column("places").to_pylist()]
        for c, f in zip(parts.column("counts").to_pylist(), parts.column("ids").to_pylist()):
            c, f = _unsqueeze(c).astype(np.int64), _unsqueeze(f)
            starts.append(base + np.cumsum(c) - c)
            counts.append(c)
            flats.append(f)
            base += len(f)
        size = sum(map(len, places))
        if not size and docs.num_rows and any(len(_unsqueeze(p)) for p in docs.column("positions").to_pylist()):
            raise ValueError("the documents changed while they were read: a block lacks its dictionary")
        start, count = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for p, s, c in zip(places, starts, counts):
            start[p], count[p] = s, c
        flat = np.concatenate(flats) if flats else np.zeros(0, np.uint32)
        if digest:
            decimal = [str(i) for i in range(sp.vocab_size())]
        out: list[list] = [[], [], [], []]
        for doc_id, data in zip(docs.column("doc_id").to_pylist(), docs.column("positions").to_pylist()):
            ids = _gather(start, count, flat, _unsqueeze(data)).tolist()
            text = sp.decode(ids) if ids else ""
            row = (doc_id, len(ids), ids, text) if not digest else (
                doc_id, len(ids), hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                hashlib.sha256(text.encode()).hexdigest())
            for column, value in zip(out, row):
                column.append(value)
        types = [pa.int64(), pa.int64(), pa.string() if digest else pa.list_(pa.int32()), pa.string()]
        names = ["doc_id", "n_tokens", "ids_sha256" if digest else "ids", "decoded_sha256" if digest else "decoded"]
        return pa.Table.from_arrays([pa.array(c, type=t) for c, t in zip(out, types)], names)
    return run


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     digest: bool = False, block_bytes: int = BLOCK_BYTES, reread: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) per row of ``docs``; with ``digest``
    ``ids_sha256`` and ``decoded_sha256`` stand for the two wide columns.

    ``model_path`` must be readable on every executor.  ``reread``: ``docs`` is
    read straight from files, which give the same rows in the same order each
    time, so the blocks are made twice in place of being written (half the
    disk); a difference raises ``ValueError``.
    """
    check_model(model_path)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = BUCKETS_PER_PARTITION * parts
    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    blocks = source.mapInArrow(
        _blocks(model_path, buckets, block_bytes),
        "block long, doc_id long, positions binary, bucket int, places binary, words binary")
    if not reread:
        blocks = materialize(blocks, "piece-blocks")
    words = blocks.where("bucket is not null").select("block", "bucket", "places", "words")
    segmented = words.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(
        _segment(model_path), "block long, places binary, counts binary, ids binary")
    held = blocks.where("bucket is null").select("block", "doc_id", "positions")
    kinds = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return held.groupBy("block").cogroup(segmented.groupBy("block")).applyInArrow(
        _restore(model_path, digest), f"doc_id long, n_tokens long, {kinds}")
