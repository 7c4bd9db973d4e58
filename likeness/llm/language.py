"""Language identification with language-bitmask n-gram filters (operator 9).

Letters are lower-cased, every run of other characters becomes one boundary,
and the text's overlapping n-grams are hashed.  One Bloom filter per language
holds the n-grams usual in it; the filters share their hash functions and are
stored bit-sliced: a slot is a bitmask over languages, so one look-up (the AND
of ``HASHES`` slots) returns all languages containing an n-gram.  A language's
popcount over the whole text, corrected for its filter's false-positive rate,
is its evidence; the largest decides, ties go to the smaller name.

Learning uses, per language, the ``SAMPLE`` smallest hashes among the distinct
labelled rows of at most ``SAMPLE_BYTES`` that are not held out (a documented
bound: a language that holds a third of all rows is cut to the same size, and
repeats of one row count once).  At most ``MAX_LANGS`` languages are learned;
more raise ``ValueError``.  Each
language's n-grams are counted by documents in its own group; at most
``NGRAMS`` per language are kept, so the filters' size is bounded by the number
of languages.  Prediction is map-only.

Edge cases: null texts and texts without a letter give ``und`` and score 0, as
does a table without labels; rows with null language are predicted like any
other; repeated rows get equal results; other columns pass through.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likeness.llm.common import add_columns, fresh, materialize, text_id

N = 4                               # code points of an n-gram, boundary included
HASHES, SLOTS = 2, 1 << 20          # a slot holds one bit per language
SLICE = 1 << 17                     # characters looked up at once
SAMPLE, SAMPLE_BYTES = 1000, 1 << 15
MAX_LANGS = 512                     # filters are sent to every task: 320 KB a language to learn, 128 KB to look up
NGRAMS, SHARE = 40_000, 0.02        # per language: most n-grams kept; least share of its documents
HELD_OUT, HELD = 4, 2               # held out: crc32 of the id as text modulo 4 is 2
UNKNOWN = "und"
HEARD, MARGIN, FEW = 0.2, 4.0, 24   # see Filters.speaks

_LETTER = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                     0xD6E8FEB86659FD93], np.uint64)


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes of all n-grams, number of them per text, whether it has a
    letter).  A text with letters starts and ends with a boundary."""
    data = [(t or "").lower().encode("utf-32-le", "surrogatepass") for t in texts]
    size = np.array([len(d) // 4 + 1 for d in data], np.int64)
    points = np.frombuffer(b"\0\0\0\0".join([b"", *data, b""]), "<u4")   # a boundary around each text
    letter = _LETTER[points]
    keep = letter | np.r_[True, letter[:-1]]                             # a run of others counts once
    doc = np.repeat(np.arange(len(data) + 1), np.r_[1, size])[keep]      # a boundary belongs to the text before it
    lettered = np.bincount(doc, letter[keep], len(data) + 1)[1:] > 0
    kept = np.where(letter[keep], points[keep], 0).astype(np.uint64)
    h = _hashes(kept)
    if not len(h):
        return h, np.zeros(len(data), np.int64), lettered
    # the n-gram's letters belong to one text: that of its last place
    own = doc[N - 1:]
    whole = (doc[1:1 + len(h)] == own) & (own > 0)
    return h[whole], np.bincount(own[whole] - 1, minlength=len(data))[:len(data)], lettered


def _slices(texts: list[str | None]):
    """(numbers of the texts, n-gram hashes, n-grams per text, letters) a slice of
    about ``SLICE`` characters at a time: small texts together, a long one in
    parts that carry their last N - 1 places over."""
    held, size = [], 0
    for i, text in enumerate(texts):
        if len(text or "") > SLICE:
            yield from _parts(i, text)
            continue
        held.append(i)
        size += len(text or "")
        if size >= SLICE:
            yield np.array(held), *ngrams([texts[k] for k in held])
            held, size = [], 0
    if held:
        yield np.array(held), *ngrams([texts[k] for k in held])


def _parts(i: int, text: str):
    text = text.lower()
    carry, before, at = np.zeros(1, np.uint64), False, 0      # the boundary in front
    while at <= len(text):
        part = text[at:at + SLICE] + ("\0" if at + SLICE >= len(text) else "")
        at += SLICE if at + SLICE < len(text) else len(text) + 1
        points = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _LETTER[points]
        keep = letter | np.r_[before, letter[:-1]]
        kept = np.concatenate([carry, np.where(letter, points, 0)[keep].astype(np.uint64)])
        carry, before = kept[-(N - 1):], bool(letter[-1])
        h = _hashes(kept)
        yield np.array([i]), h, np.array([len(h)]), np.array([letter.any()])


def _hashes(kept: np.ndarray) -> np.ndarray:
    """The hash of every run of N places."""
    if len(kept) < N:
        return np.zeros(0, np.uint64)
    h = np.zeros(len(kept) - N + 1, np.uint64)
    for k in range(N):
        h += (kept[k:k + len(h)] + np.uint64(k + 1)) * _FACTORS[k]
    h = (h ^ (h >> np.uint64(29))) * _FACTORS[4]
    return h ^ (h >> np.uint64(32))


def _places(h: np.ndarray) -> list[np.ndarray]:
    step = SLOTS.bit_length() - 1
    return [((h >> np.uint64(step * k)) & np.uint64(SLOTS - 1)).astype(np.int64) for k in range(HASHES)]


@dataclass
class Filters:
    """``langs``: names by bit; ``words``: SLOTS bitmasks per 64 languages;
    ``default``: the language with most labelled rows, for texts with letters
    of which no filter knows anything."""
    langs: list[str]
    words: np.ndarray
    default: int = 0

    @staticmethod
    def of(grams: dict[str, np.ndarray], sizes: dict[str, int] | None = None) -> Filters:
        langs = sorted(grams)
        words = np.zeros(((len(langs) + 63) // 64, SLOTS), np.uint64)
        for i, lang in enumerate(langs):
            for at in _places(grams[lang]):
                words[i // 64, at] |= np.uint64(1 << (i % 64))
        sizes = sizes or {}
        return Filters(langs, words, max(range(len(langs)), key=lambda i: sizes.get(langs[i], 0), default=0))

    def false_positive(self) -> np.ndarray:
        """Chance that an n-gram outside language l passes its filter."""
        fill = [np.mean((self.words[i // 64] >> np.uint64(i % 64)) & np.uint64(1)) for i in range(len(self.langs))]
        return np.array(fill) ** HASHES

    def popcounts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(n-grams of each text that each language's filter passes, n-grams of
        each text, whether it has letters), in slices of bounded memory."""
        out = np.zeros((len(texts), len(self.langs)))
        number, lettered = np.zeros(len(texts), np.int64), np.zeros(len(texts), bool)
        for own, h, count, has in _slices(texts):
            lettered[own] |= has
            number[own] += count
            full = np.flatnonzero(count)
            if not len(full):
                continue
            first = (np.cumsum(count) - count)[full]
            at = _places(h)
            for w, slots in enumerate(self.words):
                mask = slots[at[0]]
                for more in at[1:]:
                    mask &= slots[more]
                for i in range(64 * w, min(64 * w + 64, len(self.langs))):
                    bit = ((mask >> np.uint64(i % 64)) & np.uint64(1)).astype(np.int64)
                    out[own[full], i] += np.add.reduceat(bit, first)
        return out, number, lettered

    def evidence(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(corrected popcounts per text and language, whether it has letters)."""
        out, number, lettered = self.popcounts(texts)
        fp = self.false_positive()
        return np.maximum(0, (out - number[:, None] * fp) / (1 - fp + 1e-12)), lettered

    def speaks(self, texts: list[str | None]) -> list[bool]:
        """Whether some language is to be heard: there are letters, and the best
        filter passes ``HEARD`` of the n-grams beyond its false positives, and
        more of them than these would by chance (``MARGIN`` standard deviations).
        A text of fewer than ``FEW`` n-grams cannot show that and passes."""
        out, number, lettered = self.popcounts(texts)
        if not self.langs:
            return [False] * len(texts)
        fp, n = self.false_positive(), number[:, None]
        beyond = out - n * fp
        heard = (beyond >= HEARD * n * (1 - fp)) & (beyond > MARGIN * np.sqrt(n * fp * (1 - fp)))
        return (lettered & ((number < FEW) | heard.any(axis=1))).tolist()

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        found, lettered = self.evidence(texts)
        total = found.sum(axis=1)
        best = np.where(total > 0, found.argmax(axis=1), self.default)
        lang = [self.langs[b] if n else UNKNOWN for b, n in zip(best, lettered)]
        return lang, np.where(total > 0, found.max(axis=1) / np.maximum(total, 1e-9), 0.0).tolist()


def _usual(texts: list[str]) -> np.ndarray:
    """The n-grams in at least SHARE of the texts (two at least, if there are
    more texts), the most frequent NGRAMS of them."""
    grams, docs = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for _, h, count, _ in _slices(texts):
        ends = np.cumsum(count)
        seen = np.concatenate([grams, *(np.unique(h[e - c:e]) for e, c in zip(ends, count))])
        weight = np.concatenate([docs, np.ones(len(seen) - len(grams), np.int64)])
        grams, place = np.unique(seen, return_inverse=True)
        docs = np.bincount(place, weight, len(grams)).astype(np.int64)
    usual = docs >= min(len(texts), max(2, SHARE * len(texts)))
    order = np.lexsort((grams[usual], -docs[usual]))[:NGRAMS]
    return grams[usual][order]


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample: int = SAMPLE) -> Filters:
    """Filters from labelled rows that are not held out."""
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("text"),
                       F.col(f"`{lang_col}`").alias("lang")).where(
        "_id is not null and text is not null and lang is not null").where(
        F.pmod(text_id("_id"), F.lit(HELD_OUT)) != HELD).where(F.octet_length("text") <= SAMPLE_BYTES)
    # repeats of a row count once: a third of all rows may be one row
    place = F.pmod(F.xxhash64("_id", "text", F.lit(13)), F.lit(1 << 62))
    sizes = materialize(rows.select("lang", place.alias("place")).distinct().groupBy("lang").agg(
        F.count(F.lit(1)).alias("size")), "language-sizes")
    if sizes.limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages to learn")
    # the 2 * sample / size smallest hashes of each language, then exactly the smallest
    few = (rows.withColumn("place", place).join(F.broadcast(sizes), "lang")
           .where(F.col("place") < F.lit(float(1 << 62)) * F.lit(2.0 * sample) / F.col("size"))
           .groupBy("lang", "place").agg(F.first("text").alias("text"), F.first("size").alias("size")))

    def run(whole):
        got = sorted(zip(*(whole.column(c).to_pylist() for c in ("place", "text"))))[:sample]
        grams = _usual([t for _, t in got])
        return pa.Table.from_arrays([
            pa.array(whole.column("lang").to_pylist()[:1]), pa.array([grams.tobytes()], pa.binary()),
            pa.array(whole.column("size").to_pylist()[:1])], ["lang", "grams", "size"])

    found = few.select("lang", "place", "text", "size").groupBy("lang").applyInArrow(
        run, "lang string, grams binary, size long").collect()   # one bounded row per language
    return Filters.of({r.lang: np.frombuffer(bytes(r.grams), np.uint64) for r in found}, {r.lang: r.size for r in found})


def identify(docs: DataFrame, filters: Filters, text_col: str = "text", lang_out: str = "lang_pred",
             score_out: str = "lang_score") -> DataFrame:
    """``docs`` with the predicted language and its share of the evidence."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)   # SLOTS * 8 bytes per 64 languages

    def make(texts):
        return list(shared.value.predict(texts))
    return add_columns(docs, [T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())],
                       make, text_col)


def q_language(docs: DataFrame) -> DataFrame:
    found = identify(docs.select("doc_id", "text"), learn(docs), score_out="score")
    return found.select("doc_id", (F.pmod(text_id("doc_id"), F.lit(HELD_OUT)) == HELD).alias("held_out"),
                        "lang_pred", "score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows in which some learned language is to be heard (``Filters.speaks``);
    texts without a letter go."""
    filters = learn(docs)
    shared, hidden = docs.sparkSession.sparkContext.broadcast(filters), fresh(docs, "heard")

    def make(texts):
        return [shared.value.speaks(texts)]
    return add_columns(docs, [T.StructField(hidden, T.BooleanType())], make).where(F.col(hidden)).drop(hidden)
