"""Token counts by rank-synchronous array merging (operator 12).

A byte-level BPE tokenizer cuts a text into pre-tokens and merges, within each
pre-token, the adjacent pair of symbols with the lowest rank until none is left.
Only counts are asked for, so nothing but array lengths has to survive:

1. Texts are cut at the tokenizer's special strings (one token each, as by
   default) and into pre-tokens, a slice at a time.
2. The pre-tokens that a worker has not met before are held as one ragged array
   of symbols.  In each round every sequence finds its lowest rank with one
   ``minimum.reduceat``, all pairs of that rank merge in all sequences at once,
   and only the pairs beside a merged symbol are looked up again.  Sequences
   without a pair left leave the arrays; their symbols are counted.
3. A sequence longer than ``LONG`` does not wait for its one lowest pair: a pair
   that is the lowest within ``reach`` symbols (the longest token) on both sides
   merges at once.  A token that could take one of its symbols away earlier
   would have to be built inside that window by lower ranks, and there are none.

Both steps need merges whose parts are made by earlier merges (checked when the
file is read; ``ValueError`` otherwise).  The work is map-only.  A worker
remembers at most ``CACHE`` pre-tokens; a slice holds ``SLICE`` of them.  Memory
is bounded by these, by the Arrow batch and by about 50 bytes per byte of the
longest single pre-token.

Edge cases: null and empty texts have no bytes and no tokens; rows with a null
or repeated id are counted one by one; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import itertools
import json

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from likeness.llm.common import arrow_map
from likeness.llm.packing import _byte_letters

LIMIT = 1024
LONG = 256                 # symbols from which a sequence merges by windows
SLICE = 1 << 17            # pre-tokens held at once
CACHE = 400_000            # pre-tokens whose counts one worker remembers
NONE = np.int32(2**31 - 1)

# Fixed value: the byte-level pre-token pattern of this family of tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CLASSES = {"L": regex.compile(r"\p{L}"), "N": regex.compile(r"\p{N}"), "S": regex.compile(r"\s")}
_STANDS_FOR = {"L": "é", "N": "²", "S": " ", "O": "¡"}


class Merges:
    """The merge table of a tokenizer file as arrays."""

    def __init__(self, spec: dict):
        vocab, letters = spec["model"]["vocab"], _byte_letters()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left, right, made = (np.array(x, np.int64) for x in zip(
            *((vocab[a], vocab[b], vocab[a + b]) for a, b in pairs)))
        rank = np.arange(len(pairs))
        last = np.full(len(vocab) + 1, -1)                    # latest merge that makes a token
        np.maximum.at(last, made, rank)
        if (np.maximum(last[left], last[right]) >= rank).any():
            raise ValueError("a merge comes before the merges that make its parts")
        self.size = len(vocab) + 1
        self.first = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        order = np.argsort(left * self.size + right, kind="stable")
        self.keys, self.ranks = (left * self.size + right)[order], rank[order].astype(np.int32)
        self.made = made.astype(np.int32)
        self.reach = max(map(len, vocab))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Symbols left in each word."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        out = np.zeros(len(words), np.int64)
        short = np.flatnonzero(size <= LONG)
        out[short] = self._together([words[i] for i in short], size[short])
        for i in np.flatnonzero(size > LONG):
            out[i] = self._windowed(words[i])
        return out

    def _together(self, words: list[bytes], size: np.ndarray) -> np.ndarray:
        out = np.zeros(len(words), np.int64)
        symbol = self.first[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
        rank = self._ranks(symbol, np.r_[owner[1:] == owner[:-1], False] if len(owner) else np.zeros(0, bool))
        while len(symbol):
            start = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            length = np.diff(np.r_[start, len(owner)])
            low = np.minimum.reduceat(rank, start)
            done = low == NONE
            out[owner[start[done]]] = length[done]
            hit = _alternate(rank == np.repeat(np.where(done, -1, low), length))
            keep = ~np.repeat(done, length)
            keep[np.flatnonzero(hit) + 1] = False
            symbol, owner, rank = self._merge(symbol, rank, hit, keep, owner)
        return out

    def _windowed(self, word: bytes) -> int:
        symbol = self.first[np.frombuffer(word, np.uint8)]
        rank = self._ranks(symbol, np.r_[np.ones(len(symbol) - 1, bool), False])
        while True:
            hit = (rank != NONE) & (rank == _least_around(rank, self.reach))
            if not hit.any():
                return len(symbol)
            # equal neighbours overlap and merge from the left of their run: a run
            # whose start has to wait waits as a whole
            run = np.r_[True, rank[1:] != rank[:-1]]
            blocked = np.maximum.accumulate(np.where(run, 0, np.arange(len(rank)) * ~hit))
            start = np.maximum.accumulate(np.where(run, np.arange(len(rank)), 0))
            hit &= (blocked < start) | (start == np.arange(len(rank)))
            hit &= hit[start] & ((np.arange(len(rank)) - start) % 2 == 0)
            keep = np.ones(len(symbol), bool)
            keep[np.flatnonzero(hit) + 1] = False
            symbol, _, rank = self._merge(symbol, rank, hit, keep)

    def _ranks(self, symbol: np.ndarray, joined: np.ndarray) -> np.ndarray:
        rank = np.full(len(symbol), NONE, np.int32)
        at = np.flatnonzero(joined)
        rank[at] = self.rank_of(symbol[at], symbol[at + 1])
        return rank

    def _merge(self, symbol, rank, hit, keep, owner=None):
        """Merge the hits, drop what ``keep`` leaves out and look up the pairs
        beside merged symbols again."""
        symbol[hit] = self.made[rank[hit]]
        symbol, rank, new = symbol[keep], rank[keep], hit[keep]
        owner = None if owner is None else owner[keep]
        if not len(symbol):
            return symbol, owner, rank
        stale = np.flatnonzero(new | np.r_[new[1:], False])
        rank[stale] = NONE
        at = stale[stale + 1 < len(symbol)]
        if owner is not None:
            at = at[owner[at] == owner[at + 1]]
        rank[at] = self.rank_of(symbol[at], symbol[at + 1])
        return symbol, owner, rank


def _alternate(hit: np.ndarray) -> np.ndarray:
    """Every other one of each run of hits, from its start: pairs that overlap
    merge from the left."""
    at = np.flatnonzero(hit)
    if len(at):
        start = np.maximum.accumulate(np.where(np.r_[True, np.diff(at) > 1], at, 0))
        hit[at[(at - start) % 2 == 1]] = False
    return hit


def _least_around(rank: np.ndarray, reach: int) -> np.ndarray:
    """Minimum within ``reach`` places on both sides, by doubling."""
    padded = np.concatenate([np.full(reach, NONE), rank, np.full(reach, NONE)])
    width, span = 2 * reach + 1, 1
    while span * 2 <= width:
        padded = np.minimum(padded[:-span], padded[span:])
        span *= 2
    return np.minimum(padded[:len(rank)], padded[width - span:width - span + len(rank)])


class Counter:
    """Token counts of whole texts under one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        added = spec.get("added_tokens") or []
        if (model.get("type") != "BPE" or before.get("type") != "ByteLevel" or spec.get("normalizer")
                or before.get("add_prefix_space") or not before.get("use_regex", True)
                or model.get("ignore_merges") or any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added)):
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        self.merges = Merges(spec)
        self.cut = Tokenizer.from_file(path).pre_tokenizer
        self.words = regex.compile(PATTERN)
        named = sorted((a["content"] for a in added), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, named))) if named else None
        self.known: dict[str, int] = {}
        self.usual: set[str] = set()          # characters that both pattern engines class alike
        self.odd: dict[int, str] = {}         # the others, with one that stands for them

    def _class(self, c: str) -> str:
        """The class of a character as the tokenizer's own pattern sees it."""
        spans = [s for _, s in self.cut.pre_tokenize_str(f"a{c}1")]
        if spans[0] == (0, 2):
            return "L"
        if spans[-1] == (1, 3):
            return "N"
        return "O" if len(self.cut.pre_tokenize_str(f"!{c}!")) == 1 else "S"

    def _stand_in(self, text: str) -> str:
        """``text`` with characters that the two engines' Unicode tables class
        differently replaced by one of the right class."""
        if text.isascii():
            return text
        for c in set(text).difference(self.usual):
            if c.isascii():
                self.usual.add(c)
            elif ord(c) not in self.odd:
                kind = self._class(c)
                if kind == next((k for k, p in _CLASSES.items() if p.match(c)), "O"):
                    self.usual.add(c)
                else:
                    self.odd[ord(c)] = _STANDS_FOR[kind]
        return text.translate(self.odd) if self.odd else text

    def _pieces(self, text: str):
        """Parts of a text between special strings, and None per special one."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield text[at:m.start()]
            yield None
            at = m.end()
        yield text[at:]

    def _slices(self, texts: list[str]):
        """(text number, pre-tokens) in slices; a special string is one None."""
        for i, text in enumerate(texts):
            for piece in self._pieces(text):
                if piece is None:
                    yield i, [None]
                    continue
                shown = self._stand_in(piece)
                if shown is piece or shown == piece:
                    found = (m.group() for m in self.words.finditer(piece))
                else:
                    found = (piece[m.start():m.end()] for m in self.words.finditer(shown))
                while part := list(itertools.islice(found, SLICE)):
                    yield i, part

    def counts(self, texts: list[str]) -> np.ndarray:
        out, held, size = np.zeros(len(texts), np.int64), [], 0
        for i, words in self._slices(texts):
            held.append((i, words))
            size += len(words)
            if size >= SLICE:
                self._add(out, held)
                held, size = [], 0
        self._add(out, held)
        return out

    def _add(self, out: np.ndarray, held: list) -> None:
        if len(self.known) > CACHE:
            self.known.clear()
        self.known[None] = 1
        new = list(set().union(*(words for _, words in held)).difference(self.known))
        found = self.merges.counts([w.encode("utf-8", "surrogatepass") for w in new])
        self.known.update(zip(new, found.tolist()))
        for i, words in held:
            out[i] += sum(map(self.known.__getitem__, words))


_COUNTERS: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(path)
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) per row of ``docs``.
    ``tokenizer_path`` must be readable on every executor."""
    def run(batch):
        texts = [t or "" for t in batch.column("text").to_pylist()]
        n = counter(tokenizer_path).counts(texts)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n), pa.array(n > limit)],
            ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    source = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return arrow_map(source.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
                                   .alias("n_bytes")), run,
                     "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
