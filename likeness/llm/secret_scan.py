"""Secret scan with a trigram inverted index (operator 6).

Every rule is a regular expression.  ``trigram_query`` derives from its syntax
tree a Boolean query over trigrams that each match must contain.  Documents are
indexed in segments (one Arrow batch each, held in the task that read it): the
segment's inverted file posts, for every trigram that some rule asks for, the
documents holding it; a rule's query is answered by intersecting and uniting
postings, and only the candidates are verified with the regular expression.
Rules without a mandatory trigram scan every document.  Text is never shuffled
and a segment's memory is bounded by the batch size.

Edge cases: a null text is an empty one (no spans); an empty table gives an
empty result; repeated rows are scanned one by one; other columns pass through.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likeness.llm.common import add_columns

MAX_EXACT = 64   # strings an exact set may hold before it is turned into a query
MAX_CLASS = 10   # characters a class may hold to be spelled out


@dataclass(frozen=True)
class Rule:
    """``value``: group holding the secret itself; ``least``: its least length;
    ``total``: least length of the whole match."""
    kind: str
    pattern: str
    value: int = 0
    least: int = 0
    total: int = 0


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _any_case("api") + "_?" + _any_case("key")

# A key runs to its END line, whatever stands between; without one, over the
# base64 lines that follow, of which there may be none.
_PEM = r"(?:[A-Z]+ )*PRIVATE KEY-----"
_PEM_LINES = r"(?:(?:\s|\\[nr])*[A-Za-z0-9+/]{16,}={0,2})*"

# The three base rules, then the rules of this operator.
BASE = (
    Rule("assign", rf"({_KEYS})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", value=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]+", total=20),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}"),
)
EXTRA = (
    Rule("pem", rf"-----BEGIN {_PEM}(?:[^-]*+(?:-(?!----)[^-]*+)*+-{{5,}}END {_PEM}|{_PEM_LINES})"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("maps", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pay", r"[sr]k_live_[0-9a-zA-Z]{24,}"),
    Rule("url", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:([^\s/:@]+)@", value=1),
)
RULES = BASE + EXTRA

ALL = ("all",)


def _and(parts):
    parts = [p for p in parts if p != ALL]
    return ALL if not parts else parts[0] if len(parts) == 1 else ("and", tuple(dict.fromkeys(parts)))


def _or(parts):
    parts = list(dict.fromkeys(parts))
    return ALL if ALL in parts or not parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _of_strings(strings) -> tuple:
    """Every match holds one of ``strings``."""
    return _or([_and([("tri", s[i:i + 3]) for i in range(len(s) - 2) if s[i:i + 3].isascii()]) for s in strings])


def _class(items) -> set[str] | None:
    out: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            out.add(chr(arg).lower())
        elif op is sre.RANGE and arg[1] - arg[0] < MAX_CLASS:
            out |= {chr(c).lower() for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return out if len(out) <= MAX_CLASS else None


def _walk(nodes) -> tuple[set[str] | None, tuple]:
    """(strings that a sequence matches exactly, or None; its query)."""
    run, queries, whole = {""}, [], True
    for op, arg in nodes:
        exact, query, ends = None, ALL, False
        if op is sre.LITERAL:
            exact = {chr(arg).lower()}
        elif op is sre.IN:
            exact = _class(arg)
        elif op in (sre.AT, sre.ASSERT, sre.ASSERT_NOT):
            exact = {""}
        elif op is sre.SUBPATTERN:
            exact, query = _walk(arg[3])
        elif op is sre.BRANCH:
            found = [_walk(x) for x in arg[1]]
            exact = None if any(e is None for e, _ in found) else set().union(*(e for e, _ in found))
            query = _or([q if e is None else _of_strings(e) for e, q in found])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
            low, high, sub = arg
            inner, within = _walk(sub)
            if inner is not None and high == 1:
                exact = inner | ({""} if low == 0 else set())
            elif low:
                query = within if inner is None else ALL
                if inner is not None and len(run) * len(inner) <= MAX_EXACT:
                    run, ends = {a + b for a in run for b in inner}, True
        if exact is not None and len(run) * len(exact) <= MAX_EXACT:
            run = {a + b for a in run for b in exact}
            continue
        if exact is not None:                       # too many strings: close the run, open another
            queries.append(_of_strings(run))
            run, whole = exact, False
            continue
        queries += [_of_strings(run), query]
        run, whole = {""}, False
    if whole:
        return run, _of_strings(run)
    return None, _and([*queries, _of_strings(run)])


def trigram_query(pattern: str) -> tuple:
    """Boolean trigram query (lower case) that every match of ``pattern``
    satisfies: ``("all",)``, ``("tri", t)``, ``("and", parts)`` or
    ``("or", parts)``."""
    return _walk(_parser.parse(pattern))[1]


def _trigrams(query) -> set[str]:
    if query[0] == "tri":
        return {query[1]}
    return set().union(*map(_trigrams, query[1])) if query[0] in ("and", "or") else set()


def _code(tri: str) -> int:
    a, b, c = tri.encode("ascii")
    return a << 16 | b << 8 | c


SLICE = 1 << 19                     # bytes indexed at once


class Segment:
    """Inverted file of one batch of texts over the trigrams the rules ask for."""

    def __init__(self, texts: list[str], slots: np.ndarray, n_terms: int):
        self.n = len(texts)
        pairs = [np.zeros(0, np.int64), *(self._pairs(part, slots) for part in self._slices(texts))]
        pairs = np.unique(np.concatenate(pairs))
        terms, docs = pairs // max(1, self.n), pairs % max(1, self.n)
        cuts = np.searchsorted(terms, np.arange(1, n_terms + 2))
        self.post: list[np.ndarray] = [docs[cuts[i]:cuts[i + 1]] for i in range(n_terms)]

    @staticmethod
    def _slices(texts: list[str]):
        """[(text number, bytes)] of about ``SLICE`` bytes; a longer text comes in
        parts that share two bytes, so that every trigram is in one."""
        held, size = [], 0
        for i, text in enumerate(texts):
            data = text.encode().lower()                    # bytes.lower folds A-Z alone
            for at in range(0, max(1, len(data) - 2), SLICE):
                held.append((i, data[at:at + SLICE + 2]))
                size += len(held[-1][1])
                if size >= SLICE:
                    yield held
                    held, size = [], 0
        yield held

    def _pairs(self, part: list[tuple[int, bytes]], slots: np.ndarray) -> np.ndarray:
        """Distinct term * n + text of one slice."""
        raw = np.frombuffer(b"".join(d for _, d in part), np.uint8).astype(np.uint32)
        if len(raw) < 3:
            return np.zeros(0, np.int64)
        own, ends = np.array([i for i, _ in part], np.int64), np.cumsum([len(d) for _, d in part], dtype=np.int64)
        term = slots[(raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]]
        at = np.flatnonzero(term)
        piece = np.searchsorted(ends, at, side="right")
        inside = at + 3 <= ends[piece]                      # not across two pieces
        return np.unique(term[at[inside]].astype(np.int64) * self.n + own[piece[inside]])

    def answer(self, query, number: dict[str, int]) -> np.ndarray:
        if query == ALL:
            return np.arange(self.n)
        if query[0] == "tri":
            return self.post[number[query[1]]]
        found = sorted((self.answer(q, number) for q in query[1]), key=len)
        out = found[0]
        for other in found[1:]:
            out = np.intersect1d(out, other, assume_unique=True) if query[0] == "and" else np.union1d(out, other)
        return out


class Scanner:
    """Compiled rules, their queries and the table from trigram to posting."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.compiled = [re.compile(r.pattern) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        terms = sorted(set().union(*map(_trigrams, self.queries)))
        self.number = {t: i for i, t in enumerate(terms)}
        self.slots = np.zeros(1 << 24, np.uint8 if len(terms) < 255 else np.uint16)
        for t, i in self.number.items():
            self.slots[_code(t)] = i + 1

    def scan(self, texts: list[str]) -> list[list[tuple]]:
        """Per text: (start, rule number, end, value start, value end), sorted."""
        segment = Segment(texts, self.slots, len(self.number))
        spans: list[list[tuple]] = [[] for _ in texts]
        for k, (rule, rx, query) in enumerate(zip(self.rules, self.compiled, self.queries)):
            for doc in segment.answer(query, self.number):
                for m in rx.finditer(texts[doc]):
                    a, b = m.span(rule.value)
                    if b - a >= rule.least and m.end() - m.start() >= rule.total:
                        spans[doc].append((m.start(), k, m.end(), a, b))
        for found in spans:
            found.sort()
        return spans


_SCANNERS: dict[tuple, Scanner] = {}   # per Python worker: the trigram table is built once


def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _SCANNERS:
        _SCANNERS[rules] = Scanner(rules)
    return _SCANNERS[rules]


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                     T.StructField("end", T.LongType()), T.StructField("value_start", T.LongType()),
                     T.StructField("value_end", T.LongType())])


def find_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``secrets``: the spans found in each whole text, by start
    and then by rule, offsets in code points, ends exclusive."""
    def make(texts):
        found = _scanner(rules).scan([t or "" for t in texts])
        return [[[{"kind": rules[k].kind, "start": s, "end": e, "value_start": a, "value_end": b}
                  for s, k, e, a, b in spans] for spans in found]]
    return add_columns(docs, [T.StructField("secrets", T.ArrayType(SPAN))], make, text_col)


def redact_secrets(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES,
                   mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret value in the text replaced by ``mark``
    (overlapping values once); a null text stays null."""
    def make(texts):
        out = []
        for text, spans in zip(texts, _scanner(rules).scan([t or "" for t in texts])):
            parts, at = [], 0
            for a, b in sorted((a, b) for *_, a, b in spans):
                if a >= at:
                    parts += [text[at:a], mark]
                at = max(at, b)
            out.append(text if not parts else "".join(parts) + text[at:])
        return [out]
    order = docs.columns
    return add_columns(docs, [T.StructField(text_col, T.StringType())], make, text_col).select(
        *(F.col(f"`{c}`") for c in order))


def q_secrets(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Digest columns of the query, taken from the operator's spans."""
    base = [r.kind for r in BASE]
    found = find_secrets(docs.select(F.col(id_col).alias("doc_id"), "text")).drop("text")

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id", *map(count, base),
        F.sha2(joined(F.filter("secrets", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"))
