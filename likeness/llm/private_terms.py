"""Personal data and the terms that give it away (operator 8).

Everything is DataFrame functions: no Python runs on rows.

1. Base spans (map-only): e-mail addresses, IP addresses, card and phone numbers
   by pattern and check (part sizes, Luhn, digit counts).  The patterns are
   written so that a match costs time linear in its length and no recursion:
   separators that cannot belong to a match are first exchanged, one character
   for one, for a character that ends it.  Positions are running sums of the
   lengths of matches and of what lies between.
2. A base value is a protected entity.  The words of a document are its terms,
   those that a base span covers left out.  Over the whole corpus, df(e), df(t)
   and df(t, e) count the documents with the entity, the term, and both.
3. A term's disclosure of an entity is its pointwise mutual information as a
   share of the entity's information content,
       log(N df(t, e) / (df(t) df(e))) / log(N / df(e)),
   1 for a term seen with that entity alone, and 0 for an independent one.  From
   ``DISCLOSURE`` on, every occurrence of the term, in whatever document, is a
   span of kind ``term``, with the highest disclosure of any entity.  No number
   of shared documents is asked for: an entity of a single document is disclosed
   by each word that few other documents hold.  ``sanitise`` puts a class in place of base spans, generalises
   terms above ``DISCLOSURE`` and removes those at or above ``REMOVAL``.

Counts are aggregated before they are shuffled, so a value or a word that a
third of all documents hold costs a row per task.  Places are looked for in the
documents that hold a disclosing term, and kept for such terms alone.

Edge cases: a null or empty text has no spans; repeated rows and ids are
documents of their own; an entity in every document discloses nothing (its
information content is 0); an empty table gives an empty result; extra columns
of any name pass through ``sanitise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from likeness.llm.common import materialize
from likeness.session import bounded_broadcast

DISCLOSURE, REMOVAL = 0.8, 0.98
RUN, BUCKETS = 256, 256         # see _placed, _occurrences
LISTED = 100_000               # terms, and entities, whose counts are broadcast
KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
_HOST = "[A-Za-z0-9-]"
_OCTET = "0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
_WORD = r"[\p{L}\p{N}][\p{L}\p{M}\p{N}]*"

# A dot outside a host name becomes "%", which is in no host name but, like the
# dot, in the part before "@"; a separator not between two digits ends a card.
_HOST_ENDS = rf"\.(?!{_HOST})|(?<!{_HOST})\."
_CARD_ENDS = r"[\x20-](?![0-9])|(?<![0-9])[\x20-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++\.[A-Za-z0-9.-]++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x20-]++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPANS = "array<struct<start:int,end:int,value:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total, i):
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^({_OCTET}\.){{3}}{_OCTET}$")
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _placed(pieces: Column) -> Column:
    """``pieces`` (gap, hit), in order, with the place ``start`` of each hit in code
    points.  A running sum that appends to an array copies it at every step; here
    pieces are summed in runs of ``RUN`` and the runs' totals once more, so the cost
    stays near the number of pieces."""
    size = lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["hit"]), F.lit(0))
    zero = F.lit(0)

    def sums(values):                    # what lies before each of ``values``, and the whole
        return F.aggregate(values, F.array(zero), lambda done, v: F.concat(done, F.array(F.element_at(done, -1) + v)))

    def cut(whole):
        last = F.greatest(zero, F.floor((F.size(whole) - 1) / RUN).cast("int"))
        return F.transform(F.sequence(zero, last), lambda r: F.slice(whole, r * RUN + 1, RUN))

    def place(run, offset):
        return _bound(sums(F.transform(run, size)), lambda inner: F.transform(run, lambda p, i: F.struct(
            (offset + F.element_at(inner, i + 1) + F.length(p["gap"])).alias("start"), p["hit"].alias("hit"))))

    found = _bound(pieces, lambda whole: _bound(cut(whole), lambda runs: _bound(
        sums(F.transform(runs, lambda run: F.aggregate(run, zero, lambda n, p: n + size(p)))),
        lambda before: F.flatten(F.transform(runs, lambda run, r: place(run, F.element_at(before, r + 1)))))))
    return F.filter(found, lambda p: p["hit"].isNotNull())


def _bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once: inside a lambda an expression
    is computed at every use."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pieces(text: Column, pattern: str) -> Column:
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))


def located(text: Column, pattern: str, valid=lambda v: F.lit(True)) -> Column:
    """(start, end, value) of all valid matches, in order; code points."""
    hits = F.filter(_placed(_pieces(text, pattern)), lambda p: valid(p["hit"]))
    return F.transform(hits, lambda p: F.struct(
        p["start"].alias("start"), (p["start"] + F.length(p["hit"])).alias("end"), p["hit"].alias("value"))).cast(SPANS)


def base_spans(text: Column) -> dict[str, Column]:
    """Spans of each kind in ``text`` (not null)."""
    shown = {"email": F.regexp_replace(text, _HOST_ENDS, "%"), "card": F.regexp_replace(text, _CARD_ENDS, "_")}
    hint = {"email": text.contains("@"), "phone": text.contains("+"),
            "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][\x20-]?[0-9]")}
    none = F.array().cast(SPANS)
    return {k: F.when(hint[k], located(shown.get(k, text), PATTERNS[k], lambda v, k=k: _valid(k, v))).otherwise(none)
            for k in KINDS}


def _uncovered(text: Column, spans: Column) -> Column:
    """``text`` with a space in place of every character in ``spans``."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def put(state, span):
        low, high = F.greatest(state["at"], span["start"]), F.greatest(state["at"], span["end"])
        return F.struct(high.alias("at"), F.concat(state["parts"], F.array(
            F.substring(text, state["at"] + 1, low - state["at"]), F.repeat(F.lit(" "), high - low))).alias("parts"))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(ordered, start, put, lambda s: F.concat(
        F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text)))))


def _terms(text: Column) -> Column:
    """Distinct terms of a text without its base spans."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(_WORD), F.lit(0)), F.lower))


def _occurrences(text: Column, rated: Column) -> Column:
    """(start, end, disclosure) of every occurrence of the terms in ``rated``, in
    order; code points.  ``rated`` maps a term's bucket to a map of its terms: a map
    is searched from end to end, so one of all terms would make a document of
    many terms quadratic."""
    share = lambda hit: F.try_element_at(F.try_element_at(rated, _bucket(F.lower(hit))), F.lower(hit))
    hits = F.transform(_placed(_pieces(text, _WORD)), lambda p: F.struct(
        p["start"].alias("start"), (p["start"] + F.length(p["hit"])).alias("end"), share(p["hit"]).alias("disclosure")))
    return F.filter(hits, lambda p: p["disclosure"].isNotNull())


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _found(docs: DataFrame, id_col: str, text_col: str, kept: list[str]) -> DataFrame:
    """Per row: ``uid``, base spans by kind, entities, the text without base
    spans, and ``kept`` columns.  Written once, which fixes ``uid``."""
    own = docs.select(F.col(f"`{id_col}`").alias("__id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("__text"),
                      F.struct(*(F.col(f"`{c}`") for c in kept), F.lit(0).alias("__end")).alias("__row"))
    each = own.select("*", *(v.alias(f"__{k}") for k, v in base_spans(F.col("__text")).items()))

    def entities(kind):
        return F.transform(f"__{kind}", lambda s: F.concat(F.lit(f"{kind}:"), F.lower(s["value"])))

    def places(kind):
        return F.transform(f"__{kind}", lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    out = each.withColumn("__spans", F.concat(*map(places, KINDS)))
    return materialize(out.select(
        F.monotonically_increasing_id().alias("__uid"), "__id", "__row", "__spans",
        _uncovered(F.col("__text"), F.col("__spans")).alias("__plain"),
        F.array_distinct(F.concat(*map(entities, KINDS))).alias("__entities")), "private-spans")


def _frequent(counts: DataFrame, key: str, number: str) -> tuple[DataFrame, int]:
    """The rows of the highest counts, by whole powers of two and at most
    ``LISTED`` of them, to be broadcast; and a bound that no other row exceeds."""
    power = F.floor(F.log2(F.col(number))).cast("int")
    levels = counts.groupBy(power.alias("p")).count().orderBy(F.desc("p")).collect()      # at most 63 rows
    total, low = 0, levels[0]["p"] + 1 if levels else 0
    for level in levels:
        total += level["count"]
        if total > LISTED:
            break
        low = level["p"]
    return F.broadcast(counts.where(F.col(number) >= F.lit(2 ** low)).select(key, number)), 2 ** low - 1


def disclosing_terms(found: DataFrame, disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, disclosure) of the pairs from ``disclosure`` on; counts
    run over all documents.

    As df(t, e) is at most df(e), a term reaches ``disclosure`` only if df(t) is
    at most df(e)^disclosure N^(1 - disclosure).  Pairs that cannot, by the
    counts of the most frequent terms and entities, are not shuffled."""
    count = F.count(F.lit(1))
    words = _terms(F.col("__plain"))
    total = float(max(1, found.count()))
    entities = materialize(found.select(F.explode("__entities").alias("entity")).groupBy("entity")
                           .agg(count.alias("with_entity")), "entity-counts")
    terms = materialize(found.select(F.explode(words).alias("term")).groupBy("term")
                        .agg(count.alias("with_term")), "term-counts")
    common_entities, rest = _frequent(entities, "entity", "with_entity")
    common_terms, _ = _frequent(terms, "term", "with_term")
    most = F.pow(F.coalesce("with_entity", F.lit(rest)).cast("double"), F.lit(disclosure)) * total ** (1 - disclosure)
    pairs = (found.where(F.size("__entities") > 0).select("__entities", words.alias("__terms"))
             .select(F.explode("__entities").alias("entity"), "__terms").join(common_entities, "entity", "left")
             .select("entity", (most * (1 + 1e-9)).alias("__most"), F.explode("__terms").alias("term"))
             .join(common_terms, "term", "left").where("with_term is null or with_term <= __most"))
    both = materialize(pairs.groupBy("entity", "term").agg(count.alias("both")),
                       "term-entity-counts")
    n = F.lit(total)
    content = F.log(n / F.col("with_entity"))
    shared = F.log(n * F.col("both") / (F.col("with_term") * F.col("with_entity")))
    rated = both.join(entities, "entity").join(terms, "term").where(content > 0)
    return rated.select("entity", "term", (shared / content).alias("disclosure")).where(F.col("disclosure") >= disclosure)


def private_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", kept: tuple[str, ...] = (),
                  disclosure: float = DISCLOSURE) -> DataFrame:
    """(__id, __row, spans) per row of ``docs``; ``spans`` holds kind, start, end
    and disclosure (null for base kinds): base kinds as listed, then terms,
    each by start."""
    found = _found(docs, id_col, text_col, list(kept))
    revealing = materialize(disclosing_terms(found, disclosure).groupBy("term")
                            .agg(F.max("disclosure").alias("disclosure")), "disclosing-terms")
    rated = (found.select("__uid", F.explode(_terms(F.col("__plain"))).alias("term"))
             .join(bounded_broadcast(revealing), "term").groupBy("__uid", _bucket(F.col("term")).alias("b"))
             .agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosure"))).alias("m")).groupBy("__uid")
             .agg(F.map_from_entries(F.collect_list(F.struct("b", "m"))).alias("__rated")))  # one document's terms
    span = "array<struct<kind:string,start:int,end:int,disclosure:double>>"
    base = F.transform("__spans", lambda s: F.struct(s["kind"], s["start"], s["end"], F.lit(None).cast("double"))).cast(span)
    places = _occurrences(F.col("__plain"), F.col("__rated"))
    more = F.when(F.col("__rated").isNotNull(), F.transform(places, lambda s: F.struct(
        F.lit("term"), s["start"], s["end"], s["disclosure"])).cast(span)).otherwise(F.array().cast(span))
    return found.join(rated, "__uid", "left").select("__id", "__row", F.concat(base, more).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def q_private(docs: DataFrame) -> DataFrame:
    """The query's counts and digests."""
    out = private_spans(docs)
    spans = F.col("spans")

    def number(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return out.select(
        F.col("__id").alias("doc_id"), *map(number, KINDS),
        F.sha2(_joined(F.filter(spans, lambda s: s["kind"] != "term")), 256).alias("base_sha256"),
        _joined(spans).alias("spans"))


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE,
             removal: float = REMOVAL) -> DataFrame:
    """``docs`` with classes in place of personal data, terms that disclose it
    generalised, and those at or above ``removal`` taken out."""
    out = private_spans(docs, id_col, text_col, tuple(docs.columns), disclosure)
    text = F.col(f"__row.`{text_col}`")

    def put(state, span):
        shown = (F.when(span["kind"] != "term", F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]")))
                 .when(span["disclosure"] >= removal, F.lit("")).otherwise(F.lit("[TERM]")))
        gap = F.substring(text, state["at"] + 1, F.greatest(F.lit(0), span["start"] - state["at"]))
        fresh = span["start"] >= state["at"]
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"),
                        F.when(fresh, F.concat(state["parts"], F.array(gap, shown))).otherwise(state["parts"]).alias("parts"))

    ordered = F.array_sort("spans", lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                           .when(a["end"] > b["end"], -1).when(a["end"] < b["end"], 1).otherwise(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    clean = F.aggregate(ordered, start, put, lambda s: F.concat(
        F.array_join(s["parts"], ""), F.substring(text, s["at"] + 1, F.length(text))))
    return out.select(*((clean if c == text_col else F.col(f"__row.`{c}`")).alias(c) for c in docs.columns))
