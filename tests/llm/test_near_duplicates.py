import re
from functools import partial

import numpy as np
import pytest

from likeness.llm import near_duplicates as nd
from likeness.llm.common import materialize, table
from likeness.llm.graph import components
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, docs


def brute(texts, words=4, similarity=80):
    """{id: (set size, component)} by comparing all sets that share a shingle."""
    sets = {}
    for i, t in texts.items():
        w = [x for x in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets[i] = {tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    parent = {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    by = {}
    for i, s in sets.items():
        for g in s:
            by.setdefault(g, []).append(i)
    pairs = {(a, b) for ids in by.values() for a in ids for b in ids if a < b}
    for a, b in pairs:
        both = len(sets[a] & sets[b])
        if 100 * both >= similarity * (len(sets[a]) + len(sets[b]) - both):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in texts}


def test_whole_table(spark):
    d = table(spark, SF_ORACLE, "documents")
    want = brute({r.doc_id: r.text for r in d.select("doc_id", "text").collect()})
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in nd.near_duplicates(d).collect()}
    assert got == want


def test_edge_rows(spark):
    long = "alpha beta gamma delta " + " ".join(f"w{i}" for i in range(200))
    texts = [None, "", "  \n", "one two", "ONE  two", "one two three", long, long + " tail", long.upper(), "é É"]
    out = {r.doc_id: r for r in nd.near_duplicates(docs(spark, texts)).collect()}
    assert [out[i].component_id for i in range(10)] == [0, 1, 2, 3, 3, 5, 6, 6, 6, 9]
    assert [out[i].n_shingles for i in (0, 1, 2, 3, 5)] == [0, 0, 0, 1, 1]
    assert out[None].component_id is None and out[None].kept
    assert [i for i in range(10) if not out[i].kept] == [4, 7, 8]


def test_one_large_group_and_repeated_ids(spark):
    body = [f"w{i}" for i in range(300)]
    texts = [" ".join(body[:k % 50] + [f"x{k}"] + body[k % 50 + 1:]) for k in range(300)] + ["other words here now"] * 40
    d = docs(spark, texts)
    d = d.union(d)
    out = nd.near_duplicates(d).where("doc_id is not null").collect()
    assert len(out) == 340
    assert {r.component_id for r in out if r.doc_id < 300} == {0}
    assert {r.component_id for r in out if r.doc_id >= 300} == {300}


def family(n=260, words=120, seed=3):
    """Near copies of one text at all distances, many of them linked with nobody."""
    rng = np.random.default_rng(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        text = list(base) + [f"y{k}"] * (k % 3 == 0)
        for at in rng.choice(words, rng.integers(0, 14), replace=False):
            text[at] = f"x{k}-{at}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("block,size,carried", [(nd.BLOCK, nd.FAMILY, nd.WHOLE_SET), (16, nd.FAMILY, 116), (16, 10, 0)])
def test_a_family_of_far_and_near_copies(spark, monkeypatch, block, size, carried):
    monkeypatch.setattr(nd, "cells", partial(nd.cells, block=block))
    monkeypatch.setattr(nd, "WHOLE_SET", carried)      # all sets, some sets, no sets come along
    monkeypatch.setattr(nd, "FAMILY", size)            # 10: the family is met key by key
    texts = family() + ["one two three four five " * 3] * 3
    want = brute(dict(enumerate(texts)))
    assert 20 < len({c for _, c in want.values()}) < 250
    for sketches in (True, False):
        got = nd.near_duplicates(docs(spark, texts).where("doc_id is not null"), sketches=sketches).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_a_pair_leaves_at_one_key_alone(spark, monkeypatch):
    """Every pair of different components that shares a key, once, in any dealing."""
    texts = family(60, seed=8)
    d = docs(spark, texts).where("doc_id is not null").selectExpr("doc_id id", "text")
    found = nd.signatures(d, "id").selectExpr("doc_id id", "n_shingles n", "sig")
    sig = {r.id: np.frombuffer(bytes(r.sig), "<u2") for r in found.collect()}
    keys = {i: set(nd._keys_of(s[None, :])[0].tolist()) for i, s in sig.items()}
    want = {(a, b) for a in sig for b in sig if a < b and a % 7 != b % 7 and keys[a] & keys[b]}
    members = nd.chunk_keys(found).selectExpr("key", "id", "id % 7 component")
    for block, size in ((nd.BLOCK, nd.FAMILY), (5, nd.FAMILY), (nd.BLOCK, 1), (5, 1)):
        monkeypatch.setattr(nd, "FAMILY", size)
        monkeypatch.setattr(nd, "cells", partial(nd.cells.func if isinstance(nd.cells, partial) else nd.cells, block=block))
        got = [(r.id1, r.id2) for r in nd._across(members, found, d, 4, 0, sketches=False).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_rows_with_maps_and_clashing_names(spark):
    d = spark.sql("""select * from values (1L, 'a b c d e f', map('k', 1), 'x', 1), (1L, 'a b c d e f', map('j', 2), 'x', 1),
                     (2L, 'A b c d e f', map('k', 1), 'x', 2), (null, 'a b c d e f', null, 'x', 3)
                     as t(doc_id, text, tags, near_id, n)""")
    out = nd.keep_one(d).collect()
    assert nd.keep_one(d).columns == d.columns and sorted((r.doc_id or 0, r.n) for r in out) == [(0, 3), (1, 1)]


@pytest.mark.parametrize("edges,want", [
    ([], {}), ([(1, 1)], {}), ([(3, 2), (2, 1), (9, 8)], {1: 1, 2: 1, 3: 1, 8: 8, 9: 8}),
    ([(i, i + 1) for i in range(60)], {i: 0 for i in range(61)}),
    ([(0, i) for i in range(1, 50)] + [(100, 49)], {**{i: 0 for i in range(50)}, 100: 0}),
])
def test_components(spark, edges, want):
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r.id: r.component for r in got} == want and len(got) == len(want)


def test_rounds_grow_with_the_logarithm_of_the_chain(spark, monkeypatch):
    from likeness.llm import graph

    rounds = []
    monkeypatch.setattr(graph, "materialize", lambda df, name: rounds.append(name) or materialize(df, name))
    for n in (16, 256):
        rounds.clear()
        edges = spark.createDataFrame([(i, i + 1) for i in range(n)], "u long, v long")
        assert {r.component for r in graph.components(edges).collect()} == {0}
        assert len(rounds) <= 2 + n.bit_length()


def test_empty_table(spark):
    assert nd.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0
