import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from likeness.llm import token_counts as tc
from likeness.llm.common import table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, TEXTS, docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    return lambda texts: [len(e.ids) for e in made.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return tc.Counter(PATH)


def test_whole_table(spark, library):
    d = table(spark, SF_ORACLE, "documents")
    rows = d.select("doc_id", "text").collect()
    want = {r.doc_id: n for r, n in zip(rows, library([r.text or "" for r in rows]))}
    out = tc.count_tokens(d, PATH).collect()
    assert {r.doc_id: r.n_tokens for r in out} == want and len(out) == len(rows)
    size = {r.doc_id: len((r.text or "").encode()) for r in rows}
    assert all(r.n_bytes == size[r.doc_id] and r.over_limit == (r.n_tokens > 1024) for r in out)


def test_edge_rows(spark, library):
    out = tc.count_tokens(docs(spark), PATH).collect()
    got = sorted((r.doc_id, r.n_tokens) for r in out if r.doc_id is not None)
    assert [n for _, n in got] == library([t or "" for t in TEXTS]) and len(out) == len(TEXTS) + 1
    assert tc.count_tokens(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_mixed_characters(counter, library):
    rng = random.Random(7)
    parts = ["a", "e", "th", "the", "ing", " ", "  ", "\n", "\t", "'s", "'ll", "'", "<|endoftext|>", "<|endof", "é", "日本",
             "1", "23", "²", "½", "!", "==", "\x1c", "\x85", "　", "ΣΑΣ", "🙂", "​", "\0", "x", "՘", "\U0003fc2c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(5000)]
    assert counter.counts(texts).tolist() == library(texts)


def test_long_sequences_merge_by_windows(counter, library, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(2, 900)))
             for letters in ("abcdefghijklmnopqrstuvwxyz", "aeth", "!=-#*", ["a", "aa", "in", "=", "==="]) for _ in range(60)]
    texts += [c * k for c in "x =\n" for k in (257, 300, 511, 640, 5000)]
    assert counter.counts(texts).tolist() == library(texts)
    monkeypatch.setattr(tc, "LONG", 1)                 # every sequence by windows
    monkeypatch.setattr(counter, "known", {})
    assert counter.counts(texts).tolist() == library(texts)


def test_slices_and_forgetting(counter, library, monkeypatch):
    monkeypatch.setattr(tc, "SLICE", 7)
    monkeypatch.setattr(tc, "CACHE", 20)
    texts = ["some words of a text, " * 30, "", "<|endoftext|>" * 9, "other words " * 20]
    assert counter.counts(texts).tolist() == library(texts)


def test_minimum_around():
    rng = np.random.default_rng(0)
    for n, reach in ((1, 3), (10, 1), (50, 128), (300, 7)):
        rank = rng.integers(0, 50, n).astype(np.int32)
        want = [rank[max(0, i - reach):i + reach + 1].min() for i in range(n)]
        assert tc._least_around(rank, reach).tolist() == want


def test_a_merge_before_its_parts_is_refused():
    spec = {"model": {"vocab": {c: i for i, c in enumerate([*tc._byte_letters().values(), "ab", "abc"])},
                      "merges": [["ab", "c"], ["a", "b"]]}}
    with pytest.raises(ValueError):
        tc.Merges(spec)
