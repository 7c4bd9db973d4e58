import zlib
from collections import defaultdict
from string import punctuation

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from likeness.llm import packing
from likeness.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, TEXTS, docs

PATH = public_tokenizers.path("word_bpe_49k.json")


def _whole(text):
    return [*Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids, 1]


def _check(rows, texts):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, parts in by_doc.items():
        ids, at = np.array(_whole(texts[doc]), "<u4"), 0
        for p in sorted(parts, key=lambda r: r.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes()), texts[doc]
            at += p.length
        assert at == len(ids)
    for parts in by_seq.values():
        at = 0
        for p in sorted(parts, key=lambda r: r.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.LENGTH and len(parts) <= packing.MAX_SEGMENTS
    return by_seq


def test_edge_texts(spark):
    texts = {i: t or "" for i, t in enumerate(TEXTS)} | {None: "no id here"}
    _check(packing.pack_documents(docs(spark), PATH).collect(), texts)


def test_whole_table_and_padding(spark):
    d = table(spark, SF_SMALL, "documents")
    texts = {r.doc_id: r.text or "" for r in d.select("doc_id", "text").collect()}
    by_seq = _check(packing.pack_documents(d, PATH).collect(), texts)
    used = sum(p.length for parts in by_seq.values() for p in parts)
    assert used >= 0.95 * packing.LENGTH * len(by_seq)


def test_limits_in_every_dimension(spark):
    rng = np.random.default_rng(1)
    size = rng.integers(1, 600, 3000)
    loss = (size * rng.random(3000)).astype(int)
    ex = spark.createDataFrame([(i, int(s), int(x)) for i, (s, x) in enumerate(zip(size, loss))],
                               "k long, tokens long, loss long")
    out = packing.pack(ex, "k", "tokens", "loss", max_segments=6, max_loss=900, group=500).toPandas()
    assert len(out) == 3000
    per = out.groupby("sequence_id").agg(t=("tokens", "sum"), n=("k", "size"), x=("loss", "sum"))
    assert per.t.max() <= 2048 and per.n.max() <= 6 and per.x.max() <= 900


def test_too_large_and_empty():
    with pytest.raises(ValueError):
        packing.fill(np.array([[3000.0, 1, 0]]), np.array([2048.0, 64, 2048]))
    assert len(packing.fill(np.zeros((0, 3)), np.array([2048.0, 64, 2048]))[0]) == 0


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], DOCS), PATH).count() == 0


def _ids(words, texts, at_once):
    return [list(ids) for at in range(0, len(texts), at_once) for ids in words.ids(pa.array(texts[at:at + at_once]))]


def test_remembered_words_are_bounded(monkeypatch):
    """Long words used to count like short ones, and whole texts were remembered as words."""
    monkeypatch.setattr(packing, "CACHE_WORDS", 500)
    monkeypatch.setattr(packing, "CACHE_IDS", 3000, raising=False)
    texts = [" ".join(f"w{'abcdefghij'[i % 10] * (i // 10 + 1)}{'klmnopqrst'[j % 10] * (j // 10 + 1)}"
                      for j in range(40)) for i in range(60)]
    texts += ["a1" * 1000 + f"b{i}" for i in range(40)] + ["\x1c" + f"long {i} " * 300 for i in range(40)]
    whole, words = Tokenizer.from_file(PATH), packing._Words(PATH)
    found = []
    for at in range(0, len(texts), 2):
        found += _ids(words, texts[at:at + 2], 2)
        remembered = [*words, *words.earlier[0]]
        assert len(remembered) <= 2 * (500 + 2 * 2 * 40)
        assert sum(map(len, remembered)) < 10 * 2002 + 10_000
    assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_are_exact_when_most_are_forgotten(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 7)
    marks = [f"{w}{a}{b}" for w in ("", "word", "Ünï", "İx", "x²") for a in punctuation for b in ("", "'", "*", "s")]
    texts = [t or "" for t in TEXTS] + [" ".join(marks), *marks, "Hello hello HELLO, hello,", "\u2003a\x85b\xa0"] * 2
    whole = Tokenizer.from_file(PATH)
    for at_once in (1, 50):
        found = _ids(packing._Words(PATH), texts, at_once)
        assert found == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_reader_holds_few_texts_while_pieces_are_written(spark, monkeypatch):
    seen, real, rows = [], packing.materialize, spark.conf.get(packing.READER_ROWS)
    monkeypatch.setattr(packing, "materialize", lambda df, name: (
        seen.append(int(spark.conf.get(packing.READER_ROWS))), real(df, name))[1])
    packing.pack_documents(docs(spark), PATH)
    assert seen and max(seen) <= packing.TEXTS_AT_ONCE
    assert spark.conf.get(packing.READER_ROWS) == rows
