import hashlib

import public_tokenizers
import sentencepiece

from likeness.llm import pieces
from likeness.llm.common import table
from tests.conftest import SF_SMALL
from tests.llm.helpers import DOCS, TEXTS, docs

PATH = public_tokenizers.path("piece_bpe_32k.model")


def test_equal_to_the_library(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    out = pieces.encode_documents(docs(spark), PATH, block_bytes=200).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        text = "no id here" if r.doc_id is None else TEXTS[r.doc_id] or ""
        assert r.ids == sp.encode(text), text
        assert r.decoded == sp.decode(sp.encode(text)) and r.n_tokens == len(r.ids)


def test_digests_on_a_whole_table(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    d = table(spark, SF_SMALL, "documents")
    texts = {r.doc_id: r.text or "" for r in d.select("doc_id", "text").collect()}
    out = pieces.encode_documents(d, PATH, digest=True, block_bytes=50_000, reread=True).collect()
    assert sorted(out) == sorted(pieces.encode_documents(d, PATH, digest=True, block_bytes=50_000).collect())
    assert len(out) == len(texts)
    for r in out:
        ids = sp.encode(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_empty_table(spark):
    assert pieces.encode_documents(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_words_join_back():
    sp = pieces.model(PATH)
    for text in TEXTS:
        words = pieces.marked_words(sp, text or "")
        assert " ".join(words).replace(" ", "▁") == sp.normalize(text or "")[1:]
