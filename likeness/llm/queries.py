"""Registered queries of this subpackage: one per operator, and the pipeline."""

from __future__ import annotations

import public_tokenizers

from likeness.llm import (chat, language, lattice, lexical_search, merkle, packing, permutation_index, pieces,
                          private_terms, quality, secret_scan, token_counts)
from likeness.llm import near_duplicates as near
from likeness.llm.common import table


def op1_sentencepiece(spark, sf_dir):
    return pieces.encode_documents(table(spark, sf_dir, "documents"),
                                   public_tokenizers.path("piece_bpe_32k.model"), digest=True, reread=True)


def op2_nearest(spark, sf_dir):
    return permutation_index.q_nearest(table(spark, sf_dir, "embeddings"))


def op3_quality(spark, sf_dir):
    return quality.q_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_chat(spark, sf_dir):
    return chat.q_chat(table(spark, sf_dir, "conversations"))


def op5_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_secrets(spark, sf_dir):
    return secret_scan.q_secrets(table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark, sf_dir):
    return near.near_duplicates(table(spark, sf_dir, "documents"))


def op8_private(spark, sf_dir):
    return private_terms.q_private(table(spark, sf_dir, "documents"))


def op9_language(spark, sf_dir):
    return language.q_language(table(spark, sf_dir, "documents"))


def op10_near_vectors(spark, sf_dir):
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_merkle(spark, sf_dir):
    return merkle.q_merkle(table(spark, sf_dir, "documents"))


def op12_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op13_lexical(spark, sf_dir):
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_nearest": op2_nearest,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_packing": op5_packing,
    "op6_secrets": op6_secrets,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_private": op8_private,
    "op9_language": op9_language,
    "op10_near_vectors": op10_near_vectors,
    "op11_merkle": op11_merkle,
    "op12_token_counts": op12_token_counts,
    "op13_lexical": op13_lexical,
}

ORACLE_SQL: dict[str, str] = {
    "op4_chat": chat.Q_CHAT_SQL,
    "op11_merkle": merkle.Q_MERKLE_SQL,
    "op13_lexical": lexical_search.Q_LEXICAL_SQL,
}
