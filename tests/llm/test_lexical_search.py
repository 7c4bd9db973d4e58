import re
from collections import Counter, defaultdict

import pytest

from likeness.llm import lexical_search as ls
from tests.llm.helpers import DOCS, TEXTS, docs

ITEMS = "item_id long, text string, doc_id long, Score string"


def words(text):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))


def plain(rows, items, k=50):
    """{item: [(doc_id, score)]} over all documents; ``items`` are (id, text)."""
    held = [(i, Counter(words(t))) for i, t in rows if words(t)]
    total, df = sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    out = defaultdict(list)
    for item, text in items:
        scored = []
        for i, c in held:
            m = 100 - 50 + 50 * sum(c.values()) * len(held) // total
            score = sum(ls.term_weight(df[t], len(held)) * (1000000000 * c[t] // (1000 * c[t] + 20 * m))
                        for t in set(words(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out[item] += [(None if none else i, -s) for s, none, i in sorted(scored)[:k]]
    return dict(out)


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.item_id, r["rank"])):
        out[r.item_id].append((r.doc_id, r.score))
        assert r["rank"] == len(out[r.item_id])
    return dict(out)


def corpus(n=400):
    return [f"{'common ' * (i % 5 + 1)}w{i % 40} W{i % 7}, x{i}-é{i % 90} " + f"rare{i // 9} " * (i % 3) for i in range(n)]


@pytest.mark.parametrize("block,owners,bundle", [(4096, ls.OWNERS, 256), (16, (2500, 1000), 3), (7, (), 1)])
def test_equals_plain_ranking(spark, monkeypatch, block, owners, bundle):
    monkeypatch.setattr(ls, "BLOCK", block)
    texts = corpus() + TEXTS + ["same text twice"] * 70        # ties and copies
    items = [(0, "W3 x7 rare5 common"), (1, "é4 é5 same text"), (2, ""), (3, None), (4, "no such word"),
             (5, "Common COMMON common"), (6, "twice text"), (7, "x1 x2 x3 rare1 rare2 w5")]
    d = docs(spark, texts)
    rows = [(r.doc_id, r.text) for r in d.collect()]
    q = spark.createDataFrame([(*x, None, "clash") for x in items + [items[0]]], ITEMS)
    want = {i: v for i, v in plain(rows, items).items() if v}
    assert found(ls.search(d, q, owners=owners, bundle=bundle)) == want


def test_items_unknown_to_the_tasks_give_the_same(spark, monkeypatch):
    texts, items = corpus(120), [(i, f"w{i} rare{i} common") for i in range(30)]
    d, q = docs(spark, texts), spark.createDataFrame([(*x, None, "c") for x in items], ITEMS)
    want = found(ls.search(d, q, k=5))
    monkeypatch.setattr(ls, "KNOWN_TERMS", 3)
    assert found(ls.search(d, q, k=5)) == want == plain([(r.doc_id, r.text) for r in d.collect()], items, k=5)


def test_empty_tables(spark):
    d, q = docs(spark), spark.createDataFrame([(1, "plain words", None, "c")], ITEMS)
    assert ls.search(d, spark.createDataFrame([], ITEMS)).count() == 0
    assert ls.search(spark.createDataFrame([], DOCS), q).count() == 0
    assert ls.search(docs(spark, [None, "", " ,"]).where("doc_id is not null"), q).count() == 0


def test_slices_cut_between_terms(monkeypatch):
    text = "ab,cd  ef" * 50 + "é" * 30
    want = ls.counted(text)
    monkeypatch.setattr(ls, "SLICE", 3)
    assert ls.counted(text) == want and want[0] == len(words(text))
