"""Quality network and language filters: held-out accuracy, gradient, edge rows."""

import zlib

import numpy as np

from likeness.llm import language, quality
from likeness.llm.common import table
from tests.conftest import SF_ORACLE
from tests.llm.helpers import DOCS, TEXTS, docs

LABELS = "doc_id long, quality int, toxic int"


def test_quality_on_held_out_rows(spark):
    d, labels = (table(spark, SF_ORACLE, n) for n in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    out = quality.q_quality(d, labels).collect()
    assert len(out) == d.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    held = [r.predicted == truth[r.doc_id] for r in out if r.held_out and r.doc_id in truth]
    assert np.mean(held) >= 0.9


def test_quality_reads_the_whole_text_in_any_split():
    net = quality.Network(3)
    texts = [None, "", "a", "ab" * 400, "x" * 255 + "é" * 3000, "plain words " * 5000]
    alone = [net.score([t])[0] for t in texts]
    assert np.allclose(net.score(texts), alone, atol=1e-5)
    assert np.allclose(net.score(texts, net.pair_tables()), alone, atol=1e-4)
    long = "plain words " * 20000
    assert net.score([long])[0] != net.score([long + "#@!~" * 300])[0]


def test_quality_gradient_is_the_slope_of_the_loss():
    """Every parameter, the learned filters included, in double precision.  Random
    bytes leave no two windows of a segment with one value, so no maximum is tied."""
    rng = np.random.default_rng(9)
    texts = ["".join(map(chr, rng.integers(32, 127, n))) for n in (900, 300, 40, 1500)]
    y = np.array([1, 0, 1, 0], np.float64)
    net = quality.Network(5)
    net.p = {k: v.astype(np.float64) + rng.normal(0, 0.05, v.shape) for k, v in net.p.items()}
    grad = net.gradient(texts, y)

    def loss():
        p = net.score(texts)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))
    for name, values in net.p.items():
        assert grad[name].dtype == np.float64
        large = np.argsort(-np.abs(grad[name]).ravel())[:6]
        for at in map(tuple, np.stack(np.unravel_index(large, values.shape), 1)):
            values[at] += 1e-6
            up = loss()
            values[at] -= 2e-6
            down = loss()
            values[at] += 1e-6
            assert abs((up - down) / 2e-6 - grad[name][at]) < 1e-5 * max(1, abs(grad[name][at])), (name, at)


def test_quality_without_labels_or_rows(spark):
    none = spark.createDataFrame([], LABELS)
    assert {r.score for r in quality.q_quality(docs(spark), none).collect()} == {0.5}
    assert quality.q_quality(spark.createDataFrame([], DOCS), none).count() == 0
    one = spark.createDataFrame([(i, 1, 0) for i in range(9)] + [(None, 0, 0), (3, None, 0)], LABELS)
    kept = quality.keep_good(docs(spark), one)
    assert kept.columns == DOCS.names and kept.count() == len(TEXTS) + 1


def test_language_on_held_out_rows(spark):
    d = table(spark, SF_ORACLE, "documents")
    truth = {r.doc_id: r.lang for r in d.collect()}
    out = language.q_language(d).collect()
    assert len(out) == len(truth) and all(0 <= r.score <= 1 for r in out)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in out if r.held_out and truth[r.doc_id]]) >= 0.95


def test_ngrams_of_a_batch_equal_those_of_single_texts():
    texts = [None, "", "12 !", "a", "Été, 日本語の文", "one two", "x" * 300]
    h, count, lettered = language.ngrams(texts)
    ends = np.cumsum(count)
    for t, e, c, has in zip(texts, ends, count, lettered):
        alone, n, own = language.ngrams([t])
        assert n[0] == c and own[0] == has == any(map(str.isalpha, t or ""))
        assert (alone == h[e - c:e]).all()


def test_bit_slices_have_no_false_negatives():
    rng = np.random.default_rng(1)
    grams = {f"l{i:03}": rng.integers(0, 2**63, 500, dtype=np.uint64) for i in range(70)}
    f = language.Filters.of(grams)
    assert f.words.shape[0] == 2 and (f.false_positive() < 1e-3).all()
    for i, lang in enumerate(f.langs):
        at = language._places(grams[lang])
        mask = f.words[i // 64, at[0]] & f.words[i // 64, at[1]]
        assert ((mask >> np.uint64(i % 64)) & np.uint64(1)).all()


def test_language_edge_rows(spark):
    out = {r.doc_id: r for r in language.q_language(docs(spark)).collect()}
    assert [out[i].lang_pred for i in (0, 1, 2)] == ["und"] * 3 and out[0].score == 0
    assert all(r.lang_pred in ("en", "fr", "und") for r in out.values())
    assert language.q_language(spark.createDataFrame([], DOCS)).count() == 0
    assert language.keep_identified(docs(spark)).columns == DOCS.names


def test_slices_change_nothing(monkeypatch):
    texts = [None, "", "12 !", "a", "Été, 日本語の文 ΣΑΣ", "one two " * 40, "x" * 300, "  lead and trail  ", "7" * 90 + "b"]
    grams = {f"l{i}": language.ngrams(texts)[0][i::3] for i in range(3)}
    f = language.Filters.of(grams)
    want = [x.tolist() for x in f.popcounts(texts)]
    for size in (1, 2, 5, 64):
        monkeypatch.setattr(language, "SLICE", size)
        assert [x.tolist() for x in f.popcounts(texts)] == want


def test_popcounts_equal_plain_sets():
    """Against Python sets; a Bloom filter may only add false positives."""
    rng = np.random.default_rng(2)
    words = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 9))) for _ in range(300)]
    texts = [" ".join(rng.choice(words, 60)) + "." for _ in range(40)]
    grams = {f"l{k}": np.unique(language.ngrams(texts[k::4])[0])[:200 + 50 * k] for k in range(4)}
    f = language.Filters.of(grams)
    out, number, _ = f.popcounts(texts)
    for i, text in enumerate(texts):
        h = language.ngrams([text])[0].tolist()
        assert number[i] == len(h)
        for k, lang in enumerate(f.langs):
            exact = sum(x in set(grams[lang].tolist()) for x in h)
            assert exact <= out[i, k] <= exact + 2


def test_a_long_text_takes_bounded_memory():
    import tracemalloc
    f = language.Filters.of({"x": language.ngrams(["some words"])[0]})
    text = "some words of a long text, " * 1_900_000            # 50 MB
    tracemalloc.start()
    out, number, _ = f.popcounts([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20 and out[0, 0] > number[0] / 9


def test_repeats_of_a_row_do_not_hide_a_language(spark):
    rows = [(4 * i, f"this is row {i} with words of the english kind", "en") for i in range(1999)]
    one = [(4, "ceci est une ligne en langue française avec des mots", "fr")] * 20_000
    d = spark.createDataFrame(rows + one, "doc_id long, text string, lang string")
    filters = language.learn(d)
    assert filters.langs == ["en", "fr"]
    assert filters.predict(["une ligne avec des mots", "words of the kind"])[0] == ["fr", "en"]


def test_language_stage_rejects_noise_and_unlearned_languages(spark):
    d = table(spark, SF_ORACLE, "documents")
    rng = np.random.default_rng(4)
    clean = [r.text for r in d.where("lang = 'en'").limit(50).collect()]
    texts = clean + ["zyxwvut", "the", "Σ", "日本", "123 ... 456", None, "", "  "]
    texts += ["".join(rng.choice(list("bcdfghjklmnpqrstvwxz"), 400)) for _ in range(20)]
    texts += ["これは英語ではない長い日本語の文章です。" * 20, "Это длинный русский текст о погоде. " * 20]
    f = language.learn(d)
    kept = f.speaks(texts)
    n = len(clean)
    assert kept[:n + 4] == [True] * (n + 4)
    assert kept[n + 4:n + 8] == [False] * 4 and not any(kept[n + 8:])


def test_hidden_columns_do_not_replace_the_tables(spark):
    d = docs(spark).withColumnsRenamed({"Score": "heard", "secrets": "Whole_Text", "source": "quality_score"})
    kept = language.keep_identified(d)
    assert kept.columns == d.columns and {r.heard for r in kept.collect()} <= {"clash", None}
    one = spark.createDataFrame([(i, 1, 0) for i in range(9)], LABELS)
    assert quality.keep_good(d, one).columns == d.columns
