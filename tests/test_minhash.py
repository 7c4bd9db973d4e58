"""Signatures, LSH candidates, compact top pairs against brute force."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from likeness.functions.hashing import MERSENNE_PRIME, minhash_params
from likeness.operators import minhash, toppairs
from likeness.plans.similarity import signature_index


def _long(spark, sets):
    rows = [(e, it) for e, items in sets.items() for it in items]
    return spark.createDataFrame(rows, "user_id long, item long")


def _py_hash(x):
    import hashlib

    return int(hashlib.md5(str(x).encode()).hexdigest()[:7], 16)


def test_signature_formula(spark):
    sets = {1: [3, 5, 9], 2: [5]}
    sig = {r["id"]: r["sig"] for r in minhash.signatures(_long(spark, sets)).collect()}
    params = minhash_params()
    for e, items in sets.items():
        want = [min((a * _py_hash(x) + b) % MERSENNE_PRIME for x in items) for a, b in params]
        assert sig[e] == want


def test_row_and_long_signatures_agree(spark):
    sets = {1: ["a", "b", "a"], 2: ["b", "c"], 3: [""]}
    rows_long = [(e, it) for e, items in sets.items() for it in set(items)]
    long = minhash.signatures(spark.createDataFrame(rows_long, "user_id long, item string"))
    rows = spark.createDataFrame(list(sets.items()), "user_id long, words array<string>")
    want = sorted(map(tuple, long.collect()))
    for vec in (True, False):
        by_rows = minhash.signatures_of_rows(rows, "user_id", "words", vectorized=vec)
        assert sorted(map(tuple, by_rows.collect())) == want


def test_long_row_is_folded(spark, monkeypatch):
    monkeypatch.setattr(minhash, "CHUNK", 7)
    rows = spark.createDataFrame([(1, [str(i) for i in range(30)]), (2, ["a", "b"]),
                                  (3, [str(i) for i in range(5)])],
                                 "user_id long, words array<string>")
    a = sorted(map(tuple, minhash.signatures_of_rows(rows, "user_id", "words").collect()))
    b = sorted(map(tuple, minhash.signatures_of_rows(rows, "user_id", "words",
                                                     vectorized=False).collect()))
    assert a == b


def test_duplicates_count_as_rows_not_set(spark):
    sig = minhash.signatures(_long(spark, {1: [7, 7, 8]})).collect()[0]
    assert sig["n"] == 3


def test_estimate_close_to_exact(spark):
    base = list(range(200))
    sets = {1: base, 2: base[:170] + list(range(1000, 1030)), 3: base[:100] + list(range(500, 600))}
    sig = {r["id"]: r["sig"] for r in minhash.signatures(_long(spark, sets)).collect()}
    for a, b in [(1, 2), (1, 3), (2, 3)]:
        sa, sb = set(sets[a]), set(sets[b])
        j = len(sa & sb) / len(sa | sb)
        est = sum(x == y for x, y in zip(sig[a], sig[b])) / 128
        assert abs(est - j) <= 4 * math.sqrt(j * (1 - j) / 128) + 1e-9


def test_identical_sets_found_like_minhashlsh(spark):
    from pyspark.ml.feature import MinHashLSH
    from pyspark.ml.linalg import Vectors

    sets = {1: [1, 2, 3, 4, 5, 6], 2: [1, 2, 3, 4, 5, 6], 3: [10, 11, 12, 13, 14, 15],
            4: [10, 11, 12, 13, 14, 15], 5: [40, 41, 42, 43, 44, 45]}
    signature_index(minhash.signatures(_long(spark, sets)))
    members = minhash.signature_groups(minhash.signatures(_long(spark, sets)))[0]
    groups = {r["id"]: r["group_id"] for r in members.collect()}
    ours = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if groups[a] == groups[b]}
    vec = spark.createDataFrame(
        [(e, Vectors.sparse(100, sorted(s), [1.0] * len(s))) for e, s in sets.items()],
        ["id", "features"])
    model = MinHashLSH(inputCol="features", outputCol="h", numHashTables=5, seed=1).fit(vec)
    theirs = {(r["a"], r["b"]) for r in model.approxSimilarityJoin(vec, vec, 1e-9, "d")
              .select(F.col("datasetA.id").alias("a"), F.col("datasetB.id").alias("b"))
              .where("a < b").collect()}
    assert ours == theirs == {(1, 2), (3, 4)}


def _brute_top(sets, counts, thresholds, k, sig):
    """Expanded pairs from the same signatures, banded like the operator."""
    ids = sorted(sig)
    cands = set()
    for a, b in itertools.combinations(ids, 2):
        if any(sig[a][13 * j:13 * j + 13] == sig[b][13 * j:13 * j + 13] for j in range(9)):
            cands.add((a, b))
    out = {}
    for t in thresholds:
        pairs = [(-sum(x == y for x, y in zip(sig[a], sig[b])) / 128, a, b) for a, b in cands
                 if counts[a] > t and counts[b] > t]
        out[t] = [(a, b, -s) for s, a, b in sorted(pairs)[:k]]
    return out


def test_compact_top_pairs_equal_brute_force(spark):
    # a big group of copies (tie at the cut: more than k pairs at 1.0), a
    # second copy group, near copies of both, and singletons
    sets = {}
    for e in range(1, 40):
        sets[e] = list(range(100))              # 741 pairs at 1.0
    for e in range(40, 46):
        sets[e] = list(range(100)) + [1000 + e]  # near copies of the big group
    for e in range(46, 50):
        sets[e] = list(range(500, 540))
    for e in range(50, 54):
        sets[e] = list(range(500, 540)) + [2000 + e]
    for e in range(54, 60):
        sets[e] = list(range(3000 + 50 * e, 3000 + 50 * e + 30))
    inter = _long(spark, sets)
    sig_df = minhash.signatures(inter)
    sig = {r["id"]: r["sig"] for r in sig_df.collect()}
    counts = {e: len(v) for e, v in sets.items()}
    thresholds, k = (5, 35, 60), 25
    _, members, reps = signature_index(sig_df, min_count=min(thresholds))
    got = {}
    for r in toppairs.top_pairs(members, reps, thresholds, k).collect():
        got.setdefault(r["min_ratings"], []).append((r["rank"], r["id1"], r["id2"],
                                                     r["estimated_jaccard"]))
    want = _brute_top(sets, counts, thresholds, k, sig)
    for t in thresholds:
        g = [(a, b, s) for _, a, b, s in sorted(got.get(t, []))]
        assert [(a, b) for a, b, _ in g] == [(a, b) for a, b, _ in want[t]]
        assert [s for *_, s in g] == pytest.approx([round(s, 6) for *_, s in want[t]])
    # the first 25 pairs at t=5 are the lowest-id copies, all at 1.0
    first = sorted(got[5])
    assert first[0][1:3] == (1, 2) and all(x[3] == 1.0 for x in first)
    hist = toppairs.score_histogram(members, reps, thresholds)
    counts_t = {r["min_ratings"]: r["n_pairs"]
                for r in toppairs.pairs_per_threshold(hist, thresholds, k).collect()}
    brute_all = _brute_top(sets, counts, thresholds, 10 ** 9, sig)
    assert counts_t == {t: len(v) for t, v in brute_all.items()}


def test_fewer_pairs_than_k(spark):
    sets = {1: list(range(10)), 2: list(range(10)), 3: list(range(10)), 4: [99] * 3}
    _, members, reps = signature_index(minhash.signatures(_long(spark, sets)), min_count=5)
    out = toppairs.top_pairs(members, reps, (5,), 100).collect()
    assert sorted((r["id1"], r["id2"]) for r in out) == [(1, 2), (1, 3), (2, 3)]


def test_heavy_entities_are_salted_exactly(spark):
    sets = {1: list(range(500)) + list(range(100)), 2: [3, 4, 5], 3: list(range(50, 130))}
    inter = _long(spark, sets)
    plain = sorted(map(tuple, minhash.signatures(inter).collect()))
    salted = sorted(map(tuple, minhash.signatures(inter, heavy_rows=40).collect()))
    assert plain == salted
    assert {r[0]: r[1] for r in plain} == {1: 600, 2: 3, 3: 80}


def test_pair_counts_are_exact_beyond_doubles(spark):
    from likeness.operators.toppairs import pairs_within

    sizes = spark.createDataFrame([(200_000_003,), (5_000_000_000,), (2,)], "e bigint")
    got = {r[0]: int(r[1]) for r in sizes.select("e", pairs_within("e")).collect()}
    assert got == {e: e * (e - 1) // 2 for e in got}


def _signature_table(spark, sigs, n=60):
    import pandas as pd

    d = pd.DataFrame({"id": range(len(sigs)), "n": n, "sig": [list(map(int, s)) for s in sigs]})
    return spark.createDataFrame(d, "id long, n long, sig array<long>")


def test_hot_bucket_is_dealt_and_equals_brute_force(spark, monkeypatch):
    """3,000 distinct signatures in one band bucket."""
    import numpy as np

    from likeness.operators import buckets

    monkeypatch.setattr(buckets, "BLOCK", 256)
    rng = np.random.default_rng(5)
    sigs = rng.integers(0, 1 << 30, (3000, 128))
    sigs[:, :13] = 7                                   # one bucket of band 0
    for i in range(0, 600, 2):                         # pairs of all closenesses
        far = rng.integers(1, 90)
        sigs[i + 1, 13:128] = sigs[i, 13:128]
        sigs[i + 1, rng.choice(np.arange(13, 128), far, replace=False)] += 1
    table = _signature_table(spark, sigs)
    _, members, reps = signature_index(table)
    cells = buckets.bucket_members(reps, block=256).groupBy("band", "low", "high").count().collect()
    assert len([c for c in cells if c.band == 0]) == 12 * 13 // 2 and max(c["count"] for c in cells) < 1000

    want = {}
    for i in range(3000):
        same = (sigs[i + 1:] == sigs[i]).sum(axis=1)
        for j in range(len(same)):
            want[i, i + 1 + j] = int(same[j])
    hist = toppairs.score_histogram(members, reps, (5,)).collect()
    counts = {}
    for v in want.values():
        counts[v] = counts.get(v, 0) + 1
    assert {round(r.estimated_jaccard * 128): int(r.cnt) for r in hist} == counts
    for k in (3, 100, 400):
        top = sorted((-v, a, b) for (a, b), v in want.items())[:k]
        got = sorted(toppairs.top_pairs(members, reps, (5,), k).collect(), key=lambda r: r["rank"])
        assert [(-round(r.estimated_jaccard * 128), r.id1, r.id2) for r in got] == top


def test_bound_takes_the_hot_bucket_apart(spark):
    """With the K-th best pair at 126 of 128 slots, three spans stand for the
    nine bands, and members of the hot band bucket no longer meet."""
    import numpy as np

    from likeness.operators import buckets

    rng = np.random.default_rng(6)
    sigs = rng.integers(0, 1 << 30, (400, 128))
    sigs[:, :13] = 7
    for i in range(0, 40, 2):
        sigs[i + 1] = sigs[i]
        sigs[i + 1, [20, 100]] += 1
    _, members, reps = signature_index(_signature_table(spark, sigs))
    groups = toppairs.copy_groups(members, reps, (5,))
    assert toppairs._needed_slots(groups, (5,), 10, 128) == [126]
    assert buckets.equal_spans(3) == ((0, 42), (42, 43), (85, 43))
    assert buckets.bucket_members(reps, buckets.equal_spans(3)).count() == 40
    got = toppairs.top_pairs(members, reps, (5,), 10).collect()
    assert sorted((r.id1, r.id2) for r in got) == [(i, i + 1) for i in range(0, 20, 2)]


def test_counts_beyond_a_bigint(spark):
    from likeness.operators import buckets

    groups = spark.createDataFrame([(1, [7] * 128, [5 * 10 ** 9], [1]), (2, [7] * 127 + [8], [6 * 10 ** 9], [2])],
                                   "group_id long, sig array<long>, e array<long>, lo array<long>")
    hist = buckets.histogram(groups, (5,)).unionByName(toppairs._inside(groups, (5,)))
    out = toppairs.pairs_per_threshold(hist, (5,)).first()
    assert int(out.n_pairs) == 30 * 10 ** 18 + sum(e * (e - 1) // 2 for e in (5 * 10 ** 9, 6 * 10 ** 9))


def test_wide_permutation_is_exact():
    import random

    import numpy as np

    from likeness.functions.hashing import WIDE_PRIME, wide_permute

    rng = random.Random(1)
    edge = [0, 1, (1 << 31) - 1, 1 << 31, (1 << 60) - 1, WIDE_PRIME - 1]
    h = edge + [rng.randrange(WIDE_PRIME) for _ in range(500)]
    for a in [1, WIDE_PRIME - 1, 1 << 31] + [rng.randrange(1, WIDE_PRIME) for _ in range(20)]:
        b = rng.choice([0, WIDE_PRIME - 1, rng.randrange(WIDE_PRIME)])
        got = wide_permute(np.array(h, np.uint64), a, b).tolist()
        assert got == [(a * x + b) % WIDE_PRIME for x in h]


def test_wide_signatures_in_slices_and_batches(spark):
    from likeness.functions.hashing import WIDE_PRIME, wide_params

    sets = {1: list(range(300)) + list(range(100)), 2: [3, 4, 5], 3: list(range(50, 130)), -7: [9] * 50}
    inter = _long(spark, sets)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        plain = {r.id: (r.n, r.sig) for r in minhash.wide_signatures(inter).collect()}
        salted = {r.id: (r.n, r.sig) for r in minhash.wide_signatures(inter, heavy_rows=40).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert plain == salted and {i: n for i, (n, _) in plain.items()} == {e: len(v) for e, v in sets.items()}
    import hashlib
    h = [int(hashlib.md5(str(x).encode()).hexdigest()[:15], 16) for x in sets[2]]
    assert plain[2][1] == [min((a * x + b) % WIDE_PRIME for x in h) for a, b in wide_params()]


def test_one_pair_repeated_very_often_is_counted_before_it_moves(spark):
    rows = spark.range(200_000).selectExpr("1L user_id", "7L item").union(
        spark.range(50).selectExpr("1L user_id", "id item"))
    for make in (minhash.signatures, minhash.wide_signatures):
        got = make(rows, heavy_rows=1000).first()
        assert (got.id, got.n) == (1, 200_050)
        assert got.sig == make(spark.range(50).selectExpr("1L user_id", "id item")).first().sig
    split = minhash._light_and_heavy(rows.selectExpr("user_id id", "item h"), 1000)[1]
    assert split.count() == 50
