import numpy as np
import pytest

from likeness.llm import lattice, permutation_index
from likeness.llm.common import table
from tests.conftest import SF_ORACLE

SCHEMA = "vec_id long, embedding array<float>, Score string, id string, vec string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x", "y", "z") for i, v in rows], SCHEMA)


def unusable():
    return [(9001, None), (9002, []), (9003, [0.0] * 16), (9004, [float("nan")] + [1.0] * 15), (9005, [None] + [1.0] * 15),
            (9006, [float("inf")] + [1.0] * 15), (9100, None), (9007, [1.0, 2.0]), (None, [1.0] * 16)]


def clustered(n=400, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 8, dim))
    x = centres[rng.integers(0, len(centres), n)] + rng.normal(size=(n, dim)) * rng.choice([0, 0.05, 0.3], (n, 1))
    return [(i, [float(a) for a in np.float32(v)]) for i, v in enumerate(x)]


def near_brute(rows, k=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    out = {}
    for i, v in zip(ids, x):
        if i % 100 == 0:
            far = np.sqrt(((x - v) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, far)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(far[j])) for j in order]
    return out


def test_nearest_small_table_is_exact(spark):
    """Fewer rows than LEAST per block: every candidate is reranked."""
    rows = clustered(250)
    got = {}
    for r in permutation_index.q_nearest(frame(spark, rows + unusable() + rows[:5])).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = near_brute(rows)
    assert {q: [(v, s) for _, v, s in sorted(g)] for q, g in got.items()} == want


def test_nearest_among_many_copies_and_few_rows(spark):
    rows = [(i, [1.0] * 16) for i in range(150)] + [(200 + i, [float(i)] * 16) for i in range(3, 9)]
    out = permutation_index.q_nearest(frame(spark, rows)).collect()
    assert [r.vec_id for r in sorted((r for r in out if r.query_id == 100), key=lambda r: r["rank"])] == list(range(10))
    assert [r.vec_id for r in sorted((r for r in out if r.query_id == 0), key=lambda r: r["rank"])] == list(range(1, 11))
    assert permutation_index.q_nearest(frame(spark, rows[:3])).count() == 2
    assert permutation_index.q_nearest(frame(spark, [])).count() == 0


def test_nearest_recall_over_the_table(spark, monkeypatch):
    monkeypatch.setattr(permutation_index, "LEAST", 16)
    d = table(spark, SF_ORACLE, "embeddings")
    want = near_brute([(r.vec_id, r.embedding) for r in d.collect()])
    got = permutation_index.nearest(d, "id % 100 = 0", share=0.4).collect()
    hits = sum(r.vec_id in {v for v, _ in want[r.query_id]} for r in got)
    assert len(got) == 10 * len(want) and hits >= 0.9 * len(got)


def test_nearest_recall_at_the_querys_settings(spark):
    """Above LEAST rows, with the share the query reranks."""
    rows = clustered(4000)
    want = near_brute(rows)
    got = permutation_index.q_nearest(frame(spark, rows)).collect()
    hits = sum(r.vec_id in {v for v, _ in want[r.query_id]} for r in got)
    assert len(got) == 10 * len(want) and hits >= 0.9 * len(got)


@pytest.mark.parametrize("n", [most or 10 ** 9 for most, _, _ in lattice.RUNGS])
@pytest.mark.parametrize("cosine,least", [(0.90, 0.9), (0.92, 0.95), (0.95, 0.99)])
def test_pairs_near_the_threshold_share_a_probed_cell(cosine, least, n):
    rng = np.random.default_rng(0)
    a, r = (rng.normal(size=(2000, 64)) for _ in range(2))
    a /= np.linalg.norm(a, axis=1)[:, None]
    r -= (r * a).sum(axis=1)[:, None] * a
    b = cosine * a + np.sqrt(1 - cosine ** 2) * r / np.linalg.norm(r, axis=1)[:, None]
    (own_a, ask_a), (own_b, ask_b) = (lattice.cells(x, *lattice.rung(n)) for x in (a, b))
    met = (ask_a == own_b[:, :, None]).any(axis=(1, 2)) | (ask_b == own_a[:, :, None]).any(axis=(1, 2))
    assert met.mean() >= least


def test_random_vectors_meet_rarely_at_every_rung():
    """Own cells that two random vectors share, in all tables: a vector of a table
    at a rung's upper end meets a few others, not a share of them."""
    x = np.random.default_rng(1).normal(size=(6000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for most, scale, tables in lattice.RUNGS[:4]:
        own, _ = lattice.cells(x, scale, tables)
        met = sum((c * (c - 1) // 2).sum() for c in (np.unique(own[:, t], return_counts=True)[1] for t in range(tables)))
        assert 2 * met / 6000 * most / 6000 < 12


@pytest.mark.parametrize("rungs", [lattice.RUNGS, ((None, 0.6, 23),)])
def test_links_equal_all_pairs(spark, rungs, monkeypatch):
    monkeypatch.setattr(lattice, "RUNGS", rungs)
    rows = clustered(600)
    out = {r.vec_id: r for r in lattice.near_vectors(frame(spark, rows + unusable() + rows[:5])).collect()}
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    linked = x @ x.T >= 0.9
    want, got = linked.sum(axis=1) - 1, np.array([out[i].n_links for i in range(len(rows))])
    assert (got <= want).all() and got.sum() >= 0.98 * want.sum()
    assert all(out[i].n_links == 0 and out[i].kept for i in (9001, 9003, 9004, 9005, 9006, 9007)) and None not in out
    assert all(out[i].component_id <= i for i in range(len(rows)))


def test_copies_and_a_large_group_are_linked_in_full(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    rows = [(i, [2.0] * 16) for i in range(300)]
    rows += [(1000 + i, [float(a) for a in centre + rng.normal(size=16) * 0.03]) for i in range(300)]
    out = {r.vec_id: r for r in lattice.near_vectors(frame(spark, rows)).collect()}
    assert all(out[i].n_links == 299 for i, _ in rows)
    assert {out[i].component_id for i in range(300)} == {0} and {out[i].component_id for i in range(1000, 1300)} == {1000}
    assert lattice.near_vectors(frame(spark, [])).count() == 0


@pytest.mark.parametrize("scale", [0.3, 1.0, 5.0])
def test_decoded_points_are_the_nearest_of_the_lattice(scale):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(500, 8)) * scale
    home = lattice.decode(x)
    assert ((home * 2 % 2).min(axis=1) == (home * 2 % 2).max(axis=1)).all() and (home.sum(axis=1) % 2 == 0).all()
    far = ((x - home) ** 2).sum(axis=1)
    assert far.max() <= 1 + 1e-9
    roots = [r for r in lattice.decode(rng.normal(size=(20000, 8)) * 0.6) if abs((r ** 2).sum() - 2) < 1e-9]
    for r in np.unique(roots, axis=0):
        assert (((x - home - r) ** 2).sum(axis=1) >= far - 1e-9).all()
    other = lattice.next_nearest(x, home)
    assert (other != home).any(axis=1).mean() > 0.99


def of_two_lengths():
    """The shorter vectors are fewer; ids of the two kinds do not overlap."""
    more = clustered(250)
    fewer = [(5000 + i, v) for i, v in clustered(120, dim=8, seed=2)]
    return more, fewer


def test_nearest_of_every_length(spark):
    more, fewer = of_two_lengths()
    got = {}
    for r in permutation_index.q_nearest(frame(spark, more + fewer)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert {q: [(v, s) for _, v, s in sorted(g)] for q, g in got.items()} == {**near_brute(more), **near_brute(fewer)}


def test_links_of_every_length(spark):
    more, fewer = of_two_lengths()
    both = {r.vec_id: tuple(r) for r in lattice.near_vectors(frame(spark, more + fewer)).collect()}
    alone = [{r.vec_id: tuple(r) for r in lattice.near_vectors(frame(spark, rows)).collect()} for rows in (more, fewer)]
    assert both == {**alone[0], **alone[1]}
    assert any(both[i][1] > 0 for i, _ in fewer)


def test_rows_per_vector_do_not_grow_with_the_table():
    """A vector is posted and asks in a few cells, in a table of 700,000 as in one of 3,000."""
    assert {lattice.rung(n) for n in (3_000, 120_000, 720_000, 2_000_000)} == {lattice.rung(3_000)}
    assert lattice.rung(720_000)[1] <= 6


def test_blocks_of_a_large_cell_meet(spark, monkeypatch):
    rows = clustered(300)
    links = lambda: sorted(tuple(r) for r in lattice.near_vectors(frame(spark, rows)).collect())
    want = links()
    monkeypatch.setattr(lattice, "CELL", 2)
    assert links() == want and any(n for _, n, _, _ in want)


def test_an_id_with_several_vectors_has_its_smallest(spark):
    rows = clustered(200)
    other = [(i, [a + 5.0 for a in v]) for i, v in rows[:50]]
    want = sorted(tuple(r) for r in lattice.near_vectors(frame(spark, rows)).collect())
    assert sorted(tuple(r) for r in lattice.near_vectors(frame(spark, rows + other)).collect()) == want


def test_the_chance_of_a_pair_does_not_fall_as_a_table_grows():
    """At cosine 0.90, from a table of 300 vectors to one of a thousand million."""
    rng = np.random.default_rng(7)
    a, r = (rng.normal(size=(2000, 64)) for _ in range(2))
    a /= np.linalg.norm(a, axis=1)[:, None]
    r -= (r * a).sum(axis=1)[:, None] * a
    b = 0.9 * a + np.sqrt(1 - 0.9 ** 2) * r / np.linalg.norm(r, axis=1)[:, None]
    met = {}
    for setting in {lattice.rung(n) for n in (300, 700, 1_200, 1_800, 10 ** 5, 3 * 10 ** 6, 10 ** 7, 10 ** 8, 10 ** 9)}:
        (own_a, ask_a), (own_b, ask_b) = (lattice.cells(x, *setting) for x in (a, b))
        met[setting] = ((ask_a == own_b[:, :, None]).any(axis=(1, 2)) | (ask_b == own_a[:, :, None]).any(axis=(1, 2))).mean()
    assert min(met.values()) >= 0.985, met
