import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from likeness.llm import merkle
from likeness.llm.common import READ_ROWS, READER_ROWS, materialize
from tests.llm.helpers import DOCS, docs

H = lambda s: hashlib.sha256(s.encode()).hexdigest()


def plain(rows):
    """{(doc_id, leaf)}: the whole result by building lists."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    groups = defaultdict(list)
    for r in rows:
        leaf = H("".join(map(enc, (r.doc_id, r.source, r.lang, r.n_chars, r.text))))
        hit = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and r.text is not None
        other = H("".join(map(enc, (r.doc_id, r.source, r.lang, r.n_chars, r.text.translate(lower))))) if hit else leaf
        groups[r.lang].append((r.doc_id is not None, r.doc_id or 0, leaf, other))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            now = out[-1]
            out.append([H("".join(now[k:k + 8])) for k in range(0, len(now), 8)])
        return out

    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    found = []
    for place, g in enumerate(names):
        for i, (has, doc_id, leaf, other) in enumerate(sorted(groups[g])):
            proof, fold = "", other
            for tree, at in ((trees[g], i), (top, place)):
                for now in tree[:-1]:
                    run, own = now[at // 8 * 8:at // 8 * 8 + 8], at % 8
                    proof += "".join(run[:own] + run[own + 1:])
                    fold = H("".join(run[:own] + [fold] + run[own + 1:]))
                    at //= 8
            root = top[-1][0]
            found.append((doc_id if has else None, leaf, trees[g][-1][0], root, H(proof), fold, fold == root))
    return sorted(found, key=str)


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("height", [1, 2, 4])
def test_whole_result_equals_lists(spark, monkeypatch, height):
    monkeypatch.setattr(merkle, "HEIGHT", height)      # several rounds and many blocks on few rows
    d = docs(spark, [f"Text {i % 90} É" if i % 7 else None for i in range(300)], langs=("en", "en", "en", None, "fr"))
    d = d.union(d.where("doc_id % 5 = 0 or doc_id is null")).union(
        spark.createDataFrame([(-5, "lone", "zz", None, None, None, None)], DOCS))
    got = sorted((tuple(r[c] for c in NAMES) for r in merkle.q_merkle(d).collect()), key=str)
    assert got == plain(d.collect())


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    d = docs(spark, [f"T{i}" for i in range(n)], langs=("en",)).where("doc_id is not null")
    got = sorted((tuple(r[c] for c in NAMES) for r in merkle.q_merkle(d).collect()), key=str)
    assert got == (plain(d.collect()) if n else [])


def test_edge_rows(spark):
    d = docs(spark)
    got = sorted((tuple(r[c] for c in NAMES) for r in merkle.q_merkle(d).collect()), key=str)
    assert got == plain(d.collect())


def test_proofs_of_a_subset(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    d = docs(spark, [f"text {i}" for i in range(200)], langs=("en", None))
    own, nodes, trees = merkle.manifest(merkle.leaves(d))
    some = materialize(own.where("doc_id % 17 = 3"), "some")
    out = merkle.prove(some, nodes, trees).collect()
    assert len(out) == 12 and all(r.verified for r in out)
    want = {r[0]: r for r in plain(d.collect())}
    for r in out:
        steps = [("".join(before).encode(), "".join(after).encode()) for before, after in r.proof]
        assert merkle.folded(r.leaf.encode(), steps).decode() == r.root == want[r.doc_id][3]
        assert H("".join(x for s in r.proof for side in s for x in side)) == want[r.doc_id][4]


def test_missing_is_the_least_union():
    rng = np.random.default_rng(1)
    for n in (1, 2, 8, 9, 64, 65, 700):
        for size in {1, min(n, 5), n}:
            some = np.sort(rng.choice(n, size, replace=False))
            asked = list(merkle.missing(some, n))
            tree = {i: merkle.digest(str(i).encode()) for i in range(n)}
            whole = merkle.derive(tree, n, {})
            have = merkle.derive({int(i): tree[int(i)] for i in some}, n, {c: whole[c[0]][c[1]] for c in asked})
            assert have[-1][0] == whole[-1][0]
            # nothing fetched is above a leaf that is held, and nothing is fetched twice
            above = {(at, int(i) // 8 ** at) for i in some for at in range(9)}
            assert len(set(asked)) == len(asked) and not above & set(asked)
            if size == n:
                assert not asked


def test_reader_holds_few_texts_while_leaves_are_written(spark, monkeypatch):
    """The default of 4,096 whole texts made an executor's heap grow."""
    seen, real, rows = {}, merkle.materialize, spark.conf.get(READER_ROWS)
    monkeypatch.setattr(merkle, "materialize", lambda df, name: (
        seen.setdefault(name, int(spark.conf.get(READER_ROWS))), real(df, name))[1])
    merkle.q_merkle(docs(spark))
    assert seen["leaves"] <= READ_ROWS < int(rows)
    assert seen["placed-leaves"] == int(spark.conf.get(READER_ROWS)) == int(rows)


def test_no_files_but_of_rounds_that_grow(spark, monkeypatch):
    """Every file written is a process the executor starts; each round used to
    write its open trees, and a last one wrote nothing at all."""
    written, real = [], merkle.materialize
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    monkeypatch.setattr(merkle, "materialize", lambda df, name: (written.append(name), real(df, name))[1])
    merkle.manifest(merkle.leaves(docs(spark, [f"text {i}" for i in range(65)], langs=("en",))))
    assert written.count("tree-nodes") == 3 and "open-trees" not in written      # 66 leaves: 9, 2, 1; one tree
