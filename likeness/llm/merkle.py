"""Merkle dataset manifest with octopus multiproofs (operator 11).

Every row of a table is a leaf: SHA-256 over its columns, each ``-`` if null,
else its UTF-8 byte count, ``:`` and its value.  The rows of one group (``lang``)
form a tree in the order of their ids: every ``FAN`` consecutive nodes become
the hash of their joined hex digests until one is left, the subroot.  The
subroots, ordered by group (null first), form one more tree; its last node is
the root of the manifest.

1. *Leaves* (map-only) carry digests alone from here on.
2. *Places*: leaves are range-partitioned and sorted by (group, id, digest) and
   numbered by the sizes of the runs before them: no task needs a whole group.
   Rows that agree in all three are equal leaves; their row number spreads them
   over tasks, whichever comes first.
3. *Nodes*: aligned blocks of ``FAN ** HEIGHT`` leaves build their interior nodes;
   the blocks' own nodes are the leaves of the next round, until every tree has
   one node.
4. *Octopus proof*: each partition of leaves (a block) works out the least union
   of node coordinates that the proofs of all its leaves need and that cannot be
   computed from the leaves themselves, in its own tree and in the tree of
   subroots.  One join fetches them all; the partition then derives the interior
   nodes it shares and expands each leaf's own proof from them.

``prove`` takes any subset of the leaves; ``manifest_proofs`` proves all of them.

Edge cases: leaves with a null id come first in their tree; a lone leaf is its
own subroot, a lone subroot the root, and an empty list of siblings hashes the
empty text; rows repeated in full are leaves side by side; columns beyond the
given ones take no part; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from likeness.llm.common import arrow_map, materialize, short_reads
from likeness.session import bounded_broadcast

FAN, HEIGHT = 8, 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = "top"                       # the tree of subroots; a group's tree is named '' (null) or '=' + its name


def digest(*parts: bytes) -> bytes:
    """Lower-case hex SHA-256 of the joined parts, as bytes."""
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def leaf_bytes(values) -> list[bytes]:
    """The encoding of one row's values, given as UTF-8 (None: null)."""
    return [b"-" if v is None else b"%d:%b" % (len(v), v) for v in values]


def lowered(value: bytes) -> bytes:
    """A-Z in lower case, every other byte as it is."""
    return value.lower()


def leaves(docs: DataFrame, columns=COLUMNS, group: str = "lang", id_col: str = "doc_id",
           changed: str | None = None) -> DataFrame:
    """(tree, doc_id, leaf, altered, row) per row of ``docs``.  ``altered`` is the
    digest of the row with A-Z of column ``changed`` in lower case where 3 divides
    the crc32 of the id's decimal text, else null."""
    names = ["tree", "doc_id", "leaf", "altered"]
    at = list(columns).index(changed) if changed else None

    def run(batch):
        data = [batch.column(f"c{k}").to_pylist() for k in range(len(columns))]
        out: list[list] = [[], []]
        for row, alter in zip(zip(*data), batch.column("alter").to_pylist()):
            parts = leaf_bytes(row)
            out[0].append(digest(*parts))
            if alter and row[at] is not None:
                parts[at] = b"%d:%b" % (len(row[at]), lowered(row[at]))
                out[1].append(digest(*parts))
            else:
                out[1].append(None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("tree"), batch.column("doc_id"), *(pa.array(c, pa.binary()) for c in out)], names)

    key = F.col(f"`{group}`").cast("string")
    own = F.col(f"`{id_col}`").cast("bigint")
    alter = F.coalesce(F.crc32(own.cast("string").cast("binary")) % 3 == 0, F.lit(False)) if changed else F.lit(False)
    source = docs.select(
        F.when(key.isNull(), "").otherwise(F.concat(F.lit("="), key)).alias("tree"), own.alias("doc_id"),
        alter.alias("alter"),
        *(F.col(f"`{c}`").cast("string").cast("binary").alias(f"c{k}") for k, c in enumerate(columns)))
    found = arrow_map(source, run, "tree string, doc_id long, leaf binary, altered binary")
    return found.withColumn("row", F.monotonically_increasing_id())


def placed(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, their place from 0 within ``tree`` by ``order``."""
    spot = F.monotonically_increasing_id()
    run = materialize(
        rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).withColumn("_spot", spot)
        .withColumn("_part", F.shiftright("_spot", 33)), "sorted-leaves")
    sizes = run.groupBy("_part", tree).agg(F.count(F.lit(1)).alias("_n"), F.min("_spot").alias("_first"))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = materialize(sizes.select("_part", tree, "_first", F.coalesce(
        F.sum("_n").over(before), F.lit(0)).alias("_before")), "run-offsets")
    return run.join(bounded_broadcast(offsets), ["_part", tree]).withColumn(
        "idx", F.col("_before") + F.col("_spot") - F.col("_first")).drop("_part", "_spot", "_first", "_before")


def grow(level: int, idx: np.ndarray, digests: list[bytes], height: int):
    """Interior nodes above consecutive sorted nodes of one aligned block:
    (level, idx, digest) of ``height`` levels."""
    for up in range(1, height + 1):
        parent = idx // FAN
        start = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]])
        ends = np.r_[start[1:], len(parent)]
        digests = [digest(*digests[a:b]) for a, b in zip(start, ends)]
        idx = parent[start]
        yield level + up, idx, digests


NODE = "tree string, level int, idx long, node binary"


def build(base: DataFrame, sizes: DataFrame) -> DataFrame:
    """All nodes (tree, level, idx, node) of the trees whose leaves are ``base``
    (tree, idx, node), the leaves included; the last node of a tree is at the
    lowest level that has one node alone.  ``sizes``: (tree, n), its leaves."""
    def run(block):
        block = block.sort_by("idx")
        tree, level = block.column("tree")[0].as_py(), block.column("level")[0].as_py()
        out: list[list] = [[], [], []]
        for at, idx, nodes in grow(level, block.column("idx").to_numpy(), block.column("node").to_pylist(), HEIGHT):
            for column, values in zip(out, ([at] * len(idx), idx.tolist(), nodes)):
                column.extend(values)
        return pa.Table.from_arrays(
            [pa.array([tree] * len(out[0])), pa.array(out[0], pa.int32()), pa.array(out[1], pa.int64()),
             pa.array(out[2], pa.binary())], ["tree", "level", "idx", "node"])

    now = base.select("tree", F.lit(0).alias("level"), "idx", "node")
    nodes, level = now, 0
    most = sizes.agg(F.max("n")).first()[0] or 0
    while FAN ** level < most:
        # trees of one node are ready: nothing grows above it
        more = sizes.where(F.col("n") > FAN ** level).select("tree")
        open_ = now.join(bounded_broadcast(more), "tree", "left_semi")
        made = materialize(open_.groupBy("tree", F.expr(f"idx div {FAN ** HEIGHT}").alias("block")).applyInArrow(
            run, NODE), "tree-nodes")
        level += HEIGHT
        now = made.where(F.col("level") == level)
        nodes = nodes.unionByName(made)
    return nodes


def top_level(n: int) -> int:
    """The level at which a tree of ``n`` leaves has one node."""
    level = 0
    while n > 1:
        n, level = -(-n // FAN), level + 1
    return level


def missing(idx: np.ndarray, n: int):
    """(level, idx) of the nodes that the proofs of leaves ``idx`` (sorted,
    distinct) of a tree of ``n`` leaves need beside what the leaves give: at each
    level, siblings of known nodes that are not known themselves."""
    level = 0
    while n > 1:
        parent = np.unique(idx // FAN)
        run = (parent[:, None] * FAN + np.arange(FAN)).ravel()
        lack = np.setdiff1d(run[run < n], idx, assume_unique=True)
        yield from ((level, int(i)) for i in lack)
        idx, n, level = parent, -(-n // FAN), level + 1


def derive(known: dict[int, bytes], n: int, fetched: dict[tuple[int, int], bytes]) -> list[dict[int, bytes]]:
    """Per level the nodes that leaves ``known`` and ``fetched`` ones give."""
    levels = [dict(known)]
    while n > 1:
        now, level = levels[-1], len(levels) - 1
        own = sorted({i // FAN for i in now})
        now.update({i: v for (at, i), v in fetched.items() if at == level})
        levels.append({p: digest(*(now[i] for i in range(p * FAN, min(p * FAN + FAN, n)))) for p in own})
        n = -(-n // FAN)
    return levels


def path(levels: list[dict[int, bytes]], n: int, i: int) -> list[tuple[bytes, bytes]]:
    """The proof of node ``i``: per level the joined siblings before and after."""
    out = []
    for now in levels[:-1]:
        p = i // FAN * FAN
        out.append((b"".join(now[k] for k in range(p, i)),
                    b"".join(now[k] for k in range(i + 1, min(p + FAN, n)))))
        i, n = i // FAN, -(-n // FAN)
    return out


def folded(node: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and its proof give."""
    for before, after in steps:
        node = digest(before, node, after)
    return node


def manifest(found: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(leaves with places, nodes, trees) of ``leaves`` output.  ``trees``:
    (tree, n, place among the trees, number of trees)."""
    with short_reads(found.sparkSession):
        found = materialize(found, "leaves")
    own = materialize(placed(found, "tree", ["doc_id", "leaf", "row"]), "placed-leaves")
    sizes = materialize(own.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "tree-sizes")
    nodes = build(own.select("tree", "idx", F.col("leaf").alias("node")), sizes)
    last = (nodes.join(sizes.select("tree", _top("n").alias("level")), ["tree", "level"]).where("idx = 0")
            .select("tree", F.col("node")))
    seated = materialize(placed(last.select(F.lit(TOP).alias("name"), "tree", "node"), "name", ["tree"]), "subroots")
    count = seated.groupBy(F.col("name").alias("tree")).agg(F.count(F.lit(1)).alias("n"))
    top = build(seated.select(F.col("name").alias("tree"), "idx", "node"), count)
    trees = sizes.join(seated.select("tree", F.col("idx").alias("place")), "tree").withColumn(
        "trees", F.lit(sizes.count()))
    return own, nodes.unionByName(top), materialize(trees, "trees")


def _top(n: str) -> F.Column:
    """``top_level`` as a column."""
    level = F.lit(0)
    for up in range(1, 22):       # 8 ** 21 leaves are beyond a BIGINT
        level = F.when(F.col(n) > F.lit(float(FAN) ** (up - 1)), up).otherwise(level)
    return level.cast("int")


def prove(rows: DataFrame, nodes: DataFrame, trees: DataFrame, digests: bool = False) -> DataFrame:
    """Proofs of ``rows`` (tree, doc_id, leaf, altered, idx), any of the leaves:
    (doc_id, leaf, subroot, root, idx, n, proof, folded_root, verified).  ``proof``
    holds per level an array of the siblings' digests before and after the node;
    with ``digests`` ``proof_sha256``, the hash of all siblings in order, stands
    for it."""
    width = FAN ** HEIGHT
    sized = rows.join(bounded_broadcast(trees), "tree").withColumn("block", F.expr(f"idx div {width}"))

    def ask(block):
        tree, number = block.column("tree")[0].as_py(), block.column("block")[0].as_py()
        first = {c: block.column(c)[0].as_py() for c in ("n", "place", "trees")}
        need = [(tree, *at) for at in missing(np.unique(block.column("idx").to_numpy()), first["n"])]
        need += [(TOP, *at) for at in missing(np.array([first["place"]]), first["trees"])]
        columns = list(zip(*need)) if need else [[], [], []]
        size = len(need)
        return pa.Table.from_arrays(
            [pa.array([tree] * size, pa.string()), pa.array([number] * size, pa.int64()),
             pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64())],
            ["asker", "block", "tree", "level", "idx"])

    wanted = materialize(sized.select("tree", "block", "idx", "n", "place", "trees").groupBy("tree", "block").applyInArrow(
        ask, "asker string, block long, tree string, level int, idx long"), "wanted-nodes")
    # leaves of whole blocks ask for nothing below the block: read those levels alone
    low = wanted.groupBy(F.col("tree") == TOP).agg(F.min("level").alias("low")).collect()
    least = min((r.low for r in low), default=0)
    fetched = materialize(nodes.where(F.col("level") >= least).join(wanted, ["tree", "level", "idx"]).select(
        "asker", "block", "tree", "level", "idx", "node"), "fetched-nodes")

    def expand(block, got):
        first = {c: block.column(c)[0].as_py() for c in ("n", "place", "trees")}
        own, above = {}, {}
        for tree, level, idx, node in zip(*(got.column(c).to_pylist() for c in ("tree", "level", "idx", "node"))):
            (above if tree == TOP else own)[(level, idx)] = node
        idx = block.column("idx").to_pylist()
        leaf = block.column("leaf").to_pylist()
        levels = derive(dict(zip(idx, leaf)), first["n"], own)
        subroot = levels[-1][0]
        tops = derive({first["place"]: subroot}, first["trees"], above)
        root, rest = tops[-1][0], path(tops, first["trees"], first["place"])
        shared: dict[int, list] = {}          # the proof above a leaf's own run is that of its neighbours
        proof, fold = [], []
        for i, node, other in zip(idx, leaf, block.column("altered").to_pylist()):
            if i // FAN not in shared:
                shared[i // FAN] = path(levels[1:], -(-first["n"] // FAN), i // FAN) + rest
            steps = (path(levels[:2], first["n"], i) if first["n"] > 1 else []) + shared[i // FAN]
            fold.append(folded(node if other is None else other, steps))
            proof.append(digest(*(x for step in steps for x in step)) if digests else
                         [[_cut(before), _cut(after)] for before, after in steps])
        size = len(idx)
        text = lambda values: pa.array([v.decode() for v in values], pa.string())
        shown = text(proof) if digests else pa.array(proof, pa.list_(pa.list_(pa.list_(pa.string()))))
        return pa.Table.from_arrays(
            [block.column("doc_id"), text(leaf), text([subroot] * size), text([root] * size), block.column("idx"),
             block.column("n"), shown, text(fold), pa.array([f == root for f in fold], pa.bool_())],
            ["doc_id", "leaf", "subroot", "root", "idx", "n", name, "folded_root", "verified"])

    name, kind = ("proof_sha256", "string") if digests else ("proof", "array<array<array<string>>>")
    return sized.select("tree", "block", "doc_id", "leaf", "altered", "idx", "n", "place", "trees").groupBy(
        "tree", "block").cogroup(fetched.withColumnRenamed("asker", "of").groupBy("of", "block")).applyInArrow(
        expand, "doc_id long, leaf string, subroot string, root string, idx long, n long, "
                f"{name} {kind}, folded_root string, verified boolean")


def _cut(joined: bytes) -> list[str]:
    return [joined[k:k + 64].decode() for k in range(0, len(joined), 64)]


def q_merkle(docs: DataFrame) -> DataFrame:
    own, nodes, trees = manifest(leaves(docs, changed="text"))
    return prove(own, nodes, trees, digests=True)


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text: one step per byte, eight per bit."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    bits = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, _: {step})"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), "
            f"lambda x: ascii(x)::BIGINT)), lambda a, b: {bits}), 4294967295)")


def _levels_sql(name: str, base: str, height: int) -> str:
    """Nodes of all trees of ``base`` (tree, idx, node), level by level; a tree of
    one node keeps it.  ``<name>_runs<l>``: (tree, parent, run, size)."""
    parts = [f"{name}_0 AS ({base})"]
    for at in range(height):
        parts.append(f"""{name}_runs{at} AS (
  SELECT tree, idx // 8 AS parent, list(node ORDER BY idx) AS run,
         max(count(*)) OVER (PARTITION BY tree) = 1 AND count(*) OVER (PARTITION BY tree) = 1 AS single
  FROM {name}_{at} GROUP BY tree, idx // 8)""")
        parts.append(f"""{name}_{at + 1} AS (
  SELECT tree, parent AS idx, CASE WHEN single THEN run[1] ELSE sha256(array_to_string(run, '')) END AS node
  FROM {name}_runs{at})""")
    return ",\n".join(parts)


def _proof_sql(levels: int = 8, above: int = 4) -> str:
    enc = lambda x: f"coalesce(strlen({x}) || ':' || {x}, '-')"
    columns = [enc(f"CAST({c} AS VARCHAR)") for c in COLUMNS]
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    head = f"""WITH leaf AS (
  SELECT doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS tree,
         sha256({' || '.join(columns)}) AS leaf, sha256({' || '.join([*columns[:4], enc(low)])}) AS lower_leaf
  FROM documents),
own AS (
  SELECT *, CASE WHEN {_crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN lower_leaf ELSE leaf END AS altered,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM leaf),
"""
    trees = _levels_sql("n", "SELECT tree, idx, leaf AS node FROM own", levels)
    seated = (f"sub AS (SELECT tree, node AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS place "
              f"FROM n_{levels})")
    tops = _levels_sql("t", "SELECT '' AS tree, place AS idx, subroot AS node FROM sub", above)
    steps = ["w0 AS (SELECT o.*, s.subroot, s.place, o.idx AS spot, altered AS fold, '' AS proof "
             "FROM own o JOIN sub s USING (tree))"]
    for k in range(levels + above):
        runs, tree = (f"n_runs{k}", "w.tree") if k < levels else (f"t_runs{k - levels}", "''")
        at = "w.place" if k == levels else "w.spot"
        before = f"array_to_string(r.run[1:{at} % 8], '')"
        after = f"array_to_string(r.run[{at} % 8 + 2:], '')"
        steps.append(f"""w{k + 1} AS (
  SELECT w.* EXCLUDE (spot, fold, proof), {at} // 8 AS spot,
         CASE WHEN r.single THEN w.fold ELSE sha256({before} || w.fold || {after}) END AS fold,
         CASE WHEN r.single THEN w.proof ELSE w.proof || {before} || {after} END AS proof
  FROM w{k} w JOIN {runs} r ON r.tree = {tree} AND r.parent = {at} // 8)""")
    return head + ",\n".join([trees, seated, tops, *steps]) + f"""
SELECT w.doc_id, w.leaf, w.subroot, t.node AS root, w.idx, count(*) OVER (PARTITION BY w.tree) AS n,
       sha256(w.proof) AS proof_sha256, w.fold AS folded_root, w.fold = t.node AS verified
FROM w{levels + above} w, t_{above} t"""


Q_MERKLE_SQL = _proof_sql()
