"""Quality classifier: a byte-level convolutional network (operator 3).

The whole text is read as bytes.  Filters of ``WIDTH`` bytes run over it with
stride 2; their outputs are max-pooled over chunks of two adjacent segments of
``SEGMENT`` bytes, so consecutive chunks overlap by one segment and cover the
whole document.  The mean over chunks, the largest chunk value and the mean
segment value of every filter, with the logarithm of the length, go through one
hidden layer into one probability.  Byte embeddings, filters and layers are all
learned by gradient descent in numpy (only the positions that won a maximum
carry a gradient).

The network is fitted on a bounded sample of labelled rows: the
``TRAIN_ROWS`` smallest hashes among rows of at most ``TRAIN_BYTES`` bytes
whose id is not held out.  Scoring is map-only over whole texts of any length,
in blocks of bounded memory.

Edge cases: null and empty texts are scored like any other (a document without
bytes); without labels, or with one label only, every score is the mean label
(0.5 without any); repeated rows get equal scores; other columns pass through.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from likeness.llm.common import add_columns, fresh, text_id

EMBED, WIDTH, FILTERS, HIDDEN = 8, 6, 24, 24
SEGMENT = 256                       # bytes; a chunk is two of them
BLOCK = 512                         # segments read at once
TRAIN_ROWS, TRAIN_BYTES = 4000, 1 << 16
EPOCHS, STEPS, BATCH, RATE = 12, 700, 48, 0.004
THRESHOLD = 0.3
HELD_OUT = 5                        # held out: crc32 of the id as text, modulo this, is 0


def _laid_out(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes in rows of a segment, first segment of each text, text lengths):
    each text is followed by zeros up to a whole segment, at least WIDTH."""
    data = [(t or "").encode() for t in texts]
    size = np.array([len(d) for d in data], np.int64)
    segments = (size + WIDTH + SEGMENT - 1) // SEGMENT
    padded = b"".join(d.ljust(n * SEGMENT, b"\0") for d, n in zip(data, segments.tolist()))
    return np.frombuffer(padded, np.uint8).reshape(-1, SEGMENT), np.cumsum(segments) - segments, size


def _windows(rows: np.ndarray) -> np.ndarray:
    """All bytes, flat; the last windows of a segment reach into the next one."""
    return np.concatenate([rows.ravel(), np.zeros(WIDTH, np.uint8)])


class Network:
    def __init__(self, seed: int = 7, mean: float | None = None):
        rng = np.random.default_rng(seed)
        n = 3 * FILTERS + 1
        self.mean = mean            # set: a constant score, nothing to learn from
        self.p = {"E": rng.normal(0, 0.5, (256, EMBED)), "W": rng.normal(0, 0.3, (WIDTH, EMBED, FILTERS)),
                  "b": np.zeros(FILTERS), "H": rng.normal(0, 0.2, (n, HIDDEN)), "h": np.zeros(HIDDEN),
                  "o": rng.normal(0, 0.2, HIDDEN), "c": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def tables(self) -> np.ndarray:
        """Response of every filter to each byte at each place of a window."""
        return np.einsum("be,kef->kbf", self.p["E"], self.p["W"])

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, mean=np.array([np.nan if self.mean is None else self.mean]), **self.p)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Network:
        with np.load(io.BytesIO(data)) as z:
            net = Network(mean=None if np.isnan(z["mean"][0]) else float(z["mean"][0]))
            net.p = {k: z[k] for k in net.p}
        return net

    def pooled(self, rows: np.ndarray, first: np.ndarray, pairs: np.ndarray | None = None, places: bool = False):
        """Maximum of each filter over each segment (and where it was).  A
        text's windows never reach into the next text: those that would start
        in its final zeros and are left out."""
        half, n = SEGMENT // 2, len(rows)
        ends = np.zeros(n, bool)
        ends[np.append(first[1:], n) - 1] = True
        best = np.empty((n, FILTERS), self.p["E"].dtype)
        at = np.empty((n, FILTERS), np.int64) if places else None
        flat = _windows(rows)
        table = self.tables() if pairs is None else None
        for a in range(0, n, BLOCK):
            b = min(n, a + BLOCK)
            part = flat[a * SEGMENT:b * SEGMENT + WIDTH]
            count = (b - a) * half
            if pairs is not None:   # one look-up per two bytes
                code = (part[0::2].astype(np.int32) << 8) | part[1::2]
                act = pairs[0][code[:count]]
                for k in range(1, WIDTH // 2):
                    act += pairs[k][code[k:k + count]]
            else:
                act = table[0][part[0:2 * count:2]]
                for k in range(1, WIDTH):
                    act += table[k][part[k:k + 2 * count:2]]
            act = act.reshape(b - a, half, FILTERS)
            act[np.flatnonzero(ends[a:b]), half - (WIDTH // 2 - 1):] = -1e9
            if places:
                top = act.argmax(axis=1)
                at[a:b] = (np.arange(a, b)[:, None] * SEGMENT) + 2 * top
                best[a:b] = np.take_along_axis(act, top[:, None, :], axis=1)[:, 0]
            else:
                best[a:b] = act.max(axis=1)
        return (best, at, flat) if places else best

    def pair_tables(self) -> list[np.ndarray]:
        t = self.tables().astype(np.float32)
        return [(t[k][:, None, :] + t[k + 1][None, :, :]).reshape(65536, FILTERS) for k in range(0, WIDTH, 2)]

    def features(self, best: np.ndarray, first: np.ndarray, size: np.ndarray):
        """Per text: mean chunk maximum, largest maximum, mean segment maximum,
        length.  A chunk is a segment and the next one of the same text."""
        relu = np.maximum(best + self.p["b"], 0)
        count = np.diff(np.append(first, len(best)))
        last = np.zeros(len(best), bool)
        last[first + count - 1] = True
        nxt = np.minimum(np.arange(len(best)) + 1, len(best) - 1)
        nxt[last] = np.flatnonzero(last)
        take_next = relu[nxt] > relu
        chunk = np.where(take_next, relu[nxt], relu)
        # a text of one segment is one chunk; else its last segment starts none
        weight = np.where(last & (np.repeat(count, count) > 1), 0, 1).astype(best.dtype)
        chunks = np.add.reduceat(weight, first)
        mean_chunk = np.add.reduceat(chunk * weight[:, None], first) / chunks[:, None]
        top = np.maximum.reduceat(relu, first)
        mean_seg = np.add.reduceat(relu, first) / count[:, None]
        x = np.hstack([mean_chunk, top, mean_seg, np.log1p(size)[:, None] / 10]).astype(best.dtype)
        return x, (relu, nxt, take_next, weight, chunks, count, top)

    def head(self, x: np.ndarray):
        hid = np.maximum(x @ self.p["H"] + self.p["h"], 0)
        return 1 / (1 + np.exp(-np.clip(hid @ self.p["o"] + self.p["c"][0], -30, 30))), hid

    def score(self, texts: list[str | None], pairs: list[np.ndarray] | None = None) -> np.ndarray:
        if not texts or self.mean is not None:
            return np.full(len(texts), self.mean or 0.0)
        rows, first, size = _laid_out(texts)
        x, _ = self.features(self.pooled(rows, first, pairs), first, size)
        return self.head(x)[0].astype(float)

    def gradient(self, texts, y) -> dict[str, np.ndarray]:
        rows, first, size = _laid_out(texts)
        best, at, flat = self.pooled(rows, first, places=True)
        x, (relu, nxt, take_next, weight, chunks, count, top) = self.features(best, first, size)
        prob, hid = self.head(x)
        g = ((prob - y) / len(y)).astype(x.dtype)
        grad = {"o": hid.T @ g, "c": np.array([g.sum()], x.dtype)}
        gh = np.outer(g, self.p["o"]) * (hid > 0)
        grad |= {"H": x.T @ gh, "h": gh.sum(0)}
        gx = gh @ self.p["H"].T
        doc = np.repeat(np.arange(len(first)), count)
        gchunk = (gx[:, :FILTERS] / chunks[:, None])[doc] * weight[:, None]
        grelu = np.where(take_next, 0, gchunk) + (gx[:, 2 * FILTERS:3 * FILTERS] / count[:, None])[doc]
        np.add.at(grelu, nxt, np.where(take_next, gchunk, 0))
        grelu += np.where(relu == top[doc], gx[:, FILTERS:2 * FILTERS][doc], 0)
        grelu *= relu > 0
        grad["b"] = grelu.sum(0)
        table = np.zeros((WIDTH, 256 * FILTERS), x.dtype)
        column = np.arange(FILTERS)[None, :]
        for k in range(WIDTH):
            cell = (flat[at + k].astype(np.int64) * FILTERS + column).ravel()
            table[k] = np.bincount(cell, grelu.ravel(), 256 * FILTERS)
        table = table.reshape(WIDTH, 256, FILTERS)
        grad["E"] = np.einsum("kbf,kef->be", table, self.p["W"])
        grad["W"] = np.einsum("be,kbf->kef", self.p["E"], table)
        return grad


def fit(texts: list[str], labels: list[int], seed: int = 7) -> Network:
    """Adam on the log loss; about EPOCHS passes, at most twice STEPS steps."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return Network(mean=float(y.mean()) if len(y) else 0.5)
    net, rng = Network(seed), np.random.default_rng(seed)
    steps = int(np.clip(EPOCHS * len(y) // BATCH, STEPS, 2 * STEPS))
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(w) for k, w in net.p.items()}
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < BATCH:
            order = np.append(order, rng.permutation(len(y)))
        take, order = order[:BATCH], order[BATCH:]
        rate = RATE * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in net.gradient([texts[i] for i in take], y[take]).items():
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            net.p[k] -= (rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
    return net


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rows: int = TRAIN_ROWS) -> bytes:
    """The fitted network.  The sample (at most ``rows`` rows) is drawn by a
    hash: rows beyond the wanted share are dropped where they are read, then
    the smallest hashes stay; one task fits it."""
    known = (labels.where("quality is not null").select(F.col("doc_id").alias("_id"), "quality")
             .where(F.pmod(text_id("_id"), F.lit(HELD_OUT)) != 0).groupBy("_id").agg(F.min("quality").alias("quality")))
    texts = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("_id"), F.col(f"`{text_col}`").alias("text")).where(
        "_id is not null and text is not null").where(F.octet_length("text") <= TRAIN_BYTES)
    total = known.count()
    share = F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(1 << 30)) < int((1 << 30) * min(1.0, 2.0 * rows / max(1, total)))
    sample = (texts.where(share).join(known.where(share), "_id")
              .orderBy(F.xxhash64("_id", F.lit(11)), "_id", "text").limit(rows))

    def run(batches):
        got = [(i, t, q) for b in batches for i, t, q in zip(*(c.to_pylist() for c in b.columns))]
        got.sort(key=lambda r: (r[0], r[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([fit([t for _, t, _ in got], [q for *_, q in got]).dump()], pa.binary())], ["network"])

    found = sample.select("_id", "text", "quality").repartition(1).mapInArrow(run, "network binary").first()
    return bytes(found[0]) if found else Network(mean=0.5).dump()


_NETS: dict[bytes, tuple] = {}


def _net(data: bytes):
    if data not in _NETS:
        _NETS.clear()
        net = Network.load(data)
        _NETS[data] = net, net.pair_tables()
    return _NETS[data]


def score(docs: DataFrame, network: bytes, text_col: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the probability of label 1 of each whole text."""
    def make(texts):
        net, pairs = _net(network)
        return [net.score(texts, pairs)]
    return add_columns(docs, [T.StructField(out, T.DoubleType())], make, text_col)


def q_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    own = docs.select("doc_id", "text")
    return score(own, train(own, labels), out="score").select(
        "doc_id", (F.pmod(text_id("doc_id"), F.lit(HELD_OUT)) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject."""
    hidden = fresh(docs, "quality_score")
    return score(docs, train(docs, labels), out=hidden).where(F.col(hidden) >= THRESHOLD).drop(hidden)
