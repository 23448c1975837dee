"""A byte-level convolutional network that tells a text's quality.

Filters over one-hot bytes are tables: a filter's answer on a chunk is the sum of one entry for each of its bytes. A
second bank looks at longer chunks through the shares of bytes that equal the one some distance earlier, a channel for
each distance; its weights and the levels from which a channel counts are learned like those of the first. Chunks
overlap and cover the whole text; each filter's largest answer is kept, and one logistic unit combines them. Trained
with Adam in numpy on a bounded sample of labelled rows, applied in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legispark.llm import text as T

WIDTH, STRIDE, FILTERS = 8, 4, 16
#: Bytes of the longer chunks, their step, the distances of their channels, and filters over these.
LONG, HALF, LAGS, COMPARING = 64, 32, range(2, 33), 4
#: The bound of the sample: labelled rows, and bytes of each.
SAMPLE_ROWS, SAMPLE_BYTES = 2000, 1 << 16
THRESHOLD = 0.7
#: Text that is scored at once, in bytes.
SLICE = 2 << 20
#: Bytes of a longer text that are looked at together; its pieces overlap so that the maxima are those of the whole.
PIECE = 1 << 20
#: What each step takes off the filters, so that they keep what many texts share.
DECAY = 3e-3
#: The byte that fills short texts up; UTF-8 has no such byte.
FILL = 0xFF


def _chunks(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where chunks start in each text (the last may reach into the next text by less than WIDTH bytes), and offsets."""
    n = np.maximum(1, -(-np.maximum(np.diff(at) - WIDTH, 0) // STRIDE) + 1)
    starts = np.repeat(at[:-1], n) + STRIDE * T.spread(np.zeros(len(n), np.int64), n)
    last = np.cumsum(n) - 1
    starts[last] = np.maximum(at[:-1], at[1:] - WIDTH)
    return starts, np.concatenate([[0], last + 1])


def _padded(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes, those of fewer than WIDTH filled up."""
    data, at = T.raw(text)
    n = np.diff(at)
    if (n >= WIDTH).all():
        return data, at
    room = np.maximum(n, WIDTH)
    to = np.concatenate([[0], np.cumsum(room)])
    out = np.full(int(to[-1]), FILL, np.uint8)
    out[T.spread(to[:-1], n)] = data
    return out, to


def likeness(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each long chunk of each text and each distance, the share of bytes that equal the one so far earlier, and offsets.

    Chunks lie within their text; one of fewer than LONG bytes has one chunk, of all its bytes.
    """
    n = np.diff(at)
    room = -(-n // HALF) * HALF + HALF  # each text starts a half of its own, after filling
    to = np.concatenate([[0], np.cumsum(room)]) + HALF
    line = np.full(int(to[-1]), FILL, np.uint8)
    line[T.spread(to[:-1], n)] = data
    m = len(line) // HALF
    first, count = to[:-1] // HALF, np.maximum(1, n // HALF - 1)
    where = T.spread(first, count)
    out = np.empty((len(where), len(LAGS)), np.float32)
    same = np.zeros(len(line), bool)
    full = line != FILL
    for i, lag in enumerate(LAGS):
        same[lag:] = (line[lag:] == line[:-lag]) & full[lag:]
        half = same.reshape(m, HALF).sum(axis=1, dtype=np.uint8)
        out[:, i] = (half[:-1] + half[1:])[where] / np.float32(LONG)
    return out, np.concatenate([[0], np.cumsum(count)])


@dataclass
class Network:
    tables: np.ndarray  # WIDTH, 256, FILTERS
    lags: np.ndarray  # distances, COMPARING
    levels: np.ndarray  # distances
    weights: np.ndarray  # FILTERS + COMPARING
    bias: float

    def answers(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        out = self.tables[0][data[starts]]
        for k in range(1, WIDTH):
            out += self.tables[k][data[starts + k]]
        return out

    def compared(self, shares: np.ndarray) -> np.ndarray:
        return np.maximum(shares - self.levels, 0) @ self.lags

    def pooled(self, data: np.ndarray, at: np.ndarray, piece: int = PIECE) -> np.ndarray:
        """Each filter's largest answer on each text, 0 at least. Long texts go piece by piece: memory doesn't grow with a text."""
        long = np.flatnonzero(np.diff(at) > piece)
        parts = [], []
        for a, b in zip(np.append(0, long + 1), np.append(long, len(at) - 1), strict=True):
            parts[0].append(self._maxima(data[at[a] : at[b]], at[a : b + 1] - at[a]))
            parts[1].append(self._of_pieces(data[at[b] : at[b + 1]], piece) if b < len(at) - 1 else np.zeros((0, FILTERS + COMPARING)))
        return np.concatenate([x for both in zip(*parts, strict=True) for x in both])

    def _of_pieces(self, data: np.ndarray, piece: int) -> np.ndarray:
        """piece is a multiple of STRIDE and HALF, so chunks start where those of the whole do."""
        n, best = len(data), np.zeros((1, FILTERS + COMPARING))
        for s in range(0, n, piece):
            own = data[min(s, n - WIDTH) : min(n, s + piece + WIDTH - STRIDE)]
            best[0, :FILTERS] = np.maximum(best[0, :FILTERS], self.answers(own, _chunks(own, np.array([0, len(own)]))[0]).max(axis=0))
            begin = max(0, s - HALF)  # what the first chunk compares with
            own = data[begin : min(n, s + piece + HALF)]
            shares = likeness(own, np.array([0, len(own)]))[0][1 if s else 0 :]
            if len(shares):
                best[0, FILTERS:] = np.maximum(best[0, FILTERS:], self.compared(shares).max(axis=0))
        return best

    def _maxima(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        if len(at) < 2:
            return np.zeros((0, FILTERS + COMPARING))
        starts, to = _chunks(data, at)
        top = [np.maximum.reduceat(self.answers(data, starts[to[a] : to[b]]), to[a:b] - to[a]) for a, b in _steps(to)]
        shares, to = likeness(data, at)
        more = [np.maximum.reduceat(self.compared(shares[to[a] : to[b]]), to[a:b] - to[a]) for a, b in _steps(to)]
        return np.maximum(np.column_stack([np.concatenate(top), np.concatenate(more)]), 0)

    def score(self, text: pa.Array) -> np.ndarray:
        if not len(text):
            return np.zeros(0)
        data, at = _padded(text)
        z = self.pooled(data, at) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _steps(to: np.ndarray, limit: int = 1 << 16) -> Iterator[tuple[int, int]]:
    """Runs of texts with about so many chunks."""
    a = 0
    while a < len(to) - 1:
        b = max(a + 1, int(np.searchsorted(to, to[a] + limit, "right")) - 1)
        yield a, b
        a = b


class Adam:
    def __init__(self, rate: float):
        self.rate, self.step, self.m, self.v = rate, 0, {}, {}

    def __call__(self, name: str, value: np.ndarray, grad: np.ndarray) -> np.ndarray:
        m = self.m[name] = 0.9 * self.m.get(name, 0) + 0.1 * grad
        v = self.v[name] = 0.999 * self.v.get(name, 0) + 0.001 * grad * grad
        return value - self.rate * (m / (1 - 0.9**self.step)) / (np.sqrt(v / (1 - 0.999**self.step)) + 1e-8)


def train(texts: list[str], labels: list[int], epochs: int = 12, batch: int = 32, seed: int = 7) -> Network:
    """Fits all weights by gradients of the log loss through the maxima; without both labels, the share of ones alone."""
    y = np.array(labels, float)
    share = (y.sum() + 0.5) / (len(y) + 1)
    rng = np.random.default_rng(seed)
    net = Network(
        rng.normal(0, 0.1, (WIDTH, 256, FILTERS)).astype(np.float32),
        np.abs(rng.normal(0, 1, (len(LAGS), COMPARING))).astype(np.float32),
        np.full(len(LAGS), 0.3, np.float32),
        np.append(rng.normal(0, 0.1, FILTERS), np.full(COMPARING, -0.5)),
        float(np.log(share / (1 - share))),
    )
    if len(set(labels)) < 2:
        net.weights[:] = 0
        return net
    data, at = _padded(pa.array(texts, pa.string()))
    shares, per = likeness(data, at)
    starts, to = _chunks(data, at)
    adam = Adam(0.02)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for own in np.split(order, range(batch, len(order), batch)):
            h, where = np.zeros((len(own), FILTERS + COMPARING)), np.zeros((len(own), FILTERS), np.int64)
            seen = np.zeros((len(own), COMPARING), np.int64)
            for i, d in enumerate(own):
                s = starts[to[d] : to[d + 1]]
                z = net.answers(data, s)
                k = z.argmax(axis=0)
                h[i, :FILTERS], where[i] = z[k, np.arange(FILTERS)], s[k]
                z = net.compared(shares[per[d] : per[d + 1]])
                k = z.argmax(axis=0)
                h[i, FILTERS:], seen[i] = z[k, np.arange(COMPARING)], per[d] + k
            on = h > 0
            h *= on
            p = 1 / (1 + np.exp(-np.clip(h @ net.weights + net.bias, -30, 30)))
            g = (p - y[own]) / len(own)
            back = g[:, None] * net.weights[None, :] * on
            grad = np.zeros_like(net.tables)
            for k in range(WIDTH):
                np.add.at(grad[k], (data[where + k], np.arange(FILTERS)[None, :].repeat(len(own), 0)), back[:, :FILTERS].astype(np.float32))
            above = np.maximum(shares[seen] - net.levels, 0)  # text, filter, distance
            late = back[:, FILTERS:, None]
            down = -(late * net.lags.T[None] * (above > 0)).sum(axis=(0, 1))
            adam.step += 1
            net.tables = (adam("tables", net.tables, grad) * (1 - DECAY)).astype(np.float32)
            net.lags = adam("lags", net.lags, (late * above).sum(axis=0).T).astype(np.float32)
            net.levels = adam("levels", net.levels, down).astype(np.float32)
            net.weights = adam("weights", net.weights, h.T @ g + 1e-4 * net.weights)
            net.bias = float(adam("bias", np.array(net.bias), np.array(g.sum())))
    return net


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, most_bytes: int, unlabelled: int = 0) -> list:
    """At most `rows` labelled texts, the same ones each time: by a hash of the id, of those for which `learn` is true.

    With `unlabelled`, at most so many more that have no label, which is null then. Texts of more than `most_bytes` bytes
    are not learned from. Null ids and texts are left out; an id with several labels has its least.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.min(label).alias("label"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    if unlabelled:
        ids = docs.where(F.col("doc_id").isNotNull() & learn).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows + unlabelled)
        more = ids.distinct().join(labels.where(F.col(label).isNotNull()), "doc_id", "left_anti").orderBy(F.xxhash64("doc_id"), "doc_id").limit(unlabelled)
        chosen = chosen.unionByName(more.withColumn("label", F.lit(None).cast("int")), allowMissingColumns=True)
    found = docs.select("doc_id", "text").where(F.octet_length("text") <= most_bytes).join(F.broadcast(chosen), "doc_id")  # so many rows at most
    return found.orderBy(F.col("label").isNull(), F.xxhash64("doc_id"), "doc_id", "text").limit(rows + unlabelled).collect()


def trainable(id_col: str = "doc_id") -> Column:
    """Rows to learn from: crc32 of the id as text is not 2 modulo 4."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) != 2


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS, most_bytes: int = SAMPLE_BYTES) -> Network:
    """The network, from a bounded sample on the driver."""
    found = sample(docs, labels, "quality", trainable(), rows, most_bytes)
    return train([r.text for r in found], [int(r.label) for r in found])


def scored(spark: SparkSession, docs: DataFrame, model: Network, threshold: float = THRESHOLD, text_col: str = "text", drop_text: bool = True, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """docs' columns (the text only if asked for), and score (0 to 1, higher: label 1 likelier), predicted.

    Null and empty texts are scored as filled up to one chunk, long ones piece by piece. Rows that repeat get equal scores; an empty table gives
    an empty result. The new columns, whose names may be given, replace columns of docs that have them.
    """
    shared = spark.sparkContext.broadcast(model)  # fixed size

    def values(text: pa.Array) -> list:
        score = shared.value.score(text)
        return [pa.array(score), pa.array((score >= threshold).astype(np.int32))]

    return T.annotated(docs, text_col, dict(zip(names, ("double", "int"), strict=True)), values, not drop_text, SLICE)
