"""Context-tree weighting over bytes, learned from a corpus by counting in Spark.

A byte is eight binary choices; each prefix of them has a context tree whose contexts are the last 0 to DEPTH bytes. A
node's block probability is the Krichevsky-Trofimov estimate of its counts, so it depends on counts alone, and the
weighted one is half that and half the product of its children's. What the trees predict next, after the training
texts, is a fixed mix of the estimates along the context's path:

    P(s) = g(s) KT(s) + (1 - g(s)) P(child of s),    g(s) = KT block / (2 * weighted block)

Counts of (DEPTH + 1)-byte runs are summed by key over the cluster. Nodes of two context bytes and more are worked out
in tasks that each hold all runs with those two bytes; the at most 255 + 255 * 256 nodes above them are one broadcast.
Documents are dealt in blocks of bounded size, and each block gets the values of its own words, and of
its own runs, or of all runs where a count shows that they are few.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legispark.llm import text as T
from legispark.llm.storage import written

DEPTH = 5
#: Text of a block, in characters as Spark counts them.
BLOCK_CHARS = 24 << 20
#: Bytes whose runs are counted or looked up at once.
SLICE = 4 << 20
#: Runs whose values are broadcast after a count, 16 bytes each; more are joined to the blocks that have them.
BROADCAST_RUNS = 3_000_000
#: Fixed value: the byte that stands before and after each text; UTF-8 has no such byte.
EDGE = 0xFF
GRAM, WORD = 0, 1
_LN2 = float(np.log(2.0))


def _lgamma_half() -> object:
    """log((2n - 1)!! / 2^n) for all whole n by Stirling's series: log Gamma(n + 1/2) - log Gamma(1/2)."""

    def series(x: np.ndarray) -> np.ndarray:
        y = x + 8.0  # the series is exact to a double's last digits from here on
        shift = np.log(x * (x + 1) * (x + 2) * (x + 3)) + np.log((x + 4) * (x + 5) * (x + 6) * (x + 7))
        return (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - shift

    return series


lgamma = _lgamma_half()


def kt_block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Natural log of the estimate's probability of any sequence with a zeros and b ones."""
    a, b = a.astype(float), b.astype(float)
    return lgamma(a + 0.5) + lgamma(b + 0.5) - 2 * lgamma(np.array(0.5)) - lgamma(a + b + 1.0)


def runs(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The key of the run that ends at each byte of each lowered text and its end, and each text's offsets."""
    data, at = T.raw(pc.ascii_lower(text))
    sizes = np.diff(at)
    n = len(data) + len(sizes) * (DEPTH + 1)
    line = np.full(n, EDGE, np.uint8)
    place = T.spread(at[:-1] + np.arange(len(sizes)) * (DEPTH + 1) + DEPTH, sizes)
    line[place] = data
    key = np.zeros(n - DEPTH if n else 0, np.int64)
    for k in range(DEPTH + 1):
        key = (key << 8) | line[k : k + len(key)]
    starts = at[:-1] + np.arange(len(sizes)) * (DEPTH + 1)
    key = key[T.spread(starts, sizes + 1)]
    return key, np.concatenate([[0], np.cumsum(sizes + 1)])


def _words(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The key of each lowered word, and each text's offsets. Keys are 64-bit hashes: at 10 million words two meet with a chance of 3e-6."""
    flat, at = T.split(pc.ascii_lower(text))
    code, words = T.coded(flat)
    return (T.hashed(words).view(np.int64)[code] if len(code) else np.zeros(0, np.int64)), at


def _counted(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(keys, return_inverse=True)
    return found, np.bincount(where, weights=learn, minlength=len(found)).astype(np.int64)


def _tally(keys: np.ndarray, learn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys, and how often each is among those to learn from; sorting alone is faster than an inverse."""
    found = np.unique(keys)
    own, n = np.unique(keys[learn], return_counts=True)
    count = np.zeros(len(found), np.int64)
    count[np.searchsorted(found, own)] = n
    return found, count


def count_block(table: pa.Table) -> pa.Table:
    """block, learn, text of one block; returns block, kind, key, n (in texts to learn from)."""
    block = table.column("block")[0].as_py()
    out = []
    kinds: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {GRAM: [], WORD: []}
    for batch in T.slices(table.to_batches(), "text", SLICE):
        learn = batch.column("learn").to_numpy(zero_copy_only=False).astype(bool)
        text = T.strings(batch.column("text"))
        for kind, read in ((GRAM, runs), (WORD, _words)):
            keys, at = read(text)
            kinds[kind].append(_tally(keys, np.repeat(learn, np.diff(at))))
    for kind, parts in kinds.items():
        keys, n = _counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
        out.append(pa.table({"block": np.full(len(keys), block, np.int32), "kind": np.full(len(keys), kind, np.int32), "key": keys, "n": n}))
    return pa.concat_tables(out)


class Level:
    """All nodes with some number of context bytes: (context, prefix of the byte's bits) with counts and block logs."""

    def __init__(self, node: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None):
        self.node, self.a, self.b = node, a, b
        kt = kt_block(a, b)
        self.weighted = kt if below is None else np.logaddexp(kt, below) - _LN2
        self.share = np.ones(len(node)) if below is None else np.exp(kt - _LN2 - self.weighted)

    def mix(self, node: np.ndarray, bit: np.ndarray, below: np.ndarray) -> np.ndarray:
        """The chance of each bit at each node; a node without counts has half its own estimate, a half, and half what is below."""
        if not len(self.node):
            return 0.25 + 0.5 * below
        at = np.minimum(np.searchsorted(self.node, node), len(self.node) - 1)
        known = self.node[at] == node
        a, b = np.where(known, self.a[at], 0), np.where(known, self.b[at], 0)
        share = np.where(known, self.share[at], 0.5)
        return share * (np.where(bit, b, a) + 0.5) / (a + b + 1.0) + (1 - share) * below


def _choices(byte: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each of the eight choices: the prefix before it (1 and the bits so far) and its bit."""
    for k in range(8):
        yield (byte >> (8 - k)) | (1 << k), ((byte >> (7 - k)) & 1).astype(bool)


def _level(node: np.ndarray, a: np.ndarray, b: np.ndarray, below: np.ndarray | None) -> Level:
    found, where = np.unique(node, return_inverse=True)
    add = lambda v: np.bincount(where, weights=v, minlength=len(found)).astype(float)  # noqa: E731  (whole numbers where all is empty)
    return Level(found, add(a), add(b), None if below is None else add(below))


def subtree(keys: np.ndarray, n: np.ndarray, depth: int = DEPTH, top: int = 2) -> tuple[np.ndarray, Level]:
    """For runs with all of their last `top` context bytes' nodes: each run's eight chances at that depth, and that level."""
    byte = keys & 0xFF
    context = keys >> 8
    seen = n > 0
    node, a, b = [], [], []
    for prefix, bit in _choices(byte[seen]):
        node.append((context[seen] << 8) | prefix)
        a.append(np.where(bit, 0, n[seen]))
        b.append(np.where(bit, n[seen], 0))
    levels = [_level(np.concatenate(node), np.concatenate(a), np.concatenate(b), None)]
    for d in range(depth - 1, top - 1, -1):
        low = levels[-1]
        keep = (1 << (8 * d)) - 1
        levels.append(_level((((low.node >> 8) & keep) << 8) | (low.node & 0xFF), low.a, low.b, low.weighted))
    chances = np.empty((len(keys), 8))
    for k, (prefix, bit) in enumerate(_choices(byte)):
        p = np.full(len(keys), 0.5)
        for d, level in zip(range(depth, top - 1, -1), levels, strict=True):
            own = ((context & ((1 << (8 * d)) - 1)) << 8) | prefix
            if d == depth:
                at = np.minimum(np.searchsorted(level.node, own), max(0, len(level.node) - 1))
                known = level.node[at] == own if len(level.node) else np.zeros(len(own), bool)
                x, y = (np.where(known, v[at], 0) if len(level.node) else np.zeros(len(own)) for v in (level.a, level.b))
                p = (np.where(bit, y, x) + 0.5) / (x + y + 1.0)
            else:
                p = level.mix(own, bit, p)
        chances[:, k] = p
    return chances, levels[-1]


def _low(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs (key, n) of a partition; returns for each run its chances, and for each of the nodes at depth 2 its sums, as rows for depth 1."""
    table = pa.Table.from_batches(list(batches), pa.schema([("key", pa.int64()), ("n", pa.int64())]))
    if not table.num_rows:
        return
    keys, n = table.column("key").to_numpy(), table.column("n").to_numpy()
    chances, level = subtree(keys, n)
    flat = pa.FixedSizeListArray.from_arrays(pa.array(chances.ravel()), 8).cast(pa.list_(pa.float64()))
    none = pa.nulls
    for a in range(0, len(keys), 50_000):
        m = min(50_000, len(keys) - a)
        yield pa.RecordBatch.from_arrays([pa.array(keys[a : a + m]), flat.slice(a, m), none(m, pa.int64()), none(m, pa.float64()), none(m, pa.float64()), none(m, pa.float64())], names=["key", "chances", "node", "a", "b", "below"])
    one = (((level.node >> 8) & 0xFF) << 8) | (level.node & 0xFF)
    up = _level(one, level.a, level.b, level.weighted)
    m = len(up.node)
    below = _sum_below(one, level.weighted, up.node)
    yield pa.RecordBatch.from_arrays([none(m, pa.int64()), none(m, pa.list_(pa.float64())), pa.array(up.node), pa.array(up.a), pa.array(up.b), pa.array(below)], names=["key", "chances", "node", "a", "b", "below"])


def _sum_below(node: np.ndarray, value: np.ndarray, found: np.ndarray) -> np.ndarray:
    return np.bincount(np.searchsorted(found, node), weights=value, minlength=len(found)).astype(float)


def run_values(grams: DataFrame) -> tuple[DataFrame, int]:
    """key, n (long) of all runs; returns key, value: log10 of the chance of the run's last byte after the others; and how many."""
    spark = grams.sparkSession
    context = F.shiftrightunsigned("key", 8).bitwiseAND(F.lit(0xFFFF))
    low = written(grams.repartition(context).mapInArrow(_low, "key long, chances array<double>, node long, a double, b double, below double"), "runs")
    rows = low.where("node is not null").groupBy("node").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.sum("below").alias("below")).collect()  # 255 * 256 at most
    rows.sort(key=lambda r: r.node)
    column = lambda c, kind: np.array([getattr(r, c) for r in rows], kind)
    one = Level(column("node", np.int64), column("a", float), column("b", float), column("below", float))
    zero = _level(one.node & 0xFF, one.a, one.b, one.weighted)
    levels = spark.sparkContext.broadcast((one, zero))

    def top(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, zero = levels.value
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column("key").to_numpy()
            chances = batch.column("chances").flatten().to_numpy().reshape(-1, 8)
            value = np.zeros(len(keys))
            for k, (prefix, bit) in enumerate(_choices(keys & 0xFF)):
                p = one.mix((((keys >> 8) & 0xFF) << 8) | prefix, bit, chances[:, k])
                value += np.log10(zero.mix(prefix, bit, p))
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(value)], names=["key", "value"])

    low = low.where("key is not null").select("key", "chances")
    return low.mapInArrow(top, "key long, value double"), low.count()


class Lookup:
    """Values by key, in a table of open addresses four times as large; sought keys must be there."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = np.uint64(64 - max(4, int(4 * len(keys)).bit_length()))
        self.slots = np.full(1 << (64 - int(self.bits)), -1, np.int32)
        self.keys, self.values = keys, values
        left, probe = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], probe)
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            left, probe = left[self.slots[slot] != left], probe + 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return (T.mixed(keys.view(np.uint64) + np.uint64(probe)) >> self.bits).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self.slots[self._slot(keys, 0)]
        left, probe = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(0), 1
        while len(left):
            found = self.slots[self._slot(keys[left], probe)]
            at[left] = found
            left, probe = left[self.keys[found] != keys[left]], probe + 1
        return self.values[at]


_KEPT: list = []


def _lookup(runs: tuple[np.ndarray, np.ndarray]) -> Lookup:
    """The table of a broadcast, made once in each worker."""
    if not _KEPT or _KEPT[0] is not runs:
        _KEPT[:] = [runs, Lookup(*runs)]
    return _KEPT[1]


def score_block(docs: pa.Table, values: pa.Table, grams: Lookup | None = None) -> pa.Table:
    """The texts of a block, and the values of its words and of its runs, if not of all; returns id, learn, n_tokens, n_known, logs, score, n_bytes (with the end)."""
    kind, key, value = (values.column(c).to_numpy() for c in ("kind", "key", "value"))
    grams = grams or Lookup(key[kind == GRAM], value[kind == GRAM])
    words = Lookup(key[kind == WORD], value[kind == WORD])
    out = []
    for batch in T.slices(docs.to_batches(), "text", SLICE):
        text = T.strings(batch.column("text"))
        keys, at = runs(text)
        score, n_bytes = T.sums(grams(keys).astype(np.float64), at), np.diff(at)
        keys, at = _words(text)
        count = words(keys) if len(keys) else np.zeros(0)
        n = np.diff(at) + 1
        known = T.sums((count > 0).astype(np.int64), at)
        out.append(pa.RecordBatch.from_arrays([batch.column("id"), batch.column("learn"), pa.array(n), pa.array(known), pa.array(T.sums(np.log10(count + 1), at)), pa.array(score), pa.array(n_bytes)], names=["id", "learn", "n_tokens", "n_known", "logs", "score", "n_bytes"]))
    schema = pa.schema([("id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())])
    return pa.Table.from_batches(out).cast(schema) if out else schema.empty_table()


def scores(spark: SparkSession, docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """A row for each row of docs: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Learns from the rows where `learn` is true; null counts as false. Tokens are the words between ASCII white space,
    A-Z lowered, and one end. base_score adds one to every count; score is log10 of the trees' chance of the lowered
    text's bytes and its end, bits_per_byte the code length that this is for each of them. Null and empty texts have the end alone. Nothing to learn from leaves all estimates even.
    Rows that repeat are scored, and learned from, each time. An empty table gives an empty result.
    """
    rows = docs.select(T.col(id_col).cast("long").alias("id"), F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce(T.col(text_col), F.lit("")).alias("text"))
    n, size, trained = rows.agg(F.count(F.lit(1)), F.sum(F.length("text")), F.sum(F.col("learn").cast("long"))).first()
    blocks = max(1, -(-(size or 0) // block_chars))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id", F.substring("text", 1, 64)), F.lit(blocks)).cast("int")).select("block", "id", "learn", "text")
    counts = written(rows.groupBy("block").applyInArrow(count_block, "block int, kind int, key long, n long"), "counts")
    totals = counts.where(f"kind = {WORD}").groupBy("key").agg(F.sum("n").alias("n"))
    tokens, distinct = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    end = trained or 0
    tokens, distinct = tokens + end, distinct + (end > 0)
    runs_, n_runs = run_values(counts.where(f"kind = {GRAM}").groupBy("key").agg(F.sum("n").alias("n")))
    known = totals.select(F.lit(WORD).alias("kind"), "key", F.col("n").cast("double").alias("value"))
    own, shared = counts.select("block", "kind", "key"), None
    if n_runs <= BROADCAST_RUNS:
        shared = spark.sparkContext.broadcast(tuple(runs_.toArrow().column(c).to_numpy() for c in ("key", "value")))
        own = own.where(f"kind = {WORD}")
    else:
        known = known.unionByName(runs_.select(F.lit(GRAM).alias("kind"), "key", "value"))
    values = own.join(known, ["kind", "key"]).select("block", "kind", "key", "value")

    def score(docs: pa.Table, values: pa.Table) -> pa.Table:
        return score_block(docs, values, _lookup(shared.value) if shared else None)

    found = rows.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(score, "id long, learn boolean, n_tokens long, n_known long, logs double, score double, n_bytes long")
    base = F.col("logs") + F.lit(float(np.log10(end + 1))) - F.col("n_tokens") * F.lit(float(np.log10(tokens + distinct + 1)))
    return found.select(F.col("id").alias("doc_id"), (~F.col("learn")).alias("held_out"), "n_tokens", (F.col("n_known") + F.lit(int(end > 0))).alias("n_known"), F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score", (F.col("score") * F.lit(-1 / float(np.log10(2))) / F.col("n_bytes")).alias("bits_per_byte"))
