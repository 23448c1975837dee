"""Near-duplicate documents: fast similarity sketches, banding, then exact verification on whole sets.

The sketch (Dahlgaard, Knudsen and Thorup, 2017) throws every shingle into one of t bins, round after round, and keeps
each bin's least (round, value); rounds t to 2t - 1 throw everything into one bin each, so all bins fill. Rows of bins
are hashed to bands. Exact copies of a set are one node. A bucket of few nodes is paired; a larger one is dealt in
chunks over tasks that intersect whole sets and return only the links of a spanning forest. Chunks differ from bucket
to bucket, so these links join most groups whole; what they leave apart in a bucket is then compared across its chunks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from legispark.llm import text as T
from legispark.llm.graph import components
from legispark.llm.storage import written

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: At the threshold a pair shares no band with a chance of (1 - 0.8^6)^42 = 3e-6.
BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
#: Nodes of a bucket that are paired, and of a chunk.
PAIRED, CHUNK = 8, 256
#: Ids that are broadcast at most, of 8 bytes.
BROADCAST_IDS = 1_000_000

_ODD = T.mixed(np.arange(1, 4096, dtype=np.uint64)) | np.uint64(1)
_SEEDS = T.mixed(np.arange(1, 2 * BINS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_ROUND, _VALUE = np.uint64(54), np.uint64(10)


def shingles(code_hash: np.ndarray, at: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Each text's set of k-word shingles as sorted hashes; fewer words are one shingle, none give an empty set."""
    n = len(code_hash)
    h = np.full(n, k, np.uint64)
    for j in range(k):
        if j < n:
            h[: n - j] += T.mixed(code_hash[j:] ^ _ODD[j]) * _ODD[k + j]
    h = T.mixed(h)
    for a, b in zip(at[:-1], at[1:], strict=True):
        if b - a >= k:
            yield np.unique(h[a : b - k + 1])
        elif b > a:
            own = T.mixed(code_hash[a:b] ^ _ODD[: b - a]) * _ODD[k : k + b - a]
            yield T.mixed(own.sum(dtype=np.uint64, keepdims=True) + np.array([b - a], np.uint64))
        else:
            yield np.zeros(0, np.uint64)


def sketch(items: np.ndarray) -> np.ndarray:
    """The least (round, value) of each bin; two sets' bins agree with a chance of about their similarity."""
    out = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
    some = max(1, -(-6 * BINS // len(items)))
    done = 0
    while done < BINS and (out == np.iinfo(np.uint64).max).any():
        rounds = np.arange(done, min(BINS, done + some))
        v = T.mixed(items[None, :] ^ _SEEDS[rounds][:, None])
        bins = ((v >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
        key = (rounds.astype(np.uint64)[:, None] << _ROUND) | (T.mixed(v) >> _VALUE)
        np.minimum.at(out, bins.ravel().astype(np.int64), key.ravel())
        done = int(rounds[-1]) + 1
        some = max(1, some // 2)
    for j in np.flatnonzero(out == np.iinfo(np.uint64).max):
        v = T.mixed(items ^ _SEEDS[BINS + j])
        out[j] = (np.uint64(BINS + j) << _ROUND) | (v.min() >> _VALUE)
    return out


def bands(items: np.ndarray) -> np.ndarray:
    """A key for each band; the band's number is part of it."""
    rows = sketch(items).reshape(BANDS, ROWS)
    return T.mixed((T.mixed(rows) * _ODD[100 : 100 + ROWS]).sum(axis=1, dtype=np.uint64) ^ _ODD[200 : 200 + BANDS]).view(np.int64)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[np.ndarray]:
    flat, at = T.split(pc.ascii_lower(T.strings(batch.column("text"))))
    code, words = T.coded(flat)
    return shingles(T.hashed(words)[code] if len(code) else np.zeros(0, np.uint64), at, k)


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """docs: id, text. Returns id, n_shingles, two hashes of the set, and the bands (null for an empty set)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text", 2 << 20):
            n, h1, h2, keys = [], [], [], []
            for items in _sets(batch, k):
                n.append(len(items))
                m = T.mixed(items)
                h1.append(int(m.sum(dtype=np.uint64).view(np.int64)))
                h2.append(int(np.bitwise_xor.reduce(T.mixed(m)).view(np.int64)) if len(m) else 0)
                keys.append(bands(items) if len(items) else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n_shingles", "h1", "h2", "bands"])

    return docs.mapInArrow(run, "id long, n_shingles long, h1 long, h2 long, bands array<long>")


def similar(n_a: int, n_b: int, both: int, percent: int) -> bool:
    return 100 * both >= percent * (n_a + n_b - both)


def forest(sets: list[np.ndarray], percent: int, side: np.ndarray | None = None, part: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links of a spanning forest of the pairs that are similar, of different sides only and between parts only if these are given.

    Intersections come from products of the sets' incidence matrix, shingles that only one set has left out.
    """
    n = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), n)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count[code] > 1
    row, code = row[shared], np.unique(code[shared], return_inverse=True)[1]
    both = np.zeros((len(sets), len(sets)), np.float32)
    width = int(code.max()) + 1 if len(code) else 0
    for a in range(0, width, 8192):
        own = (code >= a) & (code < a + 8192)
        m = np.zeros((len(sets), min(8192, width - a)), np.float32)
        m[row[own], code[own] - a] = 1
        both += m @ m.T
    ok = np.triu(100 * both.astype(np.int64) >= percent * (n[:, None] + n[None, :] - both.astype(np.int64)), 1)
    if side is not None:
        ok &= side[:, None] != side[None, :]
    part = np.arange(len(sets)) if part is None else np.unique(part, return_inverse=True)[1]
    ok &= part[:, None] != part[None, :]
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    links = []
    for a, b in zip(*np.nonzero(ok), strict=True):
        x, y = find(int(part[a])), find(int(part[b]))
        if x != y:
            root[max(x, y)] = min(x, y)
            links.append((int(a), int(b)))
    return links


def _paired(small: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the pairs of buckets with few nodes."""
    group = small.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("id", "n"))).alias("g"))  # PAIRED at most
    pairs = (
        group.select(F.posexplode("g").alias("i", "x"), "g")
        .select("x", F.explode(F.slice("g", F.col("i") + 2, F.size("g"))).alias("y"))
        .where(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )
    rows = pairs.join(sets.select(F.col("id").alias("a"), F.col("items").alias("s")), "a").join(sets.select(F.col("id").alias("b"), F.col("items").alias("t")), "b")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, t = (batch.column(c).to_pylist() for c in ("s", "t"))
            keep = []
            for x, y in zip(s, t, strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                keep.append(similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return rows.select("a", "b", "s", "t").mapInArrow(verify, "a long, b long")


def _chunks(nodes: str, by: str) -> Column:
    """A node's chunk among those of so many nodes, other ones in each bucket."""
    return F.pmod(F.xxhash64(by, "key"), F.ceil(F.col(nodes) / CHUNK).cast("long"))


def _links(table: pa.Table, percent: int) -> pa.Table:
    ids = table.column("id").to_pylist()
    side, part = (table.column(c).to_numpy() if c in table.column_names else None for c in ("side", "part"))
    found = forest([np.frombuffer(x, np.uint64) for x in table.column("items").to_pylist()], percent, side, part)
    return pa.table({"a": pa.array([ids[a] for a, _ in found], pa.int64()), "b": pa.array([ids[b] for _, b in found], pa.int64())})


def _within(large: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links within the chunks of buckets of many nodes; a bucket sends each of its sets once."""
    rows = large.select("key", _chunks("in_bucket", "id").alias("c"), "id").join(sets, "id")
    return rows.select("key", "c", "id", "items").groupBy("key", "c").applyInArrow(lambda t: _links(t, percent), "a long, b long")


def _across(wide: DataFrame, sets: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links between what `known` (node, component) leaves apart in buckets of several chunks.

    Of two such nodes one at least is outside the bucket's largest part. The nodes outside are dealt in chunks too, and
    each of these meets each chunk of the bucket, so a bucket of one part sends nothing, and one with few nodes outside
    sends its sets once. Only buckets of unlike sets go by pairs of chunks, as they must.
    """
    placed = wide.join(known.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id"))
    parts = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("m"))
    most = parts.groupBy("key").agg(F.max(F.struct("m", "part")).alias("most"), F.sum("m").alias("all")).select("key", F.col("most.part").alias("main"), (F.col("all") - F.col("most.m")).alias("outside"))
    rows = placed.join(most.where("outside > 0"), "key").withColumn("own", F.when(F.col("part") != F.col("main"), _chunks("outside", "id")))
    rows = rows.withColumns({"c": _chunks("in_bucket", "id"), "chunks": F.ceil(F.col("in_bucket") / CHUNK).cast("long"), "others": F.ceil(F.col("outside") / CHUNK).cast("long")})
    zero = F.lit(0).cast("long")
    left = rows.where("own is not null").select("key", F.col("own").alias("i"), F.explode(F.sequence(zero, F.col("chunks") - 1)).alias("j"), F.lit(True).alias("side"), "part", "id")
    # two nodes outside meet once: in the lesser of their chunks
    right = rows.select("key", F.explode(F.sequence(zero, F.coalesce("own", F.col("others") - 1))).alias("i"), F.col("c").alias("j"), F.lit(False).alias("side"), "part", "id")
    met = left.unionByName(right).join(sets, "id").select("key", "i", "j", "side", "part", "id", "items")
    return met.groupBy("key", "i", "j").applyInArrow(lambda t: _links(t, percent), "a long, b long")


def without_copies(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """docs, with all columns as they are, with one row of each group: a row of its least doc_id.

    Rows that share an id but not a text are apart. Rows with a null doc_id stay. Null and wordless texts stay, but rows
    that repeat an id and such a text are one.
    """
    node, number = T.unused(docs.columns, "_node"), T.unused([*docs.columns, "_node"], "_n")
    named = docs.where("doc_id is not null")
    texts = named.groupBy("doc_id").agg(F.min(F.xxhash64("text")).alias("a"), F.max(F.xxhash64("text")).alias("b")).where("a <> b")
    apart = not texts.isEmpty()
    key = F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id", "text")) if apart else F.col("doc_id").cast("long")
    rows = docs.withColumn(node, key)
    found = near_duplicates(spark, rows.select(F.col(node).alias("id"), "text"), k, percent, "id")
    found = written(found.select(F.col("doc_id").alias(node), "component_id", "kept"), "groups").where(T.col(node).isNotNull())
    if apart:  # the least node of a group isn't that of its least doc_id
        least = found.join(rows.where(T.col(node).isNotNull()).select(node, "doc_id").distinct(), node)
        least = least.groupBy("component_id").agg(F.min(F.struct("doc_id", node))[node].alias("least"))
        found = written(found.join(least, "component_id").select(node, (T.col(node) == F.col("least")).alias("kept")), "groups")
    gone = found.where("not kept").select(node).distinct()
    again = found.where("kept").groupBy(node).count().where("count > 1").select(node)
    stay = rows.join(_counted(gone), node, "left_anti")
    if not again.isEmpty():
        first = Window.partitionBy(node).orderBy("text")
        twice = stay.join(_counted(again), node, "left_semi").withColumn(number, F.row_number().over(first)).where(T.col(number) == 1).drop(number)
        stay = stay.join(_counted(again), node, "left_anti").unionByName(twice)
    return stay.select(*map(T.col, docs.columns))


def _counted(ids: DataFrame) -> DataFrame:
    """Ids to join with: broadcast if a count shows that they are few, else shuffled with the documents."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, component_id (least id it reaches over links), kept.

    Words are what ASCII white space parts, A-Z lowered; a set has the distinct runs of k words, or the whole text if it
    has fewer. Null or wordless texts have an empty set, link with nothing and are kept. Rows that repeat an id are one
    node with the links of all its texts; a null id reaches nothing: its component_id is null and it is kept. An empty
    table gives an empty result. Other columns are ignored.
    """
    rows = docs.select(T.col(id_col).cast("long").alias("id"), T.col(text_col).alias("text"))
    all_ = written(sketches(rows, k), "sketches")
    known = all_.where("id is not null and n_shingles > 0")
    classes = known.groupBy("h1", "h2", "n_shingles").agg(F.min(F.struct("id", "bands")).alias("least"))
    classes = written(classes.select("h1", "h2", "n_shingles", F.col("least.id").alias("rep"), F.col("least.bands").alias("bands")), "classes")
    keyed = classes.select(F.col("rep").alias("id"), F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    counts = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("in_bucket")).where("in_bucket > 1")
    met = written(keyed.join(counts, "key"), "buckets")
    wanted = met.select("id").distinct()

    def whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text", 2 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([s.tobytes() for s in _sets(batch, k)], pa.binary())], names=["id", "items"])

    sets = written(rows.join(wanted, "id", "left_semi").mapInArrow(whole, "id long, items binary"), "sets")
    links = _paired(met.where(F.col("in_bucket") <= PAIRED), sets, percent).unionByName(_within(met.where(F.col("in_bucket") > PAIRED), sets, percent))
    reps = all_.select("id", "n_shingles", "h1", "h2").join(classes.drop("bands"), ["h1", "h2", "n_shingles"], "left").select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.col("rep")).alias("rep"))
    reps = written(reps, "reps")
    # copies need no links: a class is one node; an id with several texts ties their classes
    several = reps.where("rep is not null").groupBy("id").agg(F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most")
    ties = reps.join(several.select("id", "least"), "id").where("rep <> least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    found = components(links.unionByName(ties), "links")
    wide = met.where(F.col("in_bucket") > CHUNK)
    if not wide.isEmpty():
        more = written(_across(wide, sets, found, percent), "across")
        if not more.isEmpty():
            found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more), "links")
    out = reps.join(found.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "id")
    return out.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
