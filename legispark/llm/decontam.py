"""Benchmark passages in documents, found by Wu and Manber's multi-pattern search over words.

Patterns are windows of words; those of one length are searched together. A shift table over hashed pairs of words
tells how far a position may skip; where it says zero, the window's suffix hash picks a bucket of patterns, a prefix
hash narrows it, and a comparison word by word confirms. Stretches of text advance side by side in numpy. The tables of
a benchmark are built in tasks, in blocks of bounded size, and kept as files in the shared folder; a search task has
one block in memory at a time.
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legispark.llm import text as T
from legispark.llm.storage import fresh, opened

WINDOW = 10
#: Benchmark text whose tables a task holds at once; a larger benchmark is searched in several blocks.
BLOCK_BYTES = 16 << 20
#: Word positions that one cursor walks over.
STRETCH = 256
SHIFT_BITS = 20


def _words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    return T.split(T.recoded(text, T.ALNUM))


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return T.mixed(a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64))


@dataclass
class Tables:
    """What searches for all patterns of one length."""

    length: int
    shift: np.ndarray
    keys: np.ndarray
    rows: np.ndarray
    items: list[np.ndarray]

    @classmethod
    def of(cls, rows: np.ndarray, items: list[np.ndarray]) -> Tables:
        m = rows.shape[1]
        shift = np.full(1 << SHIFT_BITS, max(1, m - 1), np.int64)
        for k in range(min(1, m - 1), m):  # the last occurrence is the smallest shift
            h = cls._ending(rows, k) & np.uint64((1 << SHIFT_BITS) - 1)
            np.minimum.at(shift, h.astype(np.int64), m - 1 - k)
        keys = cls.hashes(rows)
        order = np.argsort(keys, kind="stable")
        return cls(m, shift, keys[order], rows[order], [items[i] for i in order])

    @staticmethod
    def _ending(rows: np.ndarray, k: int) -> np.ndarray:
        return _pair(rows[:, k - 1] if k else np.zeros(len(rows)), rows[:, k])

    @classmethod
    def hashes(cls, rows: np.ndarray) -> np.ndarray:
        """The suffix hash in the upper half, the prefix hash in the lower."""
        h = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1] - 1):
            h = _pair(h, rows[:, k])
        return (cls._ending(rows, rows.shape[1] - 1) & np.uint64(0xFFFFFFFF00000000)) | (h >> np.uint64(32))

    def search(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts of occurrences and their patterns; words has -1 where no pattern's word stands."""
        m, n = self.length, len(words)
        begin = np.arange(m - 1, n, STRETCH)
        at, end = begin.copy(), np.minimum(begin + STRETCH, n)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        mask = np.uint64((1 << SHIFT_BITS) - 1)
        while len(at):
            before = words[at - 1] if m > 1 else np.zeros(len(at), np.int64)
            skip = self.shift[(_pair(before, words[at]) & mask).astype(np.int64)]
            stop = at[skip == 0]
            if len(stop):
                found.append(self._confirmed(words, stop - m + 1))
            at = at + np.maximum(skip, 1)
            live = at < end
            at, end = at[live], end[live]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _confirmed(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        windows = words[starts[:, None] + np.arange(self.length)]
        h = self.hashes(windows)
        low, high = np.searchsorted(self.keys, h), np.searchsorted(self.keys, h, "right")
        out_s, out_p = [], []
        while len(starts):
            live = low < high
            starts, windows, low, high = starts[live], windows[live], low[live], high[live]
            same = (self.rows[low] == windows).all(axis=1)
            out_s.append(starts[same])
            out_p.append(low[same])
            low = low + 1
        return np.concatenate(out_s), np.concatenate(out_p)


@dataclass
class Block:
    """The patterns of some items: their words, their ids as strings or None, tables by length."""

    words: pa.Array
    ids: list[str | None]
    tables: list[Tables]

    @classmethod
    def of(cls, ids: list[str | None], texts: list[str], window: int) -> Block:
        flat, at = _words(pa.array(texts, pa.string()))
        code, words = T.coded(flat)
        by_length: dict[int, dict[bytes, set[int]]] = {}
        for i in range(len(ids)):
            own = code[at[i] : at[i + 1]]
            m = min(window, len(own))
            for s in range(len(own) - m + 1 if m else 0):
                by_length.setdefault(m, {}).setdefault(own[s : s + m].tobytes(), set()).add(i)
        tables = []
        for _, patterns in sorted(by_length.items()):
            rows = np.array([np.frombuffer(p, np.int64) for p in patterns])
            tables.append(Tables.of(rows, [np.array(sorted(v)) for v in patterns.values()]))
        return cls(words, ids, tables)

    def hits(self, flat: pa.Array, at: np.ndarray) -> tuple[np.ndarray, list[set[str]]]:
        """For each word whether it is hit, and for each text the ids of the items found in it."""
        n_docs = len(at) - 1
        n, found = int(at[-1]), [set() for _ in range(n_docs)]
        cover = np.zeros(n + 1, np.int64)
        code, words = T.coded(flat)
        known = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        doc = np.repeat(np.arange(n_docs), np.diff(at))
        line = np.full(n + n_docs, -1, np.int64)  # a gap after each text
        place = np.arange(n) + doc
        line[place] = known[code] if n else 0
        back = np.full(n + n_docs, -1, np.int64)
        back[place] = np.arange(n)
        for table in self.tables:
            starts, patterns = table.search(line)
            starts = back[starts]
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + table.length, -1)
            for d, p in set(zip(doc[starts].tolist(), patterns.tolist(), strict=True)):
                found[d].update(self.ids[i] for i in table.items[p] if self.ids[i] is not None)
        return np.cumsum(cover[:-1]) > 0, found


def _write_blocks(benchmark: DataFrame, directory: str, window: int, id_col: str, text_col: str, limit: int) -> int:
    """Builds the benchmark's tables in blocks of about so many bytes of text, a file each; returns their number."""
    rows = benchmark.select(T.col(id_col).cast("string").alias("id"), T.col(text_col).alias("text")).where("text is not null")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total * 2 // limit))
    rows = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int").alias("block"), "id", "text")

    def build(table: pa.Table) -> pa.Table:
        from pyspark import TaskContext

        k = table.column("block")[0].as_py()
        table = table.sort_by([("id", "ascending"), ("text", "ascending")])
        block = Block.of(table.column("id").to_pylist(), table.column("text").to_pylist(), window)
        fs, base = opened(directory)
        fs.create_dir(base, recursive=True)
        part = f"{base}/part-{k}.{TaskContext.get().taskAttemptId()}"
        with fs.open_output_stream(part, compression=None) as stream:  # a name of the task's own, so that a rerun replaces the same file
            stream.write(pickle.dumps(block, protocol=5))
        fs.move(part, f"{base}/block-{k}")
        return pa.table({"block": pa.array([k], pa.int32())})

    rows.groupBy("block").applyInArrow(build, "block int").count()
    return n


_KEPT: dict[str, Block | None] = {}


def _block(directory: str, k: int) -> Block | None:
    """A block's tables; the last one stays in the worker. None if no item fell into the block."""
    path = f"{directory}/block-{k}"
    if path not in _KEPT:
        _KEPT.clear()
        fs, base = opened(directory)
        if fs.get_file_info(f"{base}/block-{k}").type == pafs.FileType.NotFound:
            _KEPT[path] = None
        else:
            with fs.open_input_file(f"{base}/block-{k}") as stream:
                _KEPT[path] = pickle.loads(stream.read())  # written by _write_blocks
    return _KEPT[path]


def without_benchmark(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without any hit, with all their columns as they are, whatever they are named."""
    names = {n: T.unused(docs.columns, n) for n in NEW}
    found = contamination(spark, docs, benchmark, keep_text=True, names=names)
    return found.where(~T.col(names["contaminated"])).select(*map(T.col, docs.columns))


#: The new columns.
NEW = {"n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"}


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_bytes: int = BLOCK_BYTES, keep_text: bool = False, names: dict[str, str] | None = None) -> DataFrame:
    """docs' columns (the text only if asked for), and n_words, n_hit, n_items, items_sha256, contaminated.

    An item's windows are its runs of `window` words; an item of fewer words, but not none, is one window. Null or
    wordless texts have no words and no hits; so has every document where the benchmark is empty. Rows that repeat
    give rows that repeat; items that share an id count once. Items without an id hit words as others do, but can be
    neither counted nor listed. New columns, whose names may be given, take the place of docs' columns of that name.
    """
    directory = fresh(spark, "benchmark")
    n = _write_blocks(benchmark, directory, window, item_col, item_text_col, block_bytes)

    def search(text: pa.Array) -> list:
        flat, at = _words(text)
        hit, found = np.zeros(int(at[-1]), bool), [set() for _ in range(len(text))]
        for k in range(n):
            block = _block(directory, k)
            if block:
                more, ids = block.hits(flat, at)
                hit |= more
                for a, b in zip(found, ids, strict=True):
                    a |= b
        n_hit = T.sums(hit.astype(np.int64), at)
        sha = [hashlib.sha256(",".join(sorted(f)).encode()).hexdigest() for f in found]
        return [pa.array(np.diff(at)), pa.array(n_hit), pa.array([len(f) for f in found], pa.int64()), pa.array(sha, pa.string()), pa.array(n_hit > 0)]

    return T.annotated(docs, text_col, {(names or {}).get(k, k): v for k, v in NEW.items()}, search, keep_text)
