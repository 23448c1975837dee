"""Arrow and numpy helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as K

#: Text that one step of a task takes on, in bytes; a longer text is a step of its own.
SLICE_BYTES = 4 << 20

#: Rows of an Arrow batch between Spark and Python; texts are long, and each task holds a few batches.
BATCH_ROWS = 1000

#: Words of letters and digits are what is left between these bytes, A-Z lowered first.
ALNUM = np.arange(256, dtype=np.uint8)
ALNUM[0x41:0x5B] += 32
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0x20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bounds the session's Arrow batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def col(name: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(columns: Iterable[str], name: str) -> str:
    """The name, with underscores before it until no column has it; Spark tells no case apart."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def annotated(docs: DataFrame, text_col: str, new: dict[str, str], values: Callable[[pa.Array], list], keep_text: bool = False, limit: int | None = None) -> DataFrame:
    """docs' columns (the text only if asked for) and new ones (name: type), whose values a function gives for an array of texts.

    Null texts come as empty ones. New columns take the place of docs' columns of that name; all others stay as they are.
    """
    taken = {n.lower() for n in new}
    kept = [c for c in docs.columns if c.lower() not in taken and (keep_text or c != text_col)]
    inner = {c: f"c{i}" for i, c in enumerate(kept)}  # on the way through Arrow, so that no names clash
    column = inner.get(text_col, "text")
    rows = docs.select(*(col(c).alias(i) for c, i in inner.items()), *([col(text_col).alias("text")] if column == "text" else []))
    added = K.StructType.fromDDL(", ".join(f"n{i} {t}" for i, t in enumerate(new.values())))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, column, limit or SLICE_BYTES):
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in inner.values()), *values(strings(batch.column(column)))], names=[*inner.values(), *added.names])

    out = rows.mapInArrow(run, K.StructType([*rows.schema.fields[: len(inner)], *added.fields]))
    return out.select(*(F.col(i).alias(c) for c, i in inner.items()), *(F.col(f"n{i}").alias(n) for i, n in enumerate(new)))


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about so much text: small ones are joined, large ones cut."""
    held, room = [], limit
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total, a = np.cumsum(size, dtype=np.int64), 0
        while a < batch.num_rows:
            done = int(total[a - 1]) if a else 0
            b = max(a + 1, int(np.searchsorted(total, done + room, "right")))
            held.append(batch.slice(a, b - a))
            room -= int(total[b - 1]) - done
            a = b
            if room <= 0 or a < batch.num_rows:
                yield _joined(held)
                held, room = [], limit
    if held:
        yield _joined(held)
    pa.default_memory_pool().release_unused()  # workers live on


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def strings(column: pa.Array) -> pa.Array:
    """As plain strings, null as the empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    return pc.fill_null(column.cast(pa.string()), "")


def raw(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the offset of each and of the end."""
    _, offsets, data = text.buffers()
    if not len(text):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def recoded(text: pa.Array, table: np.ndarray) -> pa.Array:
    """Each byte replaced by the table's; the table leaves bytes over 127 alone."""
    data, at = raw(text)
    return pa.StringArray.from_buffers(len(text), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(table[data]))


def split(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words between ASCII white space, and the offset of each text's first word and of the end."""
    lists = pc.ascii_split_whitespace(text)
    flat, count = lists.flatten(), pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if not full.all():
        row = np.repeat(np.arange(len(count)), count)[full]
        count, flat = np.bincount(row, minlength=len(count)), flat.filter(pa.array(full))
    return flat, np.concatenate([[0], np.cumsum(count, dtype=np.int64)])


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """A number for each word, and the word of each number."""
    both = words.dictionary_encode()
    return both.indices.to_numpy(zero_copy_only=False).astype(np.int64), both.dictionary


def hashed(words: pa.Array) -> np.ndarray:
    """64 bits for each word, alike in every process."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False), categorize=False)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each run, one run after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


def sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of each run between the offsets, 0 for an empty run."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[at[1:]] - total[at[:-1]]
