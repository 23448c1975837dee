"""Target-distribution importance resampling: documents that look like the benchmark, by hashed features.

Features are runs of one to three words, dealt to buckets by their CRC-32. Weights are scored as arrays: a task keeps
numpy arrays of all buckets, and a run's CRC is combined from those of its words, so that no feature is made as a
string. Scores are persisted without texts; the cutoff is bisected by exact count jobs over them, first the score, then
doc_id among equal scores, then a row number among repeated rows. Ranks come from range partitions of what is selected.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legispark.llm import text as T
from legispark.llm.storage import removed, written
from legispark.operators.ranks import numbered

#: Buckets of features, and words in the longest feature.
BUCKETS, LONGEST = 10_000, 3
#: Documents with fewer words aren't drawn; percent of the others that are; seed of the noise.
MIN_WORDS, PERCENT, SEED = 20, 5, "42"
#: Thresholds that one count job tries: a range of numbers shrinks to so many parts at once.
PIVOTS = 15
#: The reversed polynomial of CRC-32; the largest id, which stands for none.
POLYNOMIAL, NO_ID = 0xEDB88320, (1 << 63) - 1


def _steps() -> np.ndarray:
    """[k, j, b]: what byte b of a CRC, at place j, becomes when 2**k zero bytes follow it; 32 tables by squaring."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(POLYNOMIAL), one >> 1).astype(np.uint32)
    byte = np.arange(256, dtype=np.uint32)
    tables = [np.stack([one] + [byte << np.uint32(8 * (j - 1)) for j in (1, 2, 3)])]
    for _ in range(31):
        last = tables[-1]
        tables.append(_moved(last, last.reshape(-1)).reshape(4, 256))
    return np.stack(tables)


def _moved(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    return table[0, x & 255] ^ table[1, (x >> 8) & 255] ^ table[2, (x >> 16) & 255] ^ table[3, x >> 24]


_STEPS = _steps()
#: Bytes after which a CRC is looked up in one step.
_NEAR = 32


def _far(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    for k in range(int(size.max(initial=0)).bit_length()):
        crc = np.where((size >> k) & 1, _moved(_STEPS[k], crc), crc)
    return crc


#: For each number of bytes up to _NEAR the four tables of its step, in one row.
_TABLES = np.concatenate([_far(np.concatenate([np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)]), np.full(1024, size)) for size in range(_NEAR + 1)])


def followed(crc: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The CRC-32s with so many bytes after them; to be xored with the CRC-32 of these bytes."""
    long = np.flatnonzero(size > _NEAR)
    at = np.where(size > _NEAR, 0, size).astype(np.int32) << 10
    out = _TABLES[at + (crc & 255)] ^ _TABLES[at + (256 + ((crc >> 8) & 255))] ^ _TABLES[at + (512 + ((crc >> 16) & 255))] ^ _TABLES[at + (768 + (crc >> 24))]
    if len(long):
        out[long] = _far(crc[long], size[long])
    return out


def buckets(text: pa.Array, n: int = BUCKETS, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of an array of texts: the bucket of each feature, the row it stands in, and each row's number of words."""
    words, at = T.split(T.recoded(text, T.ALNUM))
    code, known = T.coded(words)
    known = known.cast(pa.binary()).to_pylist()
    plain = np.array([zlib.crc32(w) for w in known], np.uint32)
    spaced = np.array([zlib.crc32(b" " + w) for w in known], np.uint32)
    size = np.array([len(w) + 1 for w in known], np.int32)
    row = np.repeat(np.arange(len(text)), np.diff(at))
    left = np.repeat(at[1:], np.diff(at)) - np.arange(len(code))  # words from here to the text's end
    crc = plain[code]
    found, rows = [crc % np.uint32(n)], [row]
    start = np.arange(len(code))
    for length in range(1, longest):
        held = left[start] > length
        start, crc = start[held], crc[held]
        last = code[start + length]
        crc = followed(crc, size[last]) ^ spaced[last]
        found.append(crc % np.uint32(n))
        rows.append(row[start])
    return np.concatenate(found), np.concatenate(rows), np.diff(at)


def bucket_counts(docs: DataFrame, text_col: str = "text", n: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall into each of n buckets; a task sums its own first. Null texts have none."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n, np.int64)
        for batch in T.slices(batches, "text", T.SLICE_BYTES // 2):
            total += np.bincount(buckets(T.strings(batch.column("text")), n, longest)[0], minlength=n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = docs.select(T.col(text_col).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(n, np.int64)
    for bucket, found in rows.collect():  # n rows at most
        out[bucket] = found
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed share in the target to that in the source, cut down."""
    n, all_s, all_t = len(source), int(source.sum()), int(target.sum())
    ratio = ((float(t + 1) * (all_s + n)) / (float(s + 1) * (all_t + n)) for s, t in zip(source.tolist(), target.tolist(), strict=True))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(id_: Column, seed: str = SEED) -> Column:
    """Gumbel noise in thousandths, cut down: drawing by it the highest scores samples in proportion to exp(weight)."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8)
    uniform = (F.conv(digits, 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(uniform))).cast("long")


def _place(rows: DataFrame, column: str, k: int, highest: bool) -> tuple[int, int, int]:
    """Of rows ordered by a whole-number column, from the highest or the least: the value of the k-th, how many of its value are among the first k, and how many there are."""
    sign = -1 if highest else 1
    value, (least, most) = sign * F.col(column), rows.agg(F.min(column), F.max(column)).first()
    low, high = sorted((sign * least, sign * most))  # the place lies in low..high
    while True:
        pivots = sorted({low + (high - low) * i // (PIVOTS + 1) for i in range(PIVOTS + 2)})
        counts = rows.agg(*[F.count_if(value <= F.lit(p)).alias(f"n{i}") for i, p in enumerate(pivots)], F.count_if(value < F.lit(low)).alias("below")).first()
        first = next(i for i, n in enumerate(counts) if n >= k)
        before = counts[first - 1] if first else counts["below"]
        if not first or pivots[first - 1] + 1 == pivots[first]:
            return sign * pivots[first], k - before, counts[first] - before
        low, high = pivots[first - 1] + 1, pivots[first]


def highest(rows: DataFrame, k: int) -> DataFrame:
    """Of rows (_score, _order, _row, all long, _row a row's own number) the k of highest score; ties go to the least _order, then _row."""
    taken, tied = F.lit(False), F.lit(True)
    if k > 0:
        for column, from_top in (("_score", True), ("_order", False), ("_row", False)):
            cut, k, n = _place(rows.where(tied), column, k, from_top)
            taken = taken | (tied & (F.col(column) > cut if from_top else F.col(column) < cut))
            tied = tied & (F.col(column) == cut)
            if k == n:  # all that tie are taken
                taken = taken | tied
                break
    return rows.where(taken)


def resampled(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, n: int = BUCKETS, longest: int = LONGEST, seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """id_col, n_words, n_features, weight, score, rank (all long but the id): rank is 1, 2, ... for what is drawn, else null.

    Null and empty texts have no features, the weight 0, and aren't drawn. Rows without an id share one noise and come
    last among equal scores; ids are whole numbers. Repeated rows are drawn one by one. With an empty target all
    features count alike; an empty table gives an empty result. A very long text is one step of a task. Other columns
    of docs don't matter.
    """
    value = gains(bucket_counts(docs, text_col, n, longest), bucket_counts(target, target_col, n, longest))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.slices(batches, "text", T.SLICE_BYTES // 2):
            bucket, row, words = buckets(T.strings(batch.column("text")), n, longest)
            weight = np.bincount(row, value[bucket], batch.num_rows).astype(np.int64)  # whole numbers under 2**53
            features = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("id"), *map(pa.array, (words, features, weight))], names=["id", "n_words", "n_features", "weight"])

    rows = docs.select(T.col(id_col).cast("long").alias("id"), T.col(text_col).alias("text")).mapInArrow(run, "id long, n_words long, n_features long, weight long")
    rows = rows.withColumn("score", F.col("weight") + noise(F.col("id"), seed)).withColumn("_row", F.monotonically_increasing_id())
    rows = written(rows, "scores")
    able = rows.where(F.col("n_words") >= min_words).select(F.col("score").alias("_score"), F.coalesce("id", F.lit(NO_ID)).alias("_order"), "_row")
    drawn = highest(able, percent * able.count() // 100)
    ranks = numbered(drawn, [F.desc("_score"), F.asc("_order"), F.asc("_row")], "rank").select("_row", "rank")
    return rows.join(ranks, "_row", "left").select(F.col("id").alias(id_col), "n_words", "n_features", "weight", "score", "rank")
