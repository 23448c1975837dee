"""Filter interaction audit: what each filter removes in every order of the filters, per part of the corpus.

Spark reduces documents to counts of failure masks (a bit per filter) and labels per part. Then removal ranks are a
min-plus product: a mask is a row with 0 for each filter it fails and infinity elsewhere, an order is a column with each
filter's place; their minimum of sums is the step that removes documents of that mask in that order. The step is where
a mask's counts are scattered to.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legispark.llm import text as T

#: The filter that looks for repeats, and the classes of labels a document can have (bit 0 good, bit 1 toxic).
REPEAT, CLASSES = "E", 4
#: Parts whose counts one step of a task scatters.
PARTS = 64
#: What the audit counts, in the order of its columns.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def filters(text: Column) -> dict[str, Column]:
    """The conditions that fail a text by itself; the text isn't null. Long texts are split whole."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return {
        "A": F.size(words) < 200,
        "B": 100 * F.size(F.array_distinct(words)) < 50 * F.size(words),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")) > 3 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def removal_steps(n: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of n filters, and [mask, order]: the step from 1 that removes a document of that mask, n + 1 if none does."""
    orders = list(permutations(range(n)))
    fails = np.where((np.arange(1 << n)[:, None] >> np.arange(n)) & 1, 0, n + 1)  # mask by filter
    place = np.argsort(np.array(orders), axis=1).T + 1  # filter by order: the inverse permutations
    steps = np.full((1 << n, len(orders)), n + 1)
    for f in range(n):
        np.minimum(steps, fails[:, f, None] + place[None, f], out=steps)
    return orders, steps


def scattered(counts: np.ndarray) -> tuple[list[tuple[int, ...]], dict[str, np.ndarray]]:
    """counts: [part, mask, class]. The orders, and each of COUNTS as [part, order, step]."""
    n = counts.shape[1].bit_length() - 1
    orders, steps = removal_steps(n)
    filter_at = np.array(orders)  # [order, step]: the filter
    every = counts.sum(axis=2)
    here = steps[:, :, None] == np.arange(1, n + 1)  # [mask, order, step]
    later = steps[:, :, None] > np.arange(1, n + 1)
    failing = (np.arange(1 << n)[:, None, None] >> filter_at[None]) & 1
    over = lambda weight, where: np.einsum("pm,mos->pos", weight, where.astype(np.int64))
    removed = over(every, here)
    credit = np.stack([np.where(filter_at == f, removed, 0).sum(axis=(1, 2)) for f in range(n)], axis=1)  # [part, filter]
    good, toxic = (counts[:, :, [c for c in range(counts.shape[2]) if c >> bit & 1]].sum(axis=2) for bit in (0, 1))
    out = {
        "kept": over(every, later),
        "removed": removed,
        "redundant": over(every, failing * ~(here | later)),
        "unique_fails": every[:, 1 << filter_at],
        "good_lost": over(good, here),
        "toxic_lost": over(toxic, here),
        "shapley": credit[:, filter_at],
    }
    return orders, out


def masks(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column], id_col: str, text: Column, part: Column) -> DataFrame:
    """part, mask, class, n: rows of each part, failure mask and class of labels. The last bit is for repeats.

    A row fails as a repeat if a smaller id has the same text. Rows of a text are counted before they meet: each text
    has a row per part and class, with its least id and how often that id occurs, so a text that many documents share
    is no hot group.
    """
    mask = sum((F.coalesce(c, F.lit(False)).cast("int") * (1 << i) for i, c in enumerate(conditions.values())), F.lit(0))
    rows = docs.select(T.col(id_col).cast("long").alias("_id"), part.alias("part"), mask.alias("mask"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("_text"))
    known = labels.where("_id is not null").groupBy("_id").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("_toxic"))
    kind = F.coalesce(F.col("_good"), F.lit(0)) + 2 * F.coalesce(F.col("_toxic"), F.lit(0))
    rows = rows.join(known, "_id", "left").withColumn("class", kind)
    keys = ["_text", "part", "mask", "class"]
    ids = rows.groupBy(*keys, "_id").agg(F.count(F.lit(1)).alias("_n"))
    own = ids.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.coalesce(F.sum(F.when(F.col("_id").isNull(), F.col("_n"))), F.lit(0)).alias("_none"), F.min(F.when(F.col("_id").isNotNull(), F.struct("_id", "_n"))).alias("_first"))
    least = F.min("_first._id").over(Window.partitionBy("_text"))  # a row per part and class
    spared = F.col("_none") + F.when(F.col("_first._id") == least, F.col("_first._n")).otherwise(0)
    own = own.withColumn("_spared", spared)
    repeat = F.lit(1 << len(conditions))
    both = F.explode(F.array(F.struct("mask", F.col("_spared").alias("n")), F.struct((F.col("mask") + repeat).alias("mask"), (F.col("_n") - F.col("_spared")).alias("n"))))
    return own.select("part", "class", both.alias("_b")).select("part", "class", "_b.*").groupBy("part", "mask", "class").agg(F.sum("n").alias("n"))


def interactions(docs: DataFrame, labels: DataFrame, conditions: Mapping[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", label_id: str = "doc_id", quality_col: str = "quality", toxic_col: str = "toxic") -> DataFrame:
    """Per part, order of the filters and step: part, filter_order, step, and long COUNTS of rows within the part.

    The filters are the conditions (filters() by default), by one letter each, and REPEAT. kept: after this step;
    removed: at it; redundant: fail its filter but went before; unique_fails: fail its filter alone; good_lost,
    toxic_lost: of those removed, with that label; shapley: what its filter removes, summed over all orders.

    Null and empty texts are one text, of no words; a null part and the empty one are one. Rows without an id are
    repeats of nothing and nothing repeats them; rows that share the least id of a text all stay. A document has a
    label if any of its rows in labels has it; null labels are none. An empty table gives an empty result. Other
    columns, whatever their names, don't matter.
    """
    text = F.coalesce(T.col(text_col), F.lit(""))
    conditions = filters(text) if conditions is None else conditions
    letters = [*conditions, REPEAT]
    rated = labels.select(T.col(label_id).cast("long").alias("_id"), T.col(quality_col).alias("quality"), T.col(toxic_col).alias("toxic"))
    cells = masks(docs, rated, conditions, id_col, text, F.coalesce(T.col(part_col).cast("string"), F.lit("")))
    parts = cells.groupBy("part").agg(F.collect_list(F.struct((F.col("mask") * CLASSES + F.col("class")).alias("at"), "n")).alias("cells"))  # at most 4 times 2**filters

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, PARTS):
                part, cell = batch.column("part").slice(k, PARTS), batch.column("cells").slice(k, PARTS)
                counts = np.zeros((len(part), (1 << len(letters)) * CLASSES), np.int64)
                for i, found in enumerate(cell.to_pylist()):
                    for x in found:
                        counts[i, x["at"]] = x["n"]
                orders, out = scattered(counts.reshape(len(part), 1 << len(letters), CLASSES))
                size = len(orders) * len(letters)
                names = np.repeat(["".join(letters[f] for f in o) for o in orders], len(letters))
                columns = [part.take(pa.array(np.repeat(np.arange(len(part)), size))), pa.array(np.tile(names, len(part))), pa.array(np.tile(np.arange(1, len(letters) + 1, dtype=np.int32), len(part) * len(orders)))]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(out[c].ravel()) for c in COUNTS)], names=["part", "filter_order", "step", *COUNTS])

    return parts.mapInArrow(run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))
