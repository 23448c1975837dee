"""Members' histories and the edges between sponsors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legispark.functions import scalar as S


def member_history(t: DataFrame, terms: str, attrs: Mapping[str, str], term: str | None = None, marks: tuple[str, str] = (",", "/")) -> DataFrame:
    """A row per member and term out of lists of terms and of attributes in the same order.

    attrs maps new columns to the lists. Attributes as long as the terms go by place, single ones hold for all, else the last known holds on. With `term`
    (a label), only that one; members without it are left out.
    """
    labels = S.split_list(terms, marks[0])
    rows = t.select("*", F.posexplode(labels).alias("_at", "term_label"))
    if term:
        rows = rows.where(F.col("term_label") == term)
    lists = {new: F.transform(F.split(F.coalesce(F.col(old), F.lit("")), marks[1]), lambda x: F.trim(x)) for new, old in attrs.items()}
    return rows.withColumns({new: S.pick(values, F.col("_at")) for new, values in lists.items()}).drop("_at")


def edges(t: DataFrame, src: str, dst_list: str, keep: Sequence[str] = (), mark: str = ",") -> DataFrame:
    """src, dst and the kept columns: an edge for each item of the list; null or empty ends, and loops, give none."""
    out = t.where(F.col(src).isNotNull()).select(F.col(src).alias("src"), F.explode(S.split_list(dst_list, mark)).alias("dst"), *keep)
    return out.where(F.col("src").cast("string") != F.col("dst"))


def edge_weights(e: DataFrame) -> DataFrame:
    return e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def degrees(e: DataFrame) -> DataFrame:
    """node, out_degree, in_degree: edges, counted each time; linear in the edges."""
    ends = e.select(F.explode(F.array(F.struct(F.col("src").cast("string").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("dst").cast("string").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"))


def meeting_summary(t: DataFrame, by: Sequence[str], speaker: str, party: str) -> DataFrame:
    """Per meeting: speeches with a speaker, distinct speakers, sorted parties."""
    return t.groupBy(*by).agg(F.count(speaker).alias("n_speeches"), F.countDistinct(speaker).alias("n_speakers"), F.array_join(F.array_sort(F.collect_set(party)), ", ").alias("parties"))
