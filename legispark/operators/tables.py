"""Filters, joins, unions and removal of repeated rows."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legispark.functions import scalar as S

#: How Spark names a sort order of a column.
ORDERED = re.compile(r"Column<'(.*) (ASC|DESC) NULLS (FIRST|LAST)'>", re.DOTALL)


def keyword_filter(t: DataFrame, col: str, pattern: str | None) -> DataFrame:
    return t if pattern is None else t.where(S.matches(col, pattern))


def recode(t: DataFrame, col: str, mapping: Mapping[str, str], default: str | None = None, to: str | None = None) -> DataFrame:
    return t.withColumn(to or col, S.recoded(col, mapping, default))


def derive_outcome(t: DataFrame, result: str, term: str, passed: Sequence[str], enacted: Sequence[str], pending: str, expired: str, expired_terms: Sequence[int] = ()) -> DataFrame:
    """Adds status (the result; where it is null: expired in past terms, else pending), passed and enacted (0 or 1)."""
    missing = F.when(F.col(term).isin(*expired_terms), expired).otherwise(pending) if expired_terms else F.lit(pending)
    status = F.coalesce(F.col(result), missing)
    return t.withColumns({"status": status, "passed": S.in_group(status, passed), "enacted": S.in_group(status, enacted)})


def _place(order: Sequence[Column | str], columns: Sequence[str]) -> tuple[Column, bool] | None:
    """A struct that compares as the order does, and whether the first row has the greatest one; None if directions are mixed."""
    parts = []
    for o in order:
        found = None if isinstance(o, str) else ORDERED.fullmatch(str(o))
        if found and found[1] not in columns:
            raise ValueError(f"{o}: sort orders are taken of plain columns")
        x = F.col(o) if isinstance(o, str) else F.col(found[1]) if found else o
        parts.append((x, bool(found) and found[2] == "DESC", found[3] == "LAST" if found else False))
    down = {d for _, d, _ in parts}
    if len(down) > 1:
        return None
    down = down.pop()
    fields = [f for x, _, last in parts for f in ([x.isNull(), x] if last != down else [x])]  # nulls are least by themselves
    return F.struct(*[f.alias(f"o{i}") for i, f in enumerate(fields)]), down


def keep_first(t: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in an order that must be total; null keys are keys.

    An aggregate that keeps one row of a key: repeats go before the shuffle, and no key's rows are gathered. Only an
    order that mixes directions needs a window.
    """
    place = _place(order, t.columns)
    if place is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return t.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
    row, best = F.struct(*[F.col(f"`{c}`") for c in t.columns]), F.max_by if place[1] else F.min_by
    first = t.groupBy(*keys).agg(best(row, place[0]).alias("_row"))
    return first.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in t.columns])  # the keys' own columns: they tell how rows are partitioned


def align_union(*tables: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """All rows; columns that a table lacks are null. With cols, just those."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    for c in cols or []:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out.select(*cols) if cols else out


def append_missing(base: DataFrame, extra: DataFrame, key: str) -> DataFrame:
    """base, and extra's rows whose key base lacks."""
    return align_union(base, extra.join(base.select(key), key, "left_anti"))


def left_enrich(t: DataFrame, right: DataFrame, key: str, cols: Mapping[str, str], on_clash: str = "left", order: Sequence[str] | None = None) -> DataFrame:
    """Left join of right's columns under new names; with order, only right's first row of each key.

    Where t has a column of the new name: "left" keeps it, "coalesce" fills its nulls, "right" replaces it.
    """
    right = keep_first(right, [key], order) if order else right
    right = right.select(key, *[F.col(a).alias(f"_new_{b}") for a, b in cols.items()])
    out = t.join(right, key, "left")
    for b in cols.values():
        new = F.col(f"_new_{b}")
        if b not in t.columns or on_clash == "right":
            out = out.withColumn(b, new)
        elif on_clash == "coalesce":
            out = out.withColumn(b, F.coalesce(F.col(b), new))
        out = out.drop(f"_new_{b}")
    return out


def fill_from(t: DataFrame, right: DataFrame, key: str, target: str, source: str, order: Sequence[Column | str]) -> DataFrame:
    """Fills target's nulls from right's source; of right's rows with a key the first in the order counts."""
    right = keep_first(right, [key], order).select(key, F.col(source).alias("_fill"))
    return t.join(right, key, "left").withColumn(target, F.coalesce(target, "_fill")).drop("_fill")


def flag_membership(sources: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Each key once, with in_<source>: whether that source has it."""
    tagged = [t.select(F.col(key)).where(F.col(key).isNotNull()).withColumn("_s", F.lit(name)) for name, t in sources.items()]
    flags = [F.max(F.col("_s") == name).alias(f"in_{name}") for name in sources]
    return reduce(DataFrame.unionByName, tagged).groupBy(key).agg(*flags)


def remaining(t: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return t.join(done.select(key), key, "left_anti")


def coverage(t: DataFrame, other: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """Per group: rows, rows whose key other has, and their share."""
    hit = other.select(key).distinct().withColumn("_hit", F.lit(1))
    out = t.join(hit, key, "left").groupBy(*by).agg(F.count(F.lit(1)).alias("total"), F.count("_hit").alias("covered"))
    return out.withColumn("share", S.share(F.col("covered"), F.col("total")))


def new_ids(sources: Sequence[tuple[str, DataFrame]], key: str) -> DataFrame:
    """Per source, in the order given: its distinct ids, and how many of them no earlier source has."""
    tagged = [t.select(F.col(key).alias("_id")).where(F.col(key).isNotNull()).distinct().withColumns({"_rank": F.lit(i), "source": F.lit(s)}) for i, (s, t) in enumerate(sources)]
    every = reduce(DataFrame.unionByName, tagged)
    first = every.groupBy("_id").agg(F.min("_rank").alias("_first"))
    met = every.join(first, "_id")
    return met.groupBy("source").agg(F.count(F.lit(1)).alias("n_ids"), F.count_if(F.col("_rank") == F.col("_first")).alias("n_new"))


def first_name(sources: Sequence[tuple[str, DataFrame]], code: str, name: str) -> DataFrame:
    """Each code once, with the name that the earliest source has for it (the least of several)."""
    tagged = [t.select(F.col(code), F.col(name)).where(F.col(code).isNotNull()).withColumn("_rank", F.lit(i)) for i, (_, t) in enumerate(sources)]
    return reduce(DataFrame.unionByName, tagged).groupBy(code).agg(F.min(F.when(F.col(name).isNotNull(), F.struct("_rank", name)))[name].alias(name))


def date_overlap(a: DataFrame, b: DataFrame, by: str, date: str) -> DataFrame:
    """Per group: distinct dates of either table, and those of both."""
    x = a.select(by, date).dropna().distinct().withColumn("_a", F.lit(1))
    y = b.select(by, date).dropna().distinct().withColumn("_b", F.lit(1))
    both = x.join(y, [by, date], "full")
    return both.groupBy(by).agg(F.count("_a").alias("n_left"), F.count("_b").alias("n_right"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull()).alias("n_both"))


def topk(t: DataFrame, k: int, order: Sequence[Column | str]) -> DataFrame:
    """The first k rows of a total order."""
    return t.orderBy(*order).limit(k)


def search(t: DataFrame, text: Mapping[str, str | None], equal: Mapping[str, object], status: tuple[str, Sequence[str]] | None = None, dates: tuple[str, str | None, str | None] | None = None, limit: int = 20, order: Sequence[Column | str] = ()) -> tuple[DataFrame, DataFrame]:
    """The first rows that fit all conditions, and a one-row table with how many fit."""
    for c, pattern in text.items():
        t = keyword_filter(t, c, pattern)
    for c, value in equal.items():
        t = t if value is None else t.where(F.col(c) == value)
    if status:
        t = t.where(F.col(status[0]).isin(*status[1]))
    if dates:
        c, start, end = dates
        t = t.where(F.col(c) >= F.lit(start).cast("date")) if start else t
        t = t.where(F.col(c) <= F.lit(end).cast("date")) if end else t
    return topk(t, limit, order), t.agg(F.count(F.lit(1)).alias("total"))
