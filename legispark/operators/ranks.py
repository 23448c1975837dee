"""Places in an order of any size, and what hangs on them: running sums, ranks with ties, exact percentiles.

Rows are dealt in range partitions and sorted there; a partition's sum, or that of a group's piece in it, moves on the
places after it. A window spans a piece, or a group's pieces (a row per range partition), never a group's rows or values.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legispark.sources.kept import kept


def _offsets(rows: DataFrame, size: Column) -> Column:
    """rows: _part. The sum of size over all parts before, as an expression of _part; a number per range partition passes the driver."""
    sums, before, total = dict(rows.groupBy("_part").agg(size).collect()), {}, 0
    for part in sorted(sums):
        before[part], total = total, total + sums[part]
    pairs = [F.lit(x) for item in before.items() for x in item]
    return F.element_at(F.create_map(*pairs), F.col("_part")) if pairs else F.lit(0).cast("long")


def _sorted(t: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """t in range partitions, each sorted: _part, and _place (from 1) within it. A written table, so that both hold from now on."""
    rows = t.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    rows = rows.withColumns({"_part": F.shiftright("_at", 33).cast("int"), "_place": F.col("_at").bitwiseAND((1 << 33) - 1) + 1})
    return kept(rows.drop("_at"), "ranks")


def numbered(t: DataFrame, order: Sequence[Column | str], name: str = "number") -> DataFrame:
    """Adds name: 1, 2, ... along a total order.

    Rows that tie in all of the order get numbers in any order. An empty table gives an empty one; nulls stand where
    the order puts them.
    """
    rows = _sorted(t, order)
    return rows.withColumn(name, _offsets(rows, F.count(F.lit(1))) + F.col("_place")).drop("_part", "_place")


def joined(t: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """t with right's other columns; null keys meet null keys. Without keys right is one row, or none."""
    if not keys:
        return t.join(F.broadcast(right), F.lit(True), how)  # one row
    right = right.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return t.join(right, same, how).drop(*[f"_k{i}" for i in range(len(keys))])


def running(t: DataFrame, by: Sequence[str], order: Sequence[Column | str], size: str, name: str = "before") -> DataFrame:
    """Adds name: the sum of size over the rows before, in a total order within each group; 0 at its first.

    A null group is a group, nulls in size count 0. An empty table gives an empty one.
    """
    rows = _sorted(t, [*by, *order])
    so_far = Window.partitionBy("_part", *by).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)  # a piece
    pieces = rows.groupBy(*by, "_part").agg(F.sum(size).alias("_piece"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range partition
    pieces = pieces.withColumn("_offset", F.coalesce(F.sum("_piece").over(earlier), F.lit(0))).drop("_piece")
    rows = rows.withColumn("_within", F.coalesce(F.sum(size).over(so_far), F.lit(0)))
    return joined(rows, pieces, [*by, "_part"]).withColumn(name, F.col("_offset") + F.col("_within")).drop("_part", "_place", "_offset", "_within")


def value_places(t: DataFrame, by: Sequence[str], value: str, ascending: bool = True) -> DataFrame:
    """by, value, n_equal, n_before: how many of the group's rows have each value, and how many have one before it; null values are left out."""
    counts = t.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n_equal"))
    return running(counts, by, [F.col(value).asc() if ascending else F.col(value).desc()], "n_equal", "n_before")


def distribution(t: DataFrame, by: Sequence[str], value: str, probs: Sequence[float] = ()) -> DataFrame:
    """by, n, mean, sd (of a sample), least, greatest, percentiles (exact and interpolated, an array of doubles).

    A row per group that has a value. The input is read once, for its values' counts; a percentile is found by its place
    among them, so no task holds a group's values.
    """
    places = value_places(t, by, value)
    v, many = F.col(value).cast("double"), F.col("n_equal")
    sizes = places.groupBy(*by).agg(F.sum(many).alias("_n"), (F.sum(v * many) / F.sum(many)).alias("_mean"))
    rows = joined(places, sizes, by, "inner")
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    holds = lambda place: (F.col("n_before") <= place) & (place < F.col("n_before") + many)
    ends = [F.max(F.when(holds(end(a)), v)).alias(f"_{side}{i}") for i, a in enumerate(at) for side, end in (("low", F.floor), ("high", F.ceil))]
    spread = F.sqrt(F.try_divide(F.sum(many * (v - F.col("_mean")) ** 2), F.max("_n") - 1)).alias("sd")
    found = rows.groupBy(*by).agg(F.max("_n").alias("_n"), F.max("_mean").alias("mean"), spread, F.min(value).alias("least"), F.max(value).alias("greatest"), *ends)
    low, high = ([F.col(f"_{side}{i}") for i in range(len(probs))] for side in ("low", "high"))
    parts = [lo + (a - F.floor(a)) * (hi - lo) for a, lo, hi in zip(at, low, high, strict=True)]  # between equal values it is exactly these
    return found.select(*by, F.coalesce("_n", F.lit(0)).alias("n"), "mean", "sd", "least", "greatest", F.array(*parts).alias("percentiles"))


def percentiles(t: DataFrame, by: Sequence[str], value: str, probs: Sequence[float]) -> DataFrame:
    """by, percentiles: see distribution."""
    return distribution(t, by, value, probs).select(*by, "percentiles")
