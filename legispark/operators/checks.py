"""Data-quality reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legispark.functions import scalar as S


def expected_counts(tables: Mapping[str, DataFrame], expected: Mapping[str, int], tol: float = 0.10) -> DataFrame:
    """table_name, n, expected, verdict: OK within the tolerance, else CHECK; MISSING without rows."""
    rows = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n", F.lit(expected[name]).cast("long").alias("expected")) for name, t in tables.items()]
    verdict = F.when(F.col("n") == 0, "MISSING").when(F.abs(F.col("n") - F.col("expected")) <= tol * F.col("expected"), "OK").otherwise("CHECK")
    return reduce(DataFrame.unionByName, rows).withColumn("verdict", verdict)


def key_profile(t: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: n, n_null (a part of the key is null), n_distinct, n_repeated (rows beyond each key's first)."""
    null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    per = t.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return per.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(null, F.col("_n"))), F.lit(0)).alias("n_null"), F.count_if(~null).alias("n_distinct"), F.coalesce(F.sum(F.when(~null, F.col("_n") - 1)), F.lit(0)).alias("n_repeated"))


def null_profile(t: DataFrame, cols: Sequence[str], over: float = 0.05) -> DataFrame:
    """column_name, n_null, null_share of the columns with a greater share of nulls; one pass."""
    counts = t.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(f"_{c}") for c in cols])
    stack = ", ".join(f"'{c}', `_{c}`" for c in cols)
    rows = counts.selectExpr("_n", f"stack({len(cols)}, {stack}) AS (column_name, n_null)")
    return rows.select("column_name", "n_null", S.share(F.col("n_null"), F.col("_n")).alias("null_share")).where(F.col("null_share") > over)


def agreement(t: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Per pair of columns: rows where both agree, differ, or only one is there; all pairs in one pass."""
    names = ["n_equal", "n_different", "n_left_only", "n_right_only"]
    counts = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a), F.col(b)
        tests = [x == y, x != y, x.isNotNull() & y.isNull(), x.isNull() & y.isNotNull()]
        counts += [F.count_if(test).alias(f"{n}{i}") for n, test in zip(names, tests, strict=True)]
    each = [F.struct(F.lit(f"{a}/{b}").alias("pair"), *[F.col(f"{n}{i}").alias(n) for n in names]) for i, (a, b) in enumerate(pairs)]
    return t.agg(*counts).select(F.explode(F.array(*each)).alias("_r")).select("_r.*")


def validate(tables: Mapping[str, DataFrame], expected: Mapping[str, int], key: str, many: Sequence[str] = (), tol: float = 0.10, over: float = 0.05) -> DataFrame:
    """table_name, check, column_name, n, share, verdict: each table's rows against what is expected, nulls and repeats of its key, columns with many nulls.

    Tables without an expected number are OK if they have rows. Repeats aren't counted in tables that have `many` rows
    for a key; a table without the key has no key checks. A table's figures come from one pass over it.
    """
    out = []
    for name, t in tables.items():
        aim = expected.get(name)
        found = next((c for c in t.columns if c.lower() == key.lower()), None)
        aggs = [F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_null{i}") for i, c in enumerate(t.columns)]]
        if found:
            aggs.append(F.countDistinct(F.col(f"`{found}`")).alias("_distinct"))
        row = t.agg(*aggs)
        near = F.abs(F.col("_n") - aim) < tol * aim if aim is not None else F.col("_n") > 0
        verdict = F.when(F.col("_n") == 0, "MISSING").when(near, "OK").otherwise("CHECK")
        entry = lambda check, column, n, verdict: F.struct(F.lit(check).alias("check"), F.lit(column).cast("string").alias("column_name"), n.cast("long").alias("n"), S.share(n, F.col("_n")).alias("share"), verdict.alias("verdict"))
        entries = [entry("rows", None, F.col("_n"), verdict)]
        if found:
            null = F.col(f"_null{t.columns.index(found)}")
            entries.append(F.when(null > 0, entry("key nulls", found, null, F.lit("CHECK"))))
            if name not in many:
                again = F.col("_n") - F.col("_distinct")
                entries.append(F.when(again > 0, entry("key repeats", found, again, F.lit("CHECK"))))
        entries += [F.when(F.col(f"_null{i}") > over * F.col("_n"), entry("nulls", c, F.col(f"_null{i}"), F.lit("CHECK"))) for i, c in enumerate(t.columns)]
        rows = row.select(F.lit(name).alias("table_name"), F.explode(F.array_compact(F.array(*entries))).alias("_e"))
        out.append(rows.select("table_name", "_e.*"))
    return reduce(DataFrame.unionByName, out)


def dedup_accounting(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows before and after, and how many went."""
    out = before.agg(F.count(F.lit(1)).alias("n_before")).crossJoin(after.agg(F.count(F.lit(1)).alias("n_after")))  # one row each
    return out.withColumn("n_removed", F.col("n_before") - F.col("n_after"))
