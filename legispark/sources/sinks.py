"""Writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from legispark.operators.tables import keep_first
from legispark.sources.scan import PARTITIONS


#: Columns by which single rows are looked up, the first also in order; distinct values that a file's filter is sized for.
LOOKUPS = {"bills": ["bill_no", "bill_id"], "bill_texts": ["bill_id"], "roll_calls": ["bill_id"], "members": ["mona_cd"]}
BLOOM_VALUES = 1_000_000
#: Rows that a task sorts and writes: as many as fit its memory with all columns, however well they compress.
FILE_ROWS = 250_000


def _flat(df: DataFrame) -> DataFrame:
    """Lists as comma-joined text, for formats without lists."""
    return df.select(*[F.array_join(F.col(f"`{f.name}`"), ",").alias(f.name) if f.dataType.typeName() == "array" else F.col(f"`{f.name}`") for f in df.schema])


def write_table(df: DataFrame, root: str, table: str, mode: str = "overwrite", whole: bool = False) -> None:
    """A table of the data set as Parquet, partitioned by its term where it has one; a term's rows go to few files.

    overwrite replaces the terms that df has and leaves all others alone; whole replaces the table. Files are sorted by
    the columns that LOOKUPS names, and have Bloom filters of them, so a search for one value skips what lacks it. With
    such columns the rows are counted first and dealt in ranges of about FILE_ROWS, so tasks grow in number, not in size.
    """
    keys, part = [c for c in LOOKUPS.get(table, []) if c in df.columns], PARTITIONS.get(table)
    if part and keys:
        df = df.repartitionByRange(max(1, -(-df.count() // FILE_ROWS)), part, *keys)
    elif part:
        df = df.hint("rebalance", part)
    if part or keys:
        df = df.sortWithinPartitions(*([part] if part else []), *keys)
    writer = df.write.mode(mode).option("partitionOverwriteMode", "static" if whole else "dynamic")
    for c in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", str(BLOOM_VALUES))
    if part:
        writer = writer.partitionBy(part)
    writer.parquet(f"{root}/{table}")


def bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None, mode: str = "overwrite", ordered: bool = True) -> DataFrame:
    """df as a saved table, a file per bucket of its keys and, if ordered, sorted by them; without a path in the warehouse.

    Tables of as many buckets join, and aggregate, on these keys without a shuffle. It takes part in SQL under its name.
    """
    spark = df.sparkSession
    writer = df.repartition(buckets, *keys).write.mode(mode).bucketBy(buckets, *keys)
    writer = writer.sortBy(*keys) if ordered else writer
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def dropped(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def register(tables: Mapping[str, DataFrame]) -> None:
    """Makes tables queryable by SQL under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def sql(spark: SparkSession, query: str) -> DataFrame:
    return spark.sql(query)


def export(df: DataFrame, path: str) -> None:
    """By the path's ending: .parquet, .tsv, else CSV with a header."""
    if path.endswith(".parquet"):
        df.write.mode("overwrite").parquet(path)
    else:
        _flat(df).write.mode("overwrite").option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").csv(path)


def _described(name: str, n: Column, columns: Sequence[str]) -> list[Column]:
    return [F.lit(name).alias("endpoint"), n.cast("long").alias("n_rows"), F.lit(len(columns)).alias("n_columns"), F.array(*map(F.lit, columns)).alias("columns")]


def ingest_metadata(tables: Mapping[str, DataFrame]) -> DataFrame:
    """endpoint, n_rows, n_columns, columns of each table; write it with `charts`. For tables that are written anyway, see write_observed."""
    rows = [t.agg(F.count(F.lit(1)).alias("n_rows")).select(*_described(name, F.col("n_rows"), t.columns)) for name, t in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def write_observed(tables: Mapping[str, DataFrame], root: str) -> DataFrame:
    """Writes tables as Parquet; their ingest_metadata, counted while they were written: each is read once."""
    spark, out = next(iter(tables.values())).sparkSession, None
    for name, t in tables.items():
        seen = Observation()
        t.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{root}/{name}")
        row = spark.range(1).select(*_described(name, F.lit(seen.get["n"]), t.columns))
        out = row if out is None else out.unionByName(row)
    return out


def write_deduplicated(t: DataFrame, keys: Sequence[str], order: Sequence[Column | str], path: str) -> DataFrame:
    """Writes the first row of each key; n_before, n_after, n_removed, counted while it was written: t is read once."""
    before, after = Observation(), Observation()
    first = keep_first(t.observe(before, F.count(F.lit(1)).alias("n")), keys, order)
    first.observe(after, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    a, b = before.get["n"], after.get["n"]
    return t.sparkSession.range(1).select(F.lit(a).cast("long").alias("n_before"), F.lit(b).cast("long").alias("n_after"), F.lit(a - b).cast("long").alias("n_removed"))


def score_files(scores: DataFrame, root: str, term: str, terms: Sequence[int]) -> None:
    """Scores as CSV, a folder per term and one for all."""
    for k in terms:
        _flat(scores.where(F.col(term) == k)).write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(f"{root}/ideal_points_{k}")
    _flat(scores).write.mode("overwrite").option("header", True).option("nullValue", "NA").csv(f"{root}/ideal_points_all")


def charts(results: Mapping[str, DataFrame], root: str) -> None:
    """Small result tables as JSON lines, a folder each."""
    for name, df in results.items():
        df.coalesce(1).write.mode("overwrite").json(f"{root}/{name}")
