"""The operators' roles played by the driver's tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query under its function's name, with the DuckDB SQL that gives the same rows."""

    def add(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, as the last digits of sums depend on their order."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f"`{f.name}`") for f in df.schema])


def bills(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "orders").select(
        F.col("o_orderkey").alias("bill_id"), F.year("o_orderdate").alias("term"), F.col("o_orderpriority").alias("bill_kind"), F.col("o_orderstatus").alias("status"),
        F.to_date("o_orderdate").alias("ppsl_dt"), F.col("o_custkey").alias("sponsor"), F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").isin("F", "P").cast("int").alias("passed"), (F.col("o_orderstatus") == "F").cast("int").alias("enacted"),
    )


BILLS = "bills AS (SELECT o_orderkey AS bill_id, year(o_orderdate)::INT AS term, o_orderpriority AS bill_kind, o_orderstatus AS status, o_orderdate::DATE AS ppsl_dt, o_custkey AS sponsor, o_totalprice AS price, (o_orderstatus IN ('F', 'P'))::INT AS passed, (o_orderstatus = 'F')::INT AS enacted FROM orders)"
LAW = "1-URGENT"


def stages(spark: SparkSession, d: str) -> DataFrame:
    """bill_id, s1 to s7: the least date of the order's lines with each number; null where there are none."""
    lines = read(spark, d, "lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("bill_id")).agg(*[F.to_date(F.min(F.when(F.col("l_linenumber") == k, F.col("l_shipdate")))).alias(f"s{k}") for k in range(1, 8)])


STAGES = "stages AS (SELECT l_orderkey AS bill_id, " + ", ".join(f"min(CASE WHEN l_linenumber = {k} THEN l_shipdate END)::DATE AS s{k}" for k in range(1, 8)) + " FROM lineitem GROUP BY l_orderkey)"


def lifecycle(spark: SparkSession, d: str) -> DataFrame:
    """Bills with their stages and days_to_proc, the days from proposal to stage 7."""
    return bills(spark, d).join(stages(spark, d), "bill_id", "left").withColumn("days_to_proc", F.datediff("s7", "ppsl_dt"))


LIFE = f"{BILLS}, {STAGES}, life AS (SELECT bills.*, s1, s2, s3, s4, s5, s6, s7, date_diff('day', ppsl_dt, s7) AS days_to_proc FROM bills LEFT JOIN stages USING (bill_id))"


def committee(spark: SparkSession, d: str) -> DataFrame:
    """sponsor, committee, party, bloc of each customer."""
    c, n, r = (read(spark, d, t) for t in ("customer", "nation", "region"))
    out = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return out.select(F.col("c_custkey").alias("sponsor"), F.col("c_mktsegment").alias("committee"), F.col("n_name").alias("party"), F.col("r_name").alias("bloc"), F.col("c_acctbal").alias("score"))


COMMITTEE = "committee AS (SELECT c_custkey AS sponsor, c_mktsegment AS committee, n_name AS party, r_name AS bloc, c_acctbal AS score FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


#: Rows in a part of tables that are dealt by hand: parts grow in number, not in size.
PART_ROWS = 250_000


def dealt(t: DataFrame, key: str) -> DataFrame:
    """t dealt once by a key, in more parts the more rows it has; groups of this key and others need no further shuffle."""
    n = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return t.repartition(max(n, -(-t.count() // PART_ROWS)), key)


def listed(marks: Iterable[str], mark: str, name: Column) -> list[Column]:
    """Aggregates, one column for each mark: the sorted names of rows that have it."""
    return [F.array_sort(F.collect_list(F.when(F.col(mark) == m, name))).alias(m) for m in marks]


def votes(spark: SparkSession, d: str) -> DataFrame:
    """item, member, vote (A, N, R), source, date, line, and yes: 1, 0 or null."""
    x = read(spark, d, "lineitem")
    yes = F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 0)
    return x.select(F.col("l_orderkey").alias("item"), F.col("l_suppkey").alias("member"), F.col("l_returnflag").alias("vote"), F.col("l_linestatus").alias("source"), F.to_date("l_shipdate").alias("date"), F.year("l_shipdate").alias("term"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("part"), F.col("l_extendedprice").alias("price"), yes.alias("yes"))


VOTES = "votes AS (SELECT l_orderkey AS item, l_suppkey AS member, l_returnflag AS vote, l_linestatus AS source, l_shipdate::DATE AS date, year(l_shipdate)::INT AS term, l_linenumber AS line, l_partkey AS part, l_extendedprice AS price, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 0 END AS yes FROM lineitem)"


def scores(spark: SparkSession, d: str) -> DataFrame:
    """member, term, aligned: a member's mean discount a year, per party and bloc of the supplier."""
    x, s, n, r = (read(spark, d, t) for t in ("lineitem", "supplier", "nation", "region"))
    per = x.groupBy(F.col("l_suppkey").alias("member"), F.year("l_shipdate").alias("term")).agg(F.round(F.avg(F.round(100 * F.col("l_discount"))), 4).alias("aligned"))
    who = s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey).select(F.col("s_suppkey").alias("member"), F.col("n_name").alias("party"), F.col("r_name").alias("bloc"))
    return per.join(who, "member")


SCORES = "scores AS (SELECT * FROM (SELECT l_suppkey AS member, year(l_shipdate)::INT AS term, round(avg(round(100 * l_discount)), 4) AS aligned FROM lineitem GROUP BY ALL) JOIN (SELECT s_suppkey AS member, n_name AS party, r_name AS bloc FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) USING (member))"
