"""Reading the tables, raw feeds and score files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legispark.functions.vocabulary import SUCCESS_CODES, VOTE_FEED

_S = T.StringType()
_DATES = ["ppsl_dt", "committee_dt", "bdg_cmmt_dt", "cmt_present_dt", "jrcmit_prsnt_dt", "jrcmit_cmmt_dt", "cmt_proc_dt", "jrcmit_proc_dt", "law_submit_dt", "law_cmmt_dt", "law_present_dt", "law_prsnt_dt", "law_proc_dt", "rgs_prsnt_dt", "rgs_rsln_dt", "gvrn_trsf_dt", "prom_dt", "proc_dt"]


def _struct(**cols: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in cols.items()])


def _strings(names: str) -> dict[str, T.DataType]:
    return {n: _S for n in names.split()}


#: The tables' columns; scans give just these, null where a file lacks them.
SCHEMAS: dict[str, T.StructType] = {
    "bills": _struct(**_strings("bill_id bill_no"), age=T.IntegerType(), **_strings("bill_kind bill_nm ppsr_kind proposer_text rst_proposer rst_mona_cd"), publ_proposer=T.ArrayType(_S), publ_mona_cd=T.ArrayType(_S), **{d: T.DateType() for d in _DATES}, **_strings("jrcmit_proc_rslt cmt_proc_result_cd law_proc_rslt law_proc_result_cd rgs_conf_nm rgs_conf_rslt proc_rslt status"), passed=T.IntegerType(), enacted=T.IntegerType(), vote_result_cd=_S, vote_member_total=T.IntegerType(), vote_total=T.IntegerType(), vote_yes=T.IntegerType(), vote_no=T.IntegerType(), vote_abstain=T.IntegerType(), **_strings("prom_no prom_law_nm committee_nm committee_id jrcmit_nm link_url member_list"), days_to_proc=T.IntegerType(), days_to_committee=T.IntegerType()),
    "roll_calls": _struct(term=T.IntegerType(), meeting_id=_S, date=T.DateType(), **_strings("member_name vote source bill_id bill_context party district member_id"), vote_event=T.IntegerType(), agg_total=T.IntegerType(), agg_yes=T.IntegerType()),
    "members": _struct(**_strings("mona_cd member_name member_name_hanja member_name_eng sex birth_date reelection email homepage photo_url"), age=T.IntegerType(), **_strings("party district election_type committee")),
    "ideal_points": _struct(member_id=_S, term=T.IntegerType(), coord1D=T.DoubleType(), se1D=T.DoubleType(), member_name=_S, party=_S),
    "speeches": _struct(meeting_id=_S, term=T.IntegerType(), **_strings("session committee hearing_type"), date=T.DateType(), **_strings("speaker role naas_cd party"), speech_order=T.IntegerType(), speech_text=_S),
    "cosponsorship_edges": _struct(**_strings("bill_id member_name member_id party role")),
    "committee_meetings": _struct(**_strings("bill_id jrcmit_conf_nm"), jrcmit_conf_dt=T.DateType(), jrcmit_conf_rslt=_S, age=T.IntegerType()),
    "judiciary_meetings": _struct(**_strings("bill_id lwcmit_conf_nm"), lwcmit_conf_dt=T.DateType(), lwcmit_conf_rslt=_S, age=T.IntegerType()),
    "bill_texts": _struct(**_strings("bill_id propose_reason")),
    "assets": _struct(**_strings("mona_cd member_name"), year=T.IntegerType(), assembly=T.IntegerType(), net_worth=T.DoubleType(), total_realestate=T.DoubleType(), total_stocks=T.DoubleType()),
    "legislator_map": _struct(**_strings("mona_cd member_name")),
}
#: Tables that have more columns than those named here (wealth variables, flags of sources): the others are given as they are.
OPEN = {"assets", "legislator_map"}
#: The column that a table's files are partitioned by.
PARTITIONS = {"bills": "age", "roll_calls": "term", "members": "age", "committee_meetings": "age", "judiciary_meetings": "age", "assets": "assembly"}


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[table])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file systems have the path."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at))


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in lower case, cast to the schema's types; unknown ones go, missing ones are null."""
    have = {c.lower(): c for c in df.columns}
    names = {f.name: f.name.lower() for f in schema}
    return df.select(*[(F.col(f"`{have[names[f.name]]}`").cast(f.dataType) if names[f.name] in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema])


def scan(spark: SparkSession, root: str, table: str, terms: Sequence[int] | None = None, columns: Sequence[str] | None = None, foreign: bool = False) -> DataFrame:
    """A table of the data set, some terms or all (None), some columns or all; empty if the path isn't there.

    The term is a partition column, so other terms' files aren't read; columns are pruned down to the files. The schema
    is the declared one, so no file is opened to plan a scan; columns that a file lacks are null. Files of other types
    than declared are foreign: their own schemas are merged, from the footers of all files, and cast. Open tables are
    read like that too, as only the files know their columns.
    """
    path, schema = f"{root}/{table}", SCHEMAS[table]
    if not exists(spark, path):
        df = empty(spark, table)
    elif foreign or table in OPEN:
        found = spark.read.option("mergeSchema", "true").parquet(path)
        if table in OPEN:
            known = {n.lower() for n in schema.names}
            schema = T.StructType([*schema.fields, *(T.StructField(f.name.lower(), f.dataType) for f in found.schema if f.name.lower() not in known)])
        df = conformed(found, schema)
    else:
        df = spark.read.schema(schema).parquet(path).select(*schema.names)
    if terms is not None and table in PARTITIONS:
        df = df.where(F.col(PARTITIONS[table]).isin(*terms))
    known = [c for c in columns or [] if c in schema.names]
    return df.select(*known) if columns else df


def scores(spark: SparkSession, path: str) -> DataFrame:
    """Ideal points from CSV files; adds aligned, the score with its sign turned: negative is liberal."""
    df = spark.read.schema(SCHEMAS["ideal_points"]).option("header", True).option("nullValue", "NA").csv(path)
    return df.withColumn("aligned", -F.col("coord1D"))


def proposals(spark: SparkSession, path: str, fields: Mapping[str, str], term: str) -> DataFrame:
    """A JSON array of objects with the given fields (name: type); the term's column is cast to a number."""
    schema = ", ".join(f"`{k}` {v}" for k, v in fields.items())
    df = spark.read.schema(schema).json(path, multiLine=True)
    return df.withColumn(term, F.col(term).cast("string").try_cast("int"))


def flatten_envelope(t: DataFrame, body: str, endpoint: str, key: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """Landed response pages to rows: the key columns and the fields, all strings, of pages with a success code.

    A page is {endpoint: [{head: [{list_total_count}, {RESULT: {CODE}}]}, {row: [...]}]}; unreadable ones give no rows.
    """
    row = ", ".join(f"`{f}`: STRING" for f in fields)
    schema = f"STRUCT<`{endpoint}`: ARRAY<STRUCT<head: ARRAY<STRUCT<RESULT: STRUCT<CODE: STRING>>>, row: ARRAY<STRUCT<{row}>>>>>"
    page = F.from_json(F.col(body), schema)[endpoint]
    codes = F.flatten(F.transform(page, lambda part: F.transform(F.coalesce(part["head"], F.array()), lambda h: h["RESULT"]["CODE"])))
    rows = F.flatten(F.filter(F.transform(page, lambda part: part["row"]), lambda r: r.isNotNull()))
    good = t.select(*key, codes.alias("_codes"), rows.alias("_rows")).where(F.exists("_codes", lambda c: F.coalesce(c.isin(*SUCCESS_CODES), F.lit(False))))
    return good.select(*key, F.explode("_rows").alias("_row")).select(*key, "_row.*")


def vote_feed(t: DataFrame) -> DataFrame:
    """The feed's columns under our names, its source named."""
    return t.withColumnsRenamed({k: v for k, v in VOTE_FEED.items() if k in t.columns}).withColumn("source", F.lit("api"))
