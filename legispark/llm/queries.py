"""The queries of these operators, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from legispark.llm import audit, ctw, decontam, extract, mixing, neardup, quality, quotes, repetition, resample, substring, tokens, toxicity
from legispark.llm.sql import ORACLES
from legispark.llm.storage import reachable
from legispark.llm.text import small_batches

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reachable(spark)
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out() -> Column:
    """Rows that no labels are learned from; those without an id are among them."""
    return F.coalesce(~quality.trainable(), F.lit(True))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = quality.scored(spark, docs, quality.fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    out = toxicity.scored(spark, docs, toxicity.fit(docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.rules(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("longest_repeat")


def op4_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extracted(table(spark, sf_dir, "pages"))


def op5_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def op6_ctw(spark: SparkSession, sf_dir: str) -> DataFrame:
    learn = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2
    docs = table(spark, sf_dir, "documents")
    small_batches(spark, 4000)  # runs and words are many small rows
    return ctw.scores(spark, docs, learn)


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.tokens(spark, table(spark, sf_dir, "documents"), tokenizer_path())


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), (F.col("_times") * F.col("_size")).alias("taken"))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(spark, table(spark, sf_dir, "documents"), k=4, percent=80)


def op10_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(spark, table(spark, sf_dir, "conversations"))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample.resampled(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op12_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.deduplicated(spark, table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_quality, op2_toxicity, op3_repetition, op4_extract, op5_decontam, op6_ctw, op7_tokens, op8_mix, op9_neardup, op10_quotes, op11_resample, op12_audit, op13_substring, pipeline)}
SQL = ORACLES
