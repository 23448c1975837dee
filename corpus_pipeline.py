"""Documents to token files: quality, near-duplicates, decontamination, mixing, output.

Each stage but the last returns whole rows with all the columns it was given, whatever they are named, as they were. An
empty table gives an empty one in every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from legispark.llm import decontam, mixing, neardup, quality, tokens
from legispark.llm.queries import table, tokenizer_path
from legispark.llm.storage import written
from legispark.llm.text import col, unused


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the quality classifier rejects; it learns from the documents at hand and the labels.

    Null and empty texts are scored as such, repeated rows alike. Without labels of both kinds all share one score.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score, predicted = unused(docs.columns, "score"), unused(docs.columns, "predicted")
    found = quality.scored(spark, docs, model, drop_text=False, names=(score, predicted))
    return found.where(col(predicted) == 1).select(*map(col, docs.columns))


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: a row of its least doc_id.

    Rows without an id, and null or wordless texts, are in no group and stay; rows that repeat an id and text are one.
    """
    return neardup.without_copies(spark, docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark's passage, also of items without an id. Null and wordless texts stay, repeated rows alike."""
    return decontam.without_benchmark(spark, docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix of sources takes them. A null source is one; null and empty texts have the size 0."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Writes token files and returns what is read back from them; a null or empty text has the end id alone."""
    return tokens.tokens(spark, docs, tokenizer_path())


STAGES = [("quality", keep_quality), ("near_duplicates", keep_one_copy), ("decontamination", keep_clean), ("mixing", mix_sources), ("tokens", write_tokens)]

#: Classifier, sketches and tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
