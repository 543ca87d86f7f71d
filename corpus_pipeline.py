"""The corpus pipeline: five operators, each stage written as Parquet and read by the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.llm import line_dedup, mixing, ngram_join, quality_classifier, sentencepiece
from peerscore.llm.queries import GOOD, PIECES
from peerscore.session import scratch_path, scratch_scope

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold go."""
    sample = quality_classifier.sample_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    model = quality_classifier.fit(docs, sample)
    return quality_classifier.score(docs, model).filter(F.col("score") >= GOOD).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten or more documents have go; n_chars is counted anew."""
    kept = line_dedup.drop_frequent_lines(docs)
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return ngram_join.one_of_each(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The piece ids of every document."""
    pieces = sentencepiece.Vocabulary.load(PIECES)
    rows = sentencepiece.with_ids(docs.select("doc_id", "source", "text"), pieces)
    return rows.select("doc_id", "source", F.size("ids").cast("long").alias("n_pieces"), "ids")


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", drop_lines),
    ("ngram_jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

# SQL expresses neither the trained classifier nor the encoder.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each from what its predecessor wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch_scope(spark):  # what the operator staged goes; what it returns stays
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
