"""The registered queries of this subpackage; each derives its columns from its operator's rows."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.llm import (
    decontamination,
    fingerprints,
    language_id,
    line_dedup,
    merkle,
    mixing,
    ngram_join,
    quality_classifier,
    quality_rules,
    sentencepiece,
    span_dedup,
    token_alignment,
    warc,
)
from peerscore.llm.frames import in_fold
from peerscore.session import stage

PIECES = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
BYTE_LEVEL = os.environ.get("BYTE_LEVEL_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.json")
#: A document's score from which it counts as good.
GOOD = 0.7


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's measurements and failed rules, and what the newest policy makes of them. Null
    and empty texts have zeros and fail; repeated rows each have a row."""
    ledger = quality_rules.ledger(_table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "failed",
    )


def quality_rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule drops under each policy, from a stored ledger: texts are read once, for it."""
    measured = quality_rules.ledger(_table(spark, sf_dir, "documents")).drop("text")
    ledger = stage(measured, "ledger")
    each = [
        quality_rules.ablations(ledger, version).withColumn("policy", F.lit(version))
        for version in quality_rules.POLICIES
    ]
    return reduce(DataFrame.unionByName, each)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and the smallest id that links reach. Null, empty and wordless texts
    have an empty set and are linked with nothing; repeated rows are copies."""
    found = ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score by a model of labelled rows outside of the held-out fold. Texts without
    words have the score of the bias alone."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    sample = quality_classifier.sample_labels(_table(spark, sf_dir, "labels"))
    model = quality_classifier.fit(docs, sample)
    return quality_classifier.score(docs, model).select(
        "doc_id", in_fold("doc_id", 4, 2).alias("held_out"), "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of every document. Null texts have size 0; a null source is one."""
    return mixing.mixed(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten or more documents have; a null text is one empty line."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_frequent_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", _sha256(F.col("text")).alias("kept_sha256")
    )


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and how like its own edit and the next document's it is."""
    return fingerprints.against_edits(_table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentences of repeated spans; null stays null."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.drop_repeated_spans(docs)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language by a model of rows outside of the held-out fold; `und` without letters."""
    docs = _table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 5, 0)
    model = language_id.learn(docs.filter(~held_out))
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score",
        F.size("spans").cast("long").alias("n_spans"),
    )


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, and whether they decode to its text; null and empty have none."""
    pieces = sentencepiece.Vocabulary.load(PIECES)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = sentencepiece.with_text(sentencepiece.with_ids(docs, pieces), pieces)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_pieces"),
        F.xxhash64("ids").alias("ids_hash"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"),
    )


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back; equal payloads are one response and revisits."""
    pages = _table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return warc.archived(pages).select(
        F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        F.col("type").alias("record_type"), F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words that lie in a window of a benchmark item, and those items."""
    found = decontamination.contamination(
        _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, folded from its leaf, or from a tampered one."""
    docs = _table(spark, sf_dir, "documents")
    before, after = ["doc_id", "source", "lang"], F.try_add("n_chars", F.lit(1))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    leaf = merkle.digest_of(*map(F.col, [*before, "n_chars", "text"]))
    changed = F.when(tampered, merkle.digest_of(*map(F.col, before), after, F.col("text")))
    manifest = merkle.build(
        docs.withColumn("changed", changed), leaf, F.col("lang"), F.col("doc_id"), ["doc_id", "changed"]
    )
    folded = merkle.folded(F.coalesce("changed", "leaf"), F.col("path"))
    return (
        manifest.proofs()
        .withColumn("folded_root", folded)
        .select(
            "doc_id", "leaf", "subroot", "root",
            F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"),
            "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
        )
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tokenizations of every text, cut where both have a token's end."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_alignment.scored(docs, BYTE_LEVEL, PIECES, keep=["doc_id"]).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links",
        "n_best", "count_sum", "groups_sha256",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_rules, op2_ngram_jaccard_join, op3_quality_classifier, op4_mixing,
        op5_line_dedup, op6_document_fingerprints, op7_substring_dedup, op8_language_id,
        op9_sentencepiece, op10_warc,
        op11_decontamination, op12_merkle_manifest, op13_token_alignment,
        quality_rule_ablations,
    )
}
