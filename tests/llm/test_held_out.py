"""The trained operators on rows that they did not learn from, and the fingerprints of edits."""

from pyspark.sql import functions as F

from peerscore.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def share(rows, condition):
    return rows.agg(F.avg(F.expr(condition).cast("int"))).first()[0]


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = QUERIES["op3_quality_classifier"](spark, SF_DIR).filter("held_out").join(labels, "doc_id")
    rows = rows.cache()
    assert rows.count() > 50
    assert share(rows, "predicted = quality") > 0.95
    assert share(rows.filter("quality = 1"), "score >= 0.7") > 0.95  # clean documents stay


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").filter("lang IS NOT NULL")
    rows = QUERIES["op8_language_id"](spark, SF_DIR).filter("held_out AND lang_pred <> 'und'")
    rows = rows.join(docs.select("doc_id", "lang"), "doc_id").cache()
    assert rows.count() > 100
    assert share(rows, "lang_pred = lang") > 0.98


def test_a_text_is_more_like_its_edit_than_the_next_text(spark):
    rows = QUERIES["op6_document_fingerprints"](spark, SF_DIR)
    assert share(rows, "near_edited > near_next") > 0.9
