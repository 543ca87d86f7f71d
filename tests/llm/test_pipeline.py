"""The stages together, on the smallest tables."""

import corpus_pipeline
from peerscore.llm import sentencepiece
from peerscore.llm.queries import PIECES
from tests.llm import brute

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        held[name] = [r.asDict() for r in docs.collect()]
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == before.columns
    ids = {n: [r["doc_id"] for r in rows] for n, rows in held.items()}
    lines = brute.kept_lines([r["text"] for r in held["quality_classifier"]], 10)
    expected = dict(zip(ids["quality_classifier"], (x[2] for x in lines), strict=True))
    assert {r["doc_id"]: r["text"] for r in held["line_dedup"]} == expected
    assert all(r["n_chars"] == len(r["text"]) for r in held["line_dedup"])
    groups = brute.components([(r["doc_id"], r["text"]) for r in held["line_dedup"]])
    assert sorted(ids["ngram_jaccard_join"]) == sorted({c if n else i for i, n, c in groups})
    rows = [(r["doc_id"], r["text"], r["source"]) for r in held["ngram_jaccard_join"]]
    copies = [i for i, n, _, _, k in brute.mixed(rows) for _ in range(int(k) if n else 1)]
    assert sorted(ids["mixing"]) == sorted(copies)
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    text = {r["doc_id"]: r["text"] for r in held["mixing"]}
    for r in held["sentencepiece"]:
        joined = b"".join(vocabulary.pieces[i] for i in r["ids"])
        assert joined.decode() == (" " + text[r["doc_id"]] if text[r["doc_id"]] else "")
