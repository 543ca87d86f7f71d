"""The operators against brute force, on a table with every edge case."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from peerscore.llm import (
    components,
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    ngram_join,
    quality_classifier,
    quality_rules,
    sentencepiece,
    span_dedup,
    warc,
)
from peerscore.llm.arrays import LOWER, hash_spans
from peerscore.llm.queries import PIECES
from tests.llm import brute

SCHEMA = "doc_id long, text string, source string, n long, size int, score string, line string, ids string"


def rows():
    """Prose, near and exact copies, shared passages and lines, nulls, empties, a long text."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdeéß", k=rng.randint(1, 6))) for _ in range(300)]

    def prose(n):
        words = rng.choices(vocabulary, k=n)
        return " ".join(w + rng.choice(["", "", "", ".", ".\n", "!"]) for w in words)

    texts = [prose(rng.choice([1, 4, 5, 30, 80, 200])) for _ in range(60)]
    base = prose(120)
    for _ in range(25):
        words = base.split(" ")
        for _ in range(2):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        texts.append(" ".join(words))
    passage = prose(60)
    texts += [f"{prose(20)}. {passage}. {prose(15)}" for _ in range(12)]
    texts += [f" Same LINE\t\n{prose(8)}\nsame line\n\n" for _ in range(11)]
    texts += [texts[0], texts[0].upper(), None, None, "", " \n\t ", "one", "a b c d", prose(9000)]
    texts += ["x y z w v " * 8, "日本 語　テ", "# * $ % & | < >"]
    found = [
        (None if k % 29 == 7 else 1000 - 3 * k, t, [None, "a", "b", "é"][k % 4 if k % 3 else 1])
        for k, t in enumerate(texts)
    ]
    return [*found, found[0], found[0]]  # repeated rows


@pytest.fixture(scope="module")
def table():
    return rows()


@pytest.fixture(scope="module")
def docs(spark, table):
    return spark.createDataFrame([(*r, 1, 2, "s", "l", "i") for r in table], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def same(found, expected):
    key = repr
    assert sorted(map(tuple, found), key=key) == sorted(map(tuple, expected), key=key)


def test_rules(docs, table):
    found = quality_rules.apply_policy(quality_rules.ledger(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"
    )
    same(found.collect(), [(i, *brute.rules(t)) for i, t, _ in table])


def test_ablations_count_bits(docs):
    ledger = quality_rules.ledger(docs)
    failed = [r["failed"] for r in ledger.collect()]
    mask = quality_rules.mask(quality_rules.POLICIES["v1"])
    for r in quality_rules.ablations(ledger).collect():
        bit = quality_rules.mask((r["rule"],))
        assert r["n_failed"] == sum(bool(x & bit) for x in failed)
        assert r["n_only"] == sum(x & mask == bit for x in failed)


def test_near_duplicates(docs, table, monkeypatch):
    expected = brute.components([r[:2] for r in table])
    columns = ("doc_id", "n_shingles", "component_id")
    same(ngram_join.near_duplicates(docs).select(*columns).collect(), expected)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)  # every group is dealt to several tasks
    same(ngram_join.near_duplicates(docs).select(*columns).collect(), expected)


def test_one_of_each_group_stays(docs, table):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = [c if n and c is not None else object() for _, n, c in brute.components([r[:2] for r in table])]
    assert kept.count() == len(set(groups))


def test_frequent_lines(docs, table):
    found = line_dedup.drop_frequent_lines(docs).select("doc_id", "n_lines", "n_dropped", "text")
    expected = brute.kept_lines([t for _, t, _ in table], 10)
    assert any(dropped for _, dropped, _ in expected)
    same(found.collect(), [(r[0], *e) for r, e in zip(table, expected, strict=True)])


def test_shards_and_hot_lines(docs, table, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_LINES", 40)
    monkeypatch.setattr(line_dedup, "SHARD_PROBES", 5)
    found = line_dedup.drop_frequent_lines(docs, min_docs=3).select("n_lines", "n_dropped", "text")
    same(found.collect(), brute.kept_lines([t for _, t, _ in table], 3))


def test_perfect_hash_is_minimal():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64))
    perfect = line_dedup.PerfectHash.load(line_dedup.PerfectHash.build(keys).dump())
    assert sorted(perfect.index(keys)) == list(range(len(keys)))


def test_mix(docs, table):
    found = mixing.mixed(docs).select("doc_id", "size", "source_size", "target", "copies").collect()
    expected = brute.mixed(table)
    same([(*r[:3], round(r[3], 6), r[1] * r[4]) for r in found],
         [(*r[:3], round(r[3], 6), r[1] * int(r[4])) for r in expected])
    copies = sum(r[4] if r[1] else 1 for r in expected)
    assert mixing.mix(docs).count() == copies


def test_mix_moves_no_text(docs):
    """What is shuffled to mix has hashes and sizes; documents stay where they are read."""
    from tests.helpers import plan

    text = plan(mixing.mix(docs))
    assert "SortMergeJoin" not in text and "Exchange hashpartitioning" not in text
    assert "Exchange rangepartitioning" not in text


def test_mix_of_rows_equal_but_for_their_source(spark):
    rows = [(1, "x y", s) for s in ("a", "b", None)]
    rows += [(k, "w " * (k % 5), ("a", "b", None)[k % 3]) for k in range(2, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    expected = {
        (r["doc_id"], r["source"]): r["copies"] if r["size"] else 1
        for r in mixing.mixed(docs).collect()
    }
    assert len({expected[1, s] for s in ("a", "b", None)}) > 1
    found = Counter((r["doc_id"], r["source"]) for r in mixing.mix(docs).collect())
    assert found == Counter(expected)


def test_spans(spark, table):
    known = sorted({r[:2] for r in table if r[0] is not None and r[1] is not None})
    docs = spark.createDataFrame(known, "doc_id long, text string").repartition(4)
    found = span_dedup.drop_repeated_spans(docs).collect()
    expected = brute.without_spans(known)
    assert any(n for _, n, _ in expected)
    same([(r["doc_id"], r["n_sentences"], r["n_removed"], r["text"]) for r in found],
         [(i, *e) for (i, _), e in zip(known, expected, strict=True)])


@pytest.mark.parametrize("blank", [" ", ""])
def test_spans_of_shifted_passages(spark, blank):
    """Text without sentence marks; without blanks, its words are single characters."""
    rng = random.Random(8)
    vocabulary = [chr(0x4E00 + k) for k in range(2000)] if not blank else [f"w{k}" for k in range(2000)]
    passage = rng.choices(vocabulary, k=50)
    before = [rng.choices(vocabulary, k=k) for k in range(20)]
    texts = [blank.join([*b, *passage, *rng.choices(vocabulary, k=30)]) for b in before]
    edited = [*passage[:25], "new", *passage[26:]] * 2  # an edit in one long sentence
    texts += [blank.join(edited), blank.join([*edited[:70], "newer", *edited[71:]])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in span_dedup.drop_repeated_spans(docs).collect()}
    assert found[0]["n_removed"] == 0 and found[0]["text"] == texts[0]
    for i in range(1, len(texts)):
        words = found[i]["text"].split(" ") if blank else found[i]["text"]
        whole = texts[i].split(" ") if blank else texts[i]
        assert len(whole) - len(words) >= 20, i
        assert 0 in found[i]["first_ids"]


def test_marks_of_scripts_without_blanks():
    data = "今日は晴れ。明日は雨！a b。c.d กำ".encode()
    _, _, _, begin, _ = next(span_dedup.spans(
        np.frombuffer(data, np.uint8), np.array([0, len(data)]), span_dedup.Params()
    ))
    bounds = [*begin.tolist(), len(data)]
    pieces = [data[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    assert pieces == ["今日は晴れ。", "明日は雨！", "a b。", "c.d กำ"]


def test_fingerprints_against_edits(docs, table):
    found = fingerprints.against_edits(docs).collect()
    assert len(found) == len(table)
    ids = [r[0] for r in table]
    once = {i: t or "" for i, t, _ in table if i is not None and ids.count(i) == 1}
    order = sorted({i for i in ids if i is not None})
    for r in found:
        i = r["doc_id"]
        following = order[order.index(i) + 1] if i in once and i != order[-1] else None
        if i in once and following in once:
            text = fingerprints.edited_text(once[i], once[following])
            assert r["n_chars"] == len(once[i])
            assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    prints = {}
    for r in fingerprints.fingerprints(docs).collect():
        assert prints.setdefault(r["text"] or "", r["fingerprint"]) == r["fingerprint"]
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))


def test_fingerprints_equal_brute_force(docs, table):
    """Document frequencies, the band, every sub-lexicon's hash and the likeness, word by word."""
    params = fingerprints.Params(subsets=3, densities=(1, 3, 5), high=0.1)
    bits = fingerprints.band(docs, "text", params)
    texts = [t or "" for _, t, _ in table]

    def terms(text):
        lowered = text.encode().translate(bytes(LOWER.tolist()))
        return {w for w in re.split(rb"[\x20\x09-\x0D]+", lowered) if w}

    def hashed(word):
        data = np.frombuffer(word, dtype=np.uint8)
        return int(hash_spans(data, np.array([0]), np.array([len(data)]))[0])

    number = {w: hashed(w) for t in texts for w in terms(t)}
    cell = {w: h >> (64 - params.cell_bits) for w, h in number.items()}
    often = Counter(c for t in texts for c in [cell[w] for w in terms(t)])
    inside = {c for c, n in often.items() if n == 1 or n <= 0.1 * len(texts)}
    assert {c for c in often if bits[c >> 6] >> (c & 63) & 1} == inside
    found = fingerprints.prints(pa.array(texts), bits, params)
    again = []
    for text in texts:
        kept = np.array(sorted(number[w] for w in terms(text) if cell[w] in inside), dtype=np.uint64)
        sets = [kept[p] for p in fingerprints._subsets(kept, params.densities, params.subsets)]
        again.append([tuple(s.tolist()) for s in sets])
    for i in range(len(texts)):
        for j in range(len(texts)):
            same = [a == b for a, b in zip(again[i], again[j], strict=True)]
            assert [bool(x) for x in found[i][:-2] == found[j][:-2]] == same
            held = [bool(a or b) for a, b in zip(again[i], again[j], strict=True)]
            share = sum(s and h for s, h in zip(same, held, strict=True)) / max(sum(held), 1)
            expected = 1.0 if (found[i] == found[j]).all() else share
            assert fingerprints.likeness(found[i : i + 1], found[j : j + 1])[0] == pytest.approx(expected)


def test_fingerprints_of_short_texts(spark):
    bits = np.full((1 << 22) // 64, -1, dtype=np.int64)  # every term is in the band
    for n in (1, 2, 3, 5, 12):
        texts = [" ".join(f"t{n}x{i}x{k}" for k in range(n)) for i in range(300)]
        found = fingerprints.prints(pa.array(texts), bits, fingerprints.Params())
        assert len(set(fingerprints.hexed(found))) == len(texts)
        assert found.any(1).all()
        assert fingerprints.likeness(found[1:], found[:-1]).max() == 0
    docs = spark.createDataFrame([(i, f"a{i} b{i} c{i}") for i in range(200)], "doc_id long, text string")
    rows = fingerprints.against_edits(docs).collect()
    assert len({r["fingerprint"] for r in rows}) == 200
    assert all(r["near_next"] == 0 for r in rows)


def test_all_terms_are_hashed_where_no_sub_lexicon_holds_one():
    bits = np.full((1 << 22) // 64, -1, dtype=np.int64)
    sparse = fingerprints.Params(densities=(5, 7, 9, 11))
    texts = [f"u{i}" for i in range(300)]
    found = fingerprints.prints(pa.array(texts), bits, sparse)
    assert (found[:, :-2].any(1) != found[:, -2:].any(1)).all()
    assert len(set(fingerprints.hexed(found))) == len(texts)


@pytest.mark.parametrize("limit", [1, 1_000_000])
def test_language_keeps_every_row(spark, monkeypatch, limit):
    monkeypatch.setattr(language_id, "BATCH_WORDS", limit)
    texts = [("le chat noir et la souris", "fr"), ("the black cat and a mouse", "en")] * 30
    rows = [(i, *t) for i, t in enumerate(texts)] + [(90, None, "fr"), (91, "", None), (92, "1 2", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    model = language_id.learn(docs)
    found = {r["doc_id"]: r for r in language_id.identify(docs, model).collect()}
    assert len(found) == len(rows)
    assert all(found[i]["lang_pred"] == lang for i, _, lang in rows[:60])
    assert {found[i]["lang_pred"] for i in (90, 91, 92)} == {"und"}


def test_paths_equal_plain_viterbi():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 40, 30)
    begin = np.append(0, np.cumsum(counts))
    scores = np.repeat(rng.normal(0, 2, (int(begin[-1]) // 7 + 1, 3)), 7, axis=0)[: begin[-1]]
    labels = language_id._paths(scores, begin, 4.0)

    def value(path, s):
        return s[np.arange(len(path)), path].sum() - 4.0 * (np.diff(path) != 0).sum()

    for a, b in zip(begin[:-1], begin[1:], strict=True):
        best = np.zeros(3)
        for t in range(a, b):
            best = (scores[t] + np.maximum(best, best.max() - 4.0)) if t > a else scores[t].copy()
        if b > a:
            assert value(labels[a:b], scores[a:b]) == pytest.approx(best.max())


def test_pieces_equal_the_library(table):
    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=PIECES)
    extra = ["a\tb", "   ", "x" * 200 + " y", "🎉 Ⅷ", "<s> <0x0A>", "\n \n"]
    texts = [t or "" for _, t, _ in table] + extra
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    ids, before = sentencepiece.Encoder(vocabulary).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(before[:-1], before[1:], strict=True)] == library.encode(texts)
    assert [x.decode() for x in sentencepiece.decode(ids, before, vocabulary)] == texts


def test_pieces_round_trip(docs):
    vocabulary = sentencepiece.Vocabulary.load(PIECES)
    found = sentencepiece.with_text(sentencepiece.with_ids(docs, vocabulary), vocabulary)
    assert all(r["decoded"] == (r["text"] or "") for r in found.collect())


def test_unigram_takes_the_best_path():
    pieces = [" a", "b", "ab", " ab", "a", " ", "ba", "bab"]
    scores = np.array([-2.0, -1.5, -2.2, -3.4, -1.1, -0.5, -2.0, -4.0])
    vocabulary = sentencepiece.Vocabulary(
        [p.encode() for p in pieces], scores, np.ones(len(pieces), dtype=bool), None, 0, True
    )

    def best(text):
        value = [0.0] + [-np.inf] * len(text)
        for end in range(1, len(text) + 1):
            for i, p in enumerate(pieces):
                if text[:end].endswith(p):
                    value[end] = max(value[end], value[end - len(p)] + scores[i])
        return value[-1]

    encoder = sentencepiece.Encoder(vocabulary)
    for text in ("ab", "abab", "bab a", "aabbab ba"):
        ids, _ = encoder.encode(pa.array([text]))
        assert b"".join(vocabulary.pieces[i] for i in ids).decode() == " " + text
        assert scores[ids].sum() == pytest.approx(best(" " + text))


def test_classifier_tells_labels_apart(spark):
    rng = random.Random(2)
    good = [" ".join(rng.choices(["the", "of", "cat", "runs"], k=30)) for _ in range(80)]
    bad = [" ".join(w + "%%%" for w in t.split()) for t in good]
    rows = [(i, t, i % 2) for i, t in enumerate(x for p in zip(good, bad, strict=True) for x in p)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, None), (900, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - q) for i, _, q in rows] + [(None, 1), (3, None)], "doc_id long, quality int")
    model = quality_classifier.fit(docs, quality_classifier.sample_labels(labels))
    scores = {r["doc_id"]: r["score"] for r in quality_classifier.score(docs, model).collect()}
    assert all((scores[i] > 0.5) == (q == 0) for i, _, q in rows)
    assert scores[None] == scores[900]


def test_classifier_fits_on_one_row_of_a_repeated_id(spark):
    rows = [(i, f"the cat {i} runs" if i % 2 else f"%% {i} $$") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(3, 0)], "doc_id long, quality int")
    schema = "doc_id long, text string"
    sample = quality_classifier.sample_labels(labels)
    once, again = (
        spark.createDataFrame(r, schema).repartition(4) for r in (rows, rows + [rows[3]] * 2000)
    )
    expected, found = (quality_classifier.fit(d, sample) for d in (once, again))
    assert (expected[0] == found[0]).all() and expected[1] == found[1]
    mixed = spark.createDataFrame(rows + [(3, f"other {k}") for k in range(2000)], schema).repartition(4)
    texts = quality_classifier.sampled_texts(mixed, sample)
    assert texts.count() == sample.count()
    assert len({r["text"] for r in texts.filter("id = 3").collect()}) == 1


def test_header_names_have_no_case_and_values_no_blanks():
    head = b"WARC/1.1\r\nWARC-Type:response\r\ncontent-length:   12 \r\nWarc-Target-Uri: <a:b>\r\n  c\r\nEmpty:"
    found = warc._fields(head)
    assert found["WARC-Type"] == "response" and found["Content-Length"] == "12"
    assert found["warc-target-uri"] == "<a:b> c" and found.get("EMPTY") == ""
    assert "Warc-type" in found and found.get("other") is None
    for bad in (b"HTTP/1.1 200\r\n", b"WARC/1.1\r\nno colon"):
        with pytest.raises(ValueError):
            warc._fields(bad)


def test_foreign_archives_are_normalised(spark, tmp_path):
    """Archives of others, as one stream or as members, with other spellings of the header."""
    import gzip

    records = [
        f"WARC/1.0\r\nwarc-type:{kind}\r\nWARC-RECORD-ID: <urn:{i}>\r\ncontent-LENGTH:{len(body)}\r\n\r\n{body}\r\n\r\n".encode()
        for i, (kind, body) in enumerate([("warcinfo", "x" * 70_000), ("metadata", ""), ("request", "a\r\n\r\nb")])
    ]
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(b"".join(records)))
    (tmp_path / "many.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    names = spark.createDataFrame([("one.warc.gz",), ("many.warc.gz",)], "archive string")
    staged = warc.normalise(names, str(tmp_path))
    (tmp_path / "lost-members.cdxj").write_text('{"file": "lost-members.warc.gz", "offset": 0}\n')
    index = warc.read_index(staged, str(tmp_path))
    assert sorted(map(tuple, index.collect())) == sorted(map(tuple, staged.collect()))
    assert [r["record_id"] for r in index.orderBy("file", "offset").collect()] == [f"<urn:{i}>" for i in range(3)] * 2
    for r in index.collect():
        data = (tmp_path / r["file"]).read_bytes()[r["offset"] : r["offset"] + r["length"]]
        assert gzip.decompress(data) in records


def test_warc(spark):
    rows = [(5, "u\r\nx", "same"), (2, None, "same"), (9, "u", "é\r\n\r\nWARC/1.1"), (None, "u", "same"),
            (7, "u", None), (3, "u", ""), (1, "u", "p" * 3_000_000), (2, None, "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = warc.archived(pages, params=warc.Params(archive_bytes=1000)).collect()
    first = {"same": "2", "": "3"}
    expected = []
    for i, url, html in rows:
        payload = (html or "").encode()
        key = None if i is None else str(i)
        to = first.get(html or "")
        revisit = to is not None and to != key
        expected.append((key, url, "revisit" if revisit else "response", len(payload),
                         brute.base32_sha1(payload), to if revisit else None, None if revisit else payload))
    same([(*r[:6], None if r[6] is None else bytes(r[6])) for r in found], expected)


def test_components(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 440)]
    root = {x: x for link in links for x in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    found = components.components(spark.createDataFrame(links, "a long, b long"))
    assert dict(found.collect()) == {k: v for k, v in root.items() if any(root[a] == v and a != b for a, b in links)}


def test_empty_tables(empty):
    assert quality_rules.ledger(empty).count() == 0
    assert ngram_join.one_of_each(empty).count() == 0
    assert line_dedup.drop_frequent_lines(empty).count() == 0
    assert mixing.mix(empty).count() == 0
    assert span_dedup.drop_repeated_spans(empty).count() == 0
    assert fingerprints.against_edits(empty).count() == 0
    model = language_id.learn(empty.withColumnRenamed("source", "lang"))
    assert language_id.identify(empty, model).count() == 0
    assert warc.archived(empty.selectExpr("doc_id AS page_id", "text AS url", "text AS html")).count() == 0
    labels = empty.selectExpr("doc_id", "size AS quality")
    fitted = quality_classifier.fit(empty, quality_classifier.sample_labels(labels))
    assert quality_classifier.score(empty, fitted).count() == 0


def _shuffled_rows(df):
    """Rows written to each shuffle by the plan that has just run, without adaptive execution."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_copies_are_one_row_a_task_before_a_shuffle(spark):
    """Half of the rows are one text; no exchange of signatures holds it more than once a task."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = spark.range(0, 4000, 1, 4).selectExpr(
        "IF(id % 2 = 0, -1, id) AS node", "1L AS n", "binary('bits') AS bits"
    )
    found = ngram_join._signatures(rows, spark.range(-1, 100).toDF("node"))
    assert len(found.collect()) == 51
    assert max(_shuffled_rows(found)) <= 2000 + 4
    for k, v in kept.items():
        spark.conf.set(k, v)
