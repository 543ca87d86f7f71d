"""Suffix arrays and decontamination against brute force."""

import random
import re

import numpy as np
import pytest

from peerscore.llm import decontamination as dec

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, n_words string, items int, source string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words(text):
    return WORD.findall(lower(text))


def windows(items, n):
    found = {}
    for item_id, text in items:
        w = words(text)
        size = min(len(w), n)
        for i in range(len(w) - size + 1 if w else 0):
            found.setdefault(tuple(w[i : i + size]), set()).add(item_id)
    return found


def brute(docs, items, n):
    wins = windows(items, n)
    sizes = {len(w) for w in wins}
    rows = []
    for doc_id, text, *_ in docs:
        w = words(text)
        hit, ids = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in wins:
                    hit |= set(range(i, i + size))
                    ids |= wins[key]
        rows.append((doc_id, len(w), sorted(hit), sorted(str(x) for x in ids if x is not None)))
    return rows


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcé9", k=rng.randint(1, 3))) for _ in range(25)]

    def prose(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "  ", ", ", ".\n", "-"]) for _ in range(n))

    items = [(k, prose(rng.choice([1, 2, 4, 5, 9, 30]))) for k in range(12)]
    items += [(20, items[5][1]), (20, items[6][1].upper()), (None, prose(12)), (30, None), (31, ""), (32, " !? ")]
    texts = [prose(rng.choice([0, 1, 3, 8, 40, 120])) for _ in range(40)]
    texts += [f"{prose(5)} {text} {prose(3)}" for _, text in items if text]
    texts += [items[5][1][: len(items[5][1]) // 2], None, "", "...", prose(3000), "é" * 50, "a " * 300]
    docs = [(None if k % 17 == 3 else 500 - k, t, "x", k, "s") for k, t in enumerate(texts)]
    return [*docs, docs[45], docs[45]], items


def collected(df):
    found = []
    for r in df.collect():
        hit = [i for span in r["hits"] for i in range(span["from"], span["to"])]
        assert r["n_hit"] == len(hit)
        found.append((r["doc_id"], r["n_words"], hit, r["items"]))
    return sorted(found, key=repr)


@pytest.mark.parametrize("window", [1, 3, 10])
@pytest.mark.parametrize("options", [{}, {"shard_words": 37}, {"block_bytes": 150, "shard_words": 64}])
def test_hits_equal_brute_force(spark, tables, window, options):
    docs, items = tables
    found = dec.contamination(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"),
        window, **options,
    )
    assert [f.name for f in found.schema][:3] == ["doc_id", "text", "source"]
    assert collected(found) == sorted(brute(docs, items, window), key=repr)


def test_documents_without_a_window_stay(spark, tables):
    docs, items = tables
    df = spark.createDataFrame(docs, DOCS).drop("n_words", "items")
    kept = dec.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"), 5)
    expected = [d for d, (_, _, hit, _) in zip(docs, brute(docs, items, 5), strict=True) if not hit]
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == sorted(d[0] or -1 for d in expected)


@pytest.mark.parametrize("options", [{}, {"shard_words": 50, "block_bytes": 200}])
def test_longest_matches_equal_brute_force(spark, tables, options):
    docs, items = tables
    found = dec.longest_matches(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string"),
        4, **options,
    )
    corpus = [(d[0], words(d[1])) for d in docs]
    expected = set()
    for item_id, text in items:
        w = words(text)
        for at in range(len(w) - min(len(w), 4) + 1 if w and item_id is not None else 0):
            places = []
            for doc_id, of in corpus:
                for i in range(len(of)):
                    n = 0
                    while at + n < len(w) and i + n < len(of) and w[at + n] == of[i + n]:
                        n += 1
                    if n:
                        places.append((-n, doc_id is None, doc_id or 0, i, doc_id))
            if places:
                best = min(places)
                count = sum(p[0] == best[0] for p in places)
                expected.add((str(item_id), at, -best[0], count, best[4], best[3]))
    assert {tuple(r) for r in found.collect()} == expected


def test_empty_tables(spark, tables):
    docs, items = tables
    some = spark.createDataFrame(docs, DOCS)
    given = spark.createDataFrame(items, "item_id long, text string")
    none = dec.contamination(some, given.limit(0))
    assert {(r["n_hit"], tuple(r["items"])) for r in none.collect()} == {(0, ())}
    assert none.count() == len(docs)
    assert dec.contamination(some.limit(0), given).count() == 0
    assert dec.longest_matches(some, given.limit(0)).count() == 0
    assert dec.longest_matches(some.limit(0), given).count() == 0


def test_a_long_text_is_hashed_in_pieces():
    text = "".join(f"wé{i % 977} " for i in range(400_000)) + "x" * 3_000_000 + " end"
    import pyarrow as pa

    found, starts = dec.word_sequence(pa.array([text, "one two"]))
    assert starts.tolist() == [0, 400_003, 400_006]
    few, _ = dec.word_sequence(pa.array(["wé0 wé976 " + "x" * 3_000_000 + " END", "one two"]))
    assert found[0] == found[977] == few[0] and found[976] == few[1]
    assert found[400_000:].tolist() == few[2:].tolist()


def test_suffixes_are_sorted():
    rng = np.random.default_rng(4)
    for size in (1, 2, 50, 400):
        sequence = np.append(rng.integers(1, 4, size, dtype=np.uint64), dec.END)
        index = dec.SuffixArray(sequence, size + 1)
        listed = sequence.tolist()
        assert index.suffixes.tolist() == sorted(range(size + 1), key=lambda i: listed[i:])
