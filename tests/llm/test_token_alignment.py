"""Token alignment against the tokenizers' own library and a plain scan."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from peerscore.llm import token_alignment as ta
from peerscore.llm.queries import BYTE_LEVEL, PIECES
from tests.helpers import plan

SCHEMA = "doc_id long, text string, links string, groups string, n_best string"


def texts():
    rng = random.Random(2)
    words = ["the", "there", "Zürich", "日本語", "naïve", "x", "  ", "\n", "\t", "<|endoftext|>", "<s>", "😀",
             "don't", "12345", "ﬁ", " ", "eronthwh", "thou", "</s>", "<0x41>", "{}();"]
    made = [" ".join(rng.choices(words, k=rng.choice([1, 3, 20, 60]))) for _ in range(60)]
    return [*made, None, "", " ", "a▁b", "▁", "\x00\x01", "x" * 5000, made[0], made[0], "the " * 400]


def brute(rows):
    byte_level = Tokenizer.from_file(BYTE_LEVEL)
    byte_level.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a_tokens, b_tokens = ta.byte_level(BYTE_LEVEL).tokens, ta.pieces(PIECES).tokens
    found = []
    for text in rows:
        a = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_tokens[i] for i in a) != whole or b"".join(b_tokens[i] for i in b) != whole:
            found.append(([], [], [], []))
            continue
        groups, links, i, j, a_end, b_end = [[[], []]], [], 0, 0, 0, 0
        while i < len(a) or j < len(b):
            if a_end <= b_end and i < len(a):
                a_end += len(a_tokens[a[i]])
                groups[-1][0].append(a[i])
                i += 1
            else:
                b_end += len(b_tokens[b[j]])
                groups[-1][1].append(b[j])
                j += 1
            if a_end == b_end:
                links.append((groups[-1][0][-1], groups[-1][1][-1]))
                groups.append([[], []])
        found.append((a, b, groups[:-1], links))
    counts = Counter(x for _, _, _, links in found for x in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (len(a), len(b), len(groups), len(links),
         sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
         hashlib.sha256(";".join(
             ",".join(map(str, g[0])) + "|" + ",".join(map(str, g[1])) for g in groups
         ).encode()).hexdigest() if groups else "")
        for a, b, groups, links in found
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_scores_equal_brute_force(spark):
    rows = texts()
    ids = [None if k == 4 else 3 * k for k in range(len(rows))]
    df = spark.createDataFrame([(i, t, "own", "own", "own") for i, t in zip(ids, rows, strict=True)], SCHEMA)
    found = ta.scored(df.repartition(3), BYTE_LEVEL, PIECES, keep=["doc_id"]).select(*COLUMNS).collect()
    expected = [(i, *e) for i, e in zip(ids, brute(rows), strict=True)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert any(e[3] for e in expected) and any(len(t or "") > 2 and not e[1] for t, e in zip(rows, expected))


def test_aligned_rows_keep_their_columns(spark):
    df = spark.createDataFrame([(1, "the thou", "own", "own", "own"), (2, None, "o", "o", "o")], SCHEMA)
    found = ta.with_group_text(ta.align(df, BYTE_LEVEL, PIECES))
    assert found.columns == ["doc_id", "text", "n_best", *ta.ALIGNED, "groups"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows[1]["a_ids"]) == len(rows[1]["a_group"]) and rows[1]["a_group"][0] == 0
    assert rows[2]["a_ids"] == rows[2]["links"] == [] and rows[2]["groups"] == ""


def test_one_worker_aligns_and_spells(spark):
    rows = [(k, t, "own", "own", "own") for k, t in enumerate(texts())]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    two, one = ta.with_group_text(ta.align(df, BYTE_LEVEL, PIECES)), ta.align_with_groups(df, BYTE_LEVEL, PIECES)
    assert one.schema == two.schema
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert 2 * plan(one).count("MapInArrow run") == plan(two).count("MapInArrow run") > 0


def test_an_empty_table(spark):
    assert ta.scored(spark.createDataFrame([], SCHEMA), BYTE_LEVEL, PIECES, keep=["doc_id"]).count() == 0


def test_the_query_on_given_rows(spark):
    """The registered query, every row of the smallest table, against brute force."""
    from peerscore.llm.queries import QUERIES

    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_token_alignment"](spark, sf_dir).select(*COLUMNS).collect()
    expected = [(i, *e) for (i, _), e in zip(rows, brute([t for _, t in rows]), strict=True)]
    assert sorted(map(tuple, found)) == sorted(expected)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=60), st.randoms(use_true_random=False))
def test_terminals_are_common_ends(sizes, rng):
    ends = np.cumsum(sizes)
    other = np.array(sorted({*rng.sample(range(1, ends[-1] + 1), rng.randint(0, ends[-1])), int(ends[-1])}))
    label = ta.terminals(ends, other)
    common = sorted(set(ends.tolist()) & set(other.tolist()))
    for at, end in enumerate([*ends.tolist(), *other.tolist()]):
        assert other[label[at]] == min(c for c in common if c >= end)


@pytest.mark.parametrize("token", [0, 220, 50255])
def test_byte_level_tokens_are_the_library_s(token):
    library = Tokenizer.from_file(BYTE_LEVEL)
    assert ta.byte_level(BYTE_LEVEL).tokens[token].decode(errors="replace") == library.decode([token])
