"""Cross-tokenizer alignment: the tokens of two tokenizers over one text, in groups that end together.

Both token sequences cover the same bytes. Every token points to the token that overlaps it and
reaches farthest to the right: of the other side, the one that holds its last byte. Where both end
there, the token of the second side is terminal. Successors are doubled for all tokens of many
texts at once until nothing changes; each token then names the terminal token of its component,
and tokens with one terminal are a group.

Two tokens are linked where they end at the same byte. The shorter of them is then a suffix of the
longer one, so the pairs that can ever be linked follow from the two vocabularies alone: there are
a few hundred thousand. Counts of pairs over a corpus of any size are arrays of that length.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.llm.arrays import CHUNK_BYTES, segment_sum, utf8
from peerscore.llm.frames import schema_with
from peerscore.session import stage

# Fixed value: how byte-level BPE vocabularies of this family cut a text before they merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass(frozen=True)
class Tokenizer:
    """Ids of texts, and the bytes that each id stands for."""

    encode: Callable[[list[str]], list[list[int]]]
    tokens: list[bytes]

    @cached_property
    def sizes(self) -> np.ndarray:
        return np.array([len(x) for x in self.tokens], dtype=np.int64)

    def covers(self, ids: list[int], whole: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids)) == whole


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 bytes
    stand for themselves, the others are the letters from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@lru_cache(maxsize=4)
def byte_level(path: str) -> Tokenizer:
    """A byte-level BPE vocabulary in JSON, whose ids are in the order of its merges. Texts are
    encoded with a space before them, and strings of special tokens are plain text."""
    with open(path, encoding="utf8") as file:
        spec = json.load(file)
    special = {x["content"] for x in spec["added_tokens"] if x["special"]}
    letters = _byte_letters()
    ids = {
        bytes(letters[c] for c in word): i
        for word, i in spec["model"]["vocab"].items() if word not in special
    }
    tokens = [b""] * (max(ids.values()) + 1)
    for word, i in ids.items():
        tokens[i] = word
    bpe = tiktoken.Encoding("byte_level", pat_str=PATTERN, mergeable_ranks=ids, special_tokens={})
    return Tokenizer(lambda texts: [bpe.encode_ordinary(" " + t) for t in texts], tokens)


@lru_cache(maxsize=4)
def pieces(path: str) -> Tokenizer:
    """A SentencePiece model that puts a space before a text and falls back to bytes."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    tokens = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        raw = bytes([int(piece[1:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        tokens.append(raw)
    return Tokenizer(lambda texts: model.encode(texts, num_threads=1), tokens)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For the tokens of a, then those of b, the index in b of their component's terminal token.

    Ends are byte offsets, rising on each side; the last one is the same on both.
    """
    n, m = len(a_ends), len(b_ends)
    to_b = np.searchsorted(b_ends, a_ends)
    to_a = np.searchsorted(a_ends, b_ends)
    terminal = a_ends[to_a] == b_ends
    following = np.concatenate([n + to_b, np.where(terminal, n + np.arange(m), to_a)])
    while True:
        doubled = following[following]
        if np.array_equal(doubled, following):
            return following - n
        following = doubled


class PairTable:
    """All pairs (a, b) of ids whose bytes can end together, sorted; links are indexes into it."""

    def __init__(self, a: Tokenizer, b: Tokenizer):
        def by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
            found: dict[bytes, list[int]] = {}
            for i, token in enumerate(tokens):
                if token:
                    found.setdefault(token, []).append(i)
            return found

        a_of, b_of = by_bytes(a.tokens), by_bytes(b.tokens)
        keys = [
            i << 32 | j
            for i, token in enumerate(a.tokens) for k in range(len(token))
            for j in b_of.get(token[k:], ())
        ]
        keys += [
            i << 32 | j
            for j, token in enumerate(b.tokens) for k in range(1, len(token))
            for i in a_of.get(token[k:], ())
        ]
        self.keys = np.unique(np.array(keys, dtype=np.int64))

    def find(self, a_ids: np.ndarray, b_ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, a_ids << 32 | b_ids)


@lru_cache(maxsize=2)
def pair_table(a_path: str, b_path: str) -> PairTable:
    return PairTable(byte_level(a_path), pieces(b_path))


def _chunks(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most CHUNK_BYTES of text, or one text if it is longer."""
    for batch in batches:
        _, at = utf8(batch.column(text))
        row = 0
        while row < batch.num_rows:
            end = max(int(np.searchsorted(at, at[row] + CHUNK_BYTES, "right")) - 1, row + 1)
            yield batch.slice(row, end - row)
            row = end


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    before = np.append(0, np.cumsum([len(x) for x in lists], dtype=np.int64))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(before[-1])), before


def _lists(values: np.ndarray, before: np.ndarray) -> pa.Array:
    kind = pa.int32()
    return pa.ListArray.from_arrays(pa.array(before, kind), pa.array(values.astype(np.int32), kind))


def _align_texts(texts: list[str | None], a: Tokenizer, b: Tokenizer, pairs: PairTable) -> list[pa.Array]:
    real = [k for k, t in enumerate(texts) if t]
    given = [texts[k] for k in real]
    whole = [(" " + t).encode() for t in given]
    a_lists: list[list[int]] = [[]] * len(texts)
    b_lists = list(a_lists)
    for k, raw, a_ids, b_ids in zip(real, whole, a.encode(given), b.encode(given), strict=True):
        if a.covers(a_ids, raw) and b.covers(b_ids, raw):
            a_lists[k], b_lists[k] = a_ids, b_ids
    a_ids, a_before = _flat(a_lists)
    b_ids, b_before = _flat(b_lists)
    a_ends, b_ends = np.cumsum(a.sizes[a_ids]), np.cumsum(b.sizes[b_ids])

    last = terminals(a_ends, b_ends)
    a_last, b_last = last[: len(a_ids)], last[len(a_ids) :]
    # Groups are numbered by their terminal tokens, from 0 in each text.
    upto = np.append(0, np.cumsum(b_last == np.arange(len(b_ids))))
    a_group = upto[a_last] - np.repeat(upto[b_before[:-1]], np.diff(a_before))
    b_group = upto[b_last] - np.repeat(upto[b_before[:-1]], np.diff(b_before))

    to_b = np.searchsorted(b_ends, a_ends)
    linked = b_ends[to_b] == a_ends if len(a_ends) else np.zeros(0, dtype=bool)
    links = pairs.find(a_ids[linked], b_ids[to_b[linked]])
    links_before = np.append(0, np.cumsum(linked))[a_before]
    return [
        _lists(a_ids, a_before), _lists(b_ids, b_before), _lists(a_group, a_before),
        _lists(b_group, b_before), _lists(links, links_before),
    ]


ALIGNED = {name: "array<int>" for name in ("a_ids", "b_ids", "a_group", "b_group", "links")}


def _aligned(
    batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, text: str
) -> Iterator[pa.RecordBatch]:
    a, b, pairs = byte_level(a_path), pieces(b_path), pair_table(a_path, b_path)
    for batch in _chunks(batches, text):
        made = _align_texts(batch.column(text).to_pylist(), a, b, pairs)
        yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *ALIGNED])


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """All rows and columns with both tokenizations of a text, and how they align.

    ``a_ids`` (byte-level BPE of a space and the text) and ``b_ids`` (SentencePiece of the text)
    in order; ``a_group`` and ``b_group``, the number of each token's group from 0; ``links``, one
    per pair of tokens that end together, as indexes into ``pair_table``. Input columns of these
    names are replaced. Null and empty texts, and texts that either tokenizer does not give back
    byte by byte, have empty arrays. Rows stay as they are, repeated ones too; an empty table gives
    an empty one. Whole texts are tokenized, at most 1 MB of them or one text at a time.
    """
    clean = docs.drop(*ALIGNED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _aligned(batches, a_path, b_path, text)

    return clean.mapInArrow(run, schema_with(clean, **ALIGNED))


def _spelled(n: int, marks: str) -> list[str]:
    return [f"{i}{mark}" for mark in marks for i in range(n)]


def _with_groups(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[pa.RecordBatch]:
    def arrays_of(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
        lists = batch.column(column)
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        return lists.flatten().to_numpy(), np.append(0, np.cumsum(sizes, dtype=np.int64))

    spelled: list[str] = []
    n = 0
    for whole in batches:
        for row in range(0, whole.num_rows, 100):
            batch = whole.slice(row, 100)
            a, a_before = arrays_of(batch, "a_ids")
            b, b_before = arrays_of(batch, "b_ids")
            highest = int(max(a.max(initial=0), b.max(initial=0)))
            if highest >= n:
                n = highest + 1
                spelled = _spelled(n, ",|;")
            a_group, b_group = arrays_of(batch, "a_group")[0], arrays_of(batch, "b_group")[0]
            found = []
            for k in range(batch.num_rows):
                mine = slice(a_before[k], a_before[k + 1]), slice(b_before[k], b_before[k + 1])
                group = np.concatenate([2 * a_group[mine[0]], 2 * b_group[mine[1]] + 1])
                order = np.argsort(group, kind="stable")
                group = group[order]
                ids = np.concatenate([a[mine[0]], b[mine[1]]]).astype(np.int64)[order]
                last = np.append(group[1:] != group[:-1], True)[: len(group)]
                codes = ids + n * np.where(last, 1 + group % 2, 0)
                found.append("".join(map(spelled.__getitem__, codes.tolist()))[:-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, name]
            )


def with_group_text(aligned: DataFrame, name: str = "groups") -> DataFrame:
    """Aligned rows with their groups spelled out as ``a1,a2|b1;a3|b2,b3``: the ids of both sides
    in order. Rows without tokens have an empty string; a column of that name is replaced."""
    clean = aligned.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_groups(batches, name)

    return clean.mapInArrow(run, schema_with(clean, **{name: "string"}))


def align_with_groups(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", name: str = "groups"
) -> DataFrame:
    """The rows of ``with_group_text(align(...))``, made by one Python worker per task.

    Groups are spelled out from each chunk as it is aligned. Between two workers, texts and ids
    would travel in batches of 10,000 rows, which the executor and both workers hold whole.
    """
    clean = docs.drop(*ALIGNED, name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _with_groups(_aligned(batches, a_path, b_path, text), name)

    return clean.mapInArrow(run, schema_with(clean, **ALIGNED, **{name: "string"}))


def pair_counts(aligned: DataFrame, a_path: str, b_path: str) -> np.ndarray:
    """How many links of all rows hold each pair of ``pair_table``.

    Tasks add up their links in arrays of the table's length, and what comes back is at most one
    row per pair that the two vocabularies allow, whatever the size of the corpus.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(pair_table(a_path, b_path).keys), dtype=np.int64)
        for batch in batches:
            found = np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(counts))
            counts += found
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["pair", "n"])

    summed = (
        aligned.select("links").mapInArrow(run, "pair long, n long")
        .groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(len(pair_table(a_path, b_path).keys), dtype=np.int64)
    counts[summed.column("pair").to_numpy()] = summed.column("n").to_numpy()
    return counts


def best_pairs(counts: np.ndarray, pairs: PairTable) -> np.ndarray:
    """Whether a pair's count is the highest of all pairs with its b id; ties are all best."""
    b = pairs.keys & 0xFFFFFFFF
    highest = np.zeros(int(b.max(initial=0)) + 1, dtype=np.int64)
    np.maximum.at(highest, b, counts)
    return counts == highest[b]


def with_pair_scores(
    aligned: DataFrame, counts: np.ndarray, a_path: str, b_path: str
) -> DataFrame:
    """Aligned rows with ``n_best`` (links whose pair is best for its b id) and ``count_sum`` (the
    pairs' counts, added up over the links). Input columns of these names are replaced."""
    kinds = {"n_best": "long", "count_sum": "long"}
    clean = aligned.drop(*kinds)
    best = best_pairs(counts, pair_table(a_path, b_path))
    held = aligned.sparkSession.sparkContext.broadcast((counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = held.value
        for batch in batches:
            links = batch.column("links")
            flat = links.flatten().to_numpy()
            before = np.append(0, np.cumsum(links.value_lengths().fill_null(0).to_numpy()))
            upto = np.append(0, np.cumsum(counts[flat]))
            made = [
                pa.array(segment_sum(best[flat], before).astype(np.int64)),
                pa.array(upto[before[1:]] - upto[before[:-1]]),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *kinds])

    return clean.mapInArrow(run, schema_with(clean, **kinds))


def scored(
    docs: DataFrame, a_path: str, b_path: str, text: str = "text", keep: list[Column | str] = ()
) -> DataFrame:
    """Per row ``keep``, n_a, n_b, n_groups, n_links, groups, n_best, count_sum.

    Texts are tokenized once: the counts, the spelled groups' SHA-256 and the links are staged,
    then the pairs are counted over all rows and looked up again for each link.
    """
    groups = align_with_groups(docs, a_path, b_path, text)
    staged = stage(groups.select(
        *keep,
        F.size("a_ids").cast("long").alias("n_a"),
        F.size("b_ids").cast("long").alias("n_b"),
        F.coalesce(F.get("b_group", F.size("b_group") - 1) + 1, F.lit(0)).cast("long").alias("n_groups"),
        F.size("links").cast("long").alias("n_links"),
        F.when(F.col("groups") != "", F.sha2("groups", 256)).otherwise("").alias("groups_sha256"),
        "links",
    ), "aligned")
    counts = pair_counts(staged, a_path, b_path)
    return with_pair_scores(staged, counts, a_path, b_path)
