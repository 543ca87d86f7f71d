"""Benchmark decontamination with suffix arrays over the training documents.

Every task hashes the words of its documents and sorts the suffixes of at most ``SHARD_WORDS``
words at a time into a suffix array. Every suffix of every benchmark item is looked up there by
binary search, word by word: the interval of suffixes that share its first words narrows until it
is empty, which gives the longest verbatim match; the interval at the length of a window gives all
places where that window occurs. Documents are read once and never shuffled.

The benchmark is the side that travels: it is broadcast in blocks of at most ``BLOCK_BYTES`` of
text, or one item, and every block passes all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.arrays import CHUNK_BYTES, LOWER, gather, hash_spans, utf8
from peerscore.llm.frames import schema_with
from peerscore.session import stage

#: Consecutive words of an item that count as a copy of it.
WINDOW = 10
#: Words per suffix array, about; some 60 bytes of memory each.
SHARD_WORDS = 1 << 20
#: Text of documents that is hashed together, or one text if it is longer.
SHARD_BYTES = 4 << 20
#: Text of items that is broadcast together, or one item if it is longer.
BLOCK_BYTES = 8 << 20

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[0x30:0x3A] = IS_WORD[0x41:0x5B] = IS_WORD[0x61:0x7B] = IS_WORD[0x80:] = True
U64 = np.uint64
END = U64(0)


def _spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end: runs of ASCII letters, digits, and all that is not ASCII."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = IS_WORD[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _word_hashes(data: np.ndarray) -> np.ndarray:
    """The words of one text as 64-bit hashes, A-Z lower-cased; none of them is END.

    A long text is hashed in pieces that end between words.
    """
    found, at = [], 0
    while at < len(data):
        end = min(at + CHUNK_BYTES, len(data))
        while end < len(data) and IS_WORD[data[end]] and IS_WORD[data[end - 1]]:
            end += 1
        piece = data[at:end]
        starts, ends = _spans(piece)
        found.append(np.maximum(hash_spans(LOWER[piece], starts, ends), U64(1)))
        at = end
    return np.concatenate(found) if found else np.zeros(0, dtype=U64)


def word_sequence(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts, with END after each text, and where each text begins."""
    data, at = utf8(column)
    # A byte that is no word between the texts keeps their words apart.
    apart = np.insert(data, at[1:], 0x20)
    starts_of = at + np.arange(len(at))
    if len(data) <= 2 * CHUNK_BYTES:
        starts, ends = _spans(apart)
        words = np.maximum(hash_spans(LOWER[apart], starts, ends), U64(1))
        before = np.searchsorted(starts, starts_of)
    else:
        words = _word_hashes(apart)
        inside = np.concatenate([[False], IS_WORD[apart]])
        begun = np.append(0, np.cumsum(inside[1:] & ~inside[:-1]))
        before = begun[starts_of]
    return np.insert(words, before[1:], END), before + np.arange(len(before))


def _order(ranks: np.ndarray, order: np.ndarray, slots: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` words, by prefix doubling.

    ``ranks`` is each suffix's group by its first word, named by the group's first slot; ``slots``
    are the places of suffixes that share theirs. Only those are sorted again.
    """
    n, k = len(order), 1
    while k < depth and len(slots):
        suffix = order[slots]
        after = suffix + k
        second = np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
        key = ranks[suffix] << 32 | second
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[slots] = suffix
        first = np.append(True, key[1:] != key[:-1])
        ranks[suffix] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        slots = slots[~(first & np.append(first[1:], True))]
        k *= 2
    return order


class SuffixArray:
    """The suffixes of a word sequence, sorted by their first ``depth`` words."""

    def __init__(self, words: np.ndarray, depth: int):
        order = np.argsort(words)
        ordered = words[order]
        first = np.append(True, ordered[1:] != ordered[:-1])[: len(words)]
        self.vocabulary = ordered[first]
        #: Suffixes that begin with word i of the vocabulary have the places begin[i]:begin[i + 1].
        self.begin = np.append(np.flatnonzero(first), len(words))
        self.ids = np.empty(len(words), dtype=np.int64)
        self.ids[order] = np.cumsum(first) - 1
        slots = np.flatnonzero(~(first & np.append(first[1:], True)))
        self.suffixes = _order(self.begin[self.ids], order, slots, depth)

    def find(self, words: np.ndarray) -> np.ndarray:
        """The ids of words, -1 for those that do not occur."""
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == words, at, -1)

    def _edge(self, low: np.ndarray, high: np.ndarray, skip: int, word: np.ndarray) -> np.ndarray:
        """In each interval, the first suffix whose word after ``skip`` others is not below ``word``."""
        low, high, last = low.copy(), high.copy(), len(self.ids) - 1
        while (open_ := low < high).any():
            middle = (low + high) // 2
            place = self.suffixes[np.minimum(middle, last)] + skip
            below = self.ids[np.minimum(place, last)] < word
            low = np.where(open_ & below, middle + 1, low)
            high = np.where(open_ & ~below, middle, high)
        return low

    def search(
        self, text: np.ndarray, begin: np.ndarray, end: np.ndarray, window: np.ndarray
    ) -> tuple[np.ndarray, ...]:
        """For each of the texts text[begin:end]: how many of its first words occur here in a row,
        the interval of suffixes that share them, and the interval that shares ``window`` words.
        """
        text = self.find(text)
        count = len(begin)
        length = np.zeros(count, dtype=np.int64)
        low, high = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64)
        low_w, high_w = low.copy(), high.copy()
        alive, skip = np.flatnonzero(begin < end), 0
        here = np.zeros(count, dtype=np.int64), np.full(count, len(self.ids))
        while len(alive):
            word = text[begin[alive] + skip]
            if skip:
                a = self._edge(here[0][alive], here[1][alive], skip, word)
                b = self._edge(a, here[1][alive], skip, word + 1)
            else:
                a, b = self.begin[word], self.begin[word + 1]
            found = (word >= 0) & (a < b)
            alive, a, b = alive[found], a[found], b[found]
            skip += 1
            here[0][alive], here[1][alive] = a, b
            length[alive], low[alive], high[alive] = skip, a, b
            full = alive[window[alive] == skip]
            low_w[full], high_w[full] = here[0][full], here[1][full]
            alive = alive[begin[alive] + skip < end[alive]]
        return length, low, high, low_w, high_w


@dataclass(frozen=True)
class Block:
    """Words of distinct items, their suffixes that are at least a window long, and their ids."""

    words: np.ndarray
    begin: np.ndarray  # of a suffix
    end: np.ndarray
    window: np.ndarray
    item: np.ndarray
    at: np.ndarray  # place of the suffix in its item
    ids: list[list[str]]

    @classmethod
    def of(cls, texts: pa.Array, ids: list[list[str]], window: int) -> Block:
        words, starts = word_sequence(texts)
        sizes = np.diff(starts) - 1
        needed = np.minimum(sizes, window)
        count = np.where(sizes > 0, sizes - needed + 1, 0)
        item = np.repeat(np.arange(len(sizes)), count)
        begin = gather(starts[:-1], count)
        return cls(
            words, begin, (starts[:-1] + sizes)[item], needed[item], item, begin - starts[:-1][item], ids
        )

    @property
    def longest(self) -> int:
        return int((self.end - self.begin).max(initial=0))


def blocks(items: DataFrame, window: int, limit: int, id: str, text: str) -> Iterator[Block]:
    """The distinct texts of a table with the ids of each, in blocks of about ``limit`` bytes."""
    texts = stage(
        items.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("text"))
        .agg(F.array_sort(F.collect_set(F.col(id).cast("string"))).alias("ids")), "items"
    )
    size = F.octet_length("text") + F.coalesce(F.octet_length(F.array_join("ids", "")), F.lit(0)) + 8
    total = texts.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    count = total // limit + 1
    for k in range(count):
        part = texts.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == k).toArrow().combine_chunks()
        if part.num_rows:
            column = part.column("text").combine_chunks()
            yield Block.of(column, part.column("ids").to_pylist(), window)


def _shards(words: np.ndarray, overlap: int, size: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Runs of ``size`` words and ``overlap`` more: where each begins, its words with END after
    them, and how many of them belong to no later run."""
    for start in range(0, len(words), size):
        run = words[start : start + size + overlap]
        yield start, np.append(run, END), min(size, len(words) - start)


def _runs(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, at = utf8(batch.column(text))
        row = 0
        while row < batch.num_rows:
            end = max(int(np.searchsorted(at, at[row] + SHARD_BYTES, "right")) - 1, row + 1)
            yield batch.slice(row, end - row)
            row = end


def _merged(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _hits(
    words: np.ndarray, starts: np.ndarray, block: Block, shard_words: int
) -> tuple[np.ndarray, dict[int, list[str]]]:
    """Which words lie in an occurrence of a window, and the ids of the items by document."""
    delta = np.zeros(len(words) + 1, dtype=np.int32)
    pairs = [np.zeros((0, 2), dtype=np.int64)]  # (document, a suffix of the block)
    widest = int(block.window.max(initial=1))
    alike: dict[int, np.ndarray] = {}
    for start, run, _ in _shards(words, widest - 1, shard_words):
        index = SuffixArray(run, widest)
        _, _, _, low, high = index.search(block.words, block.begin, block.begin + block.window, block.window)
        found = np.flatnonzero(low < high)
        # Suffixes with the same window have the same interval; its places are read once.
        intervals = np.stack([low[found], high[found], block.window[found]], axis=1)
        distinct, which = np.unique(intervals, axis=0, return_inverse=True)
        if not len(distinct):
            continue
        which = which.ravel()
        by = np.argsort(which, kind="stable")
        edges = np.searchsorted(which[by], np.arange(len(distinct) + 1))
        names = found[by][edges[:-1]]
        for k, name in enumerate(names.tolist()):
            alike[name] = found[by][edges[k] : edges[k + 1]]
        sizes = distinct[:, 1] - distinct[:, 0]
        places = start + index.suffixes[gather(distinct[:, 0], sizes)]
        width = np.repeat(block.window[names], sizes)
        np.add.at(delta, places, 1)
        np.add.at(delta, places + width, -1)
        document = np.searchsorted(starts, places, "right") - 1
        pairs.append(np.unique(np.stack([document, np.repeat(names, sizes)], axis=1), axis=0))
    both = np.unique(np.concatenate(pairs), axis=0)
    edges = np.searchsorted(both[:, 0], np.arange(len(starts)))
    known: dict[bytes, list[str]] = {}
    items: dict[int, list[str]] = {}
    for k in np.unique(both[:, 0]).tolist():
        names = both[edges[k] : edges[k + 1], 1]
        if names.tobytes() not in known:
            hit = np.unique(np.concatenate([block.item[alike[n]] for n in names.tolist()]))
            known[names.tobytes()] = [x for i in hit.tolist() for x in block.ids[i]]
        items[k] = known[names.tobytes()]
    return np.cumsum(delta[:-1]) > 0, items


FOUND = {
    "n_words": "long", "n_hit": "long", "hits": "array<struct<from:int,to:int>>",
    "items": "array<string>",
}
_HITS = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))


def _pass(docs: DataFrame, block: Block | None, text: str, shard_words: int, again: bool) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(block)
    clean = docs if again else docs.drop(*FOUND)
    names = [c for c in clean.columns if c not in FOUND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = held.value
        for batch in _runs(batches, text):
            words, starts = word_sequence(batch.column(text))
            flags = np.zeros(len(words), dtype=bool)
            items: dict[int, list[str]] = {}
            if block is not None and len(block.begin):
                flags, items = _hits(words, starts, block, shard_words)
            if again:  # what earlier blocks have found
                for k, spans in enumerate(batch.column("hits").to_pylist()):
                    for span in spans:
                        flags[starts[k] + span["from"] : starts[k] + span["to"]] = True
                for k, ids in enumerate(batch.column("items").to_pylist()):
                    if ids:
                        items[k] = [*items.get(k, []), *ids]
            begin, end = _merged(flags)
            document = np.searchsorted(starts, begin, "right") - 1
            spans = pa.StructArray.from_arrays(
                [pa.array(x - starts[document], pa.int32()) for x in (begin, end)], fields=list(_HITS.value_type)
            )
            before = np.searchsorted(document, np.arange(batch.num_rows + 1))
            upto = np.append(0, np.cumsum(flags))
            made = [
                pa.array(np.diff(starts) - 1, pa.int64()),
                pa.array(upto[starts[1:]] - upto[starts[:-1]], pa.int64()),
                pa.ListArray.from_arrays(pa.array(before, pa.int32()), spans),
                pa.array([sorted(set(items.get(k, ()))) for k in range(batch.num_rows)], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *made], [*names, *FOUND])

    return clean.mapInArrow(run, schema_with(clean.select(*names), **FOUND))


def contamination(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """All rows and columns of documents, with what they share with a benchmark.

    ``n_words``; ``n_hit``, words inside an occurrence of a window; ``hits``, their spans as word
    places from 0; ``items``, the distinct ids as text of items with a window in the document,
    sorted. A window is ``window`` consecutive words of an item, or all of them if it has fewer.
    Input columns of these names are replaced. Null and empty texts have no words, on either side.
    Items of equal text keep their ids; an item without an id hits, but is not listed. Repeated
    documents each have the result. Without items or documents nothing is hit. Whole texts count:
    a text that is longer than a shard goes through several that overlap.
    """
    found, passed = docs, False
    for block in blocks(items, window, block_bytes, item_id, item_text):
        found = _pass(stage(found, "searched") if passed else found, block, text, shard_words, passed)
        passed = True
    return found if passed else _pass(docs, None, text, shard_words, False)


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """The documents without those that hold a window of an item; columns stay as they are."""
    marked = contamination(docs, items, window, **options)
    return marked.filter(F.col("n_hit") == 0).select(*(c for c in docs.columns if c not in FOUND))


def longest_matches(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
    block_bytes: int = BLOCK_BYTES, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """The longest verbatim match of every item suffix that is at least a window long.

    (item_id, item_at, length, n_found, doc_id, doc_at): the longest run of the item's words from
    ``item_at`` that any document holds, how often it occurs, and the place with the smallest
    document id; null ids come last. Suffixes of which no document has the first word have no row.
    Tasks send one row per suffix and shard, whatever the number of occurrences.
    """
    schema = "item long, item_at long, length long, n_found long, doc_id string, doc_at long"
    kind = docs.schema[id].dataType
    found = None
    for block in blocks(items, window, block_bytes, item_id, item_text):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            block = held.value
            for batch in _runs(batches, text):
                ids = batch.column(id).to_pylist()
                words, starts = word_sequence(batch.column(text))
                for start, shard, own in _shards(words, block.longest - 1, shard_words):
                    index = SuffixArray(shard, block.longest)
                    length, low, high, _, _ = index.search(
                        block.words, block.begin, block.end, block.window
                    )
                    rows = []
                    for q in np.flatnonzero(low < high).tolist():
                        places = index.suffixes[low[q] : high[q]]
                        places = np.sort(places[places < own]) + start
                        if not len(places):
                            continue
                        owners = np.searchsorted(starts, places, "right") - 1
                        first = min(
                            range(len(places)),
                            key=lambda i: (ids[owners[i]] is None, ids[owners[i]] or 0, places[i] - starts[owners[i]]),
                        )
                        name = ids[owners[first]]
                        rows.append((
                            int(block.item[q]), int(block.at[q]), int(length[q]), len(places),
                            None if name is None else str(name), int(places[first] - starts[owners[first]]),
                        ))
                    if rows:
                        columns = [list(x) for x in zip(*rows, strict=True)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(x, t) for x, t in zip(columns, types, strict=True)], names
                        )

        names = [x.split()[0] for x in schema.split(", ")]
        types = [pa.string() if x.endswith("string") else pa.int64() for x in schema.split(", ")]
        place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast(kind).alias("id"), "doc_at")
        merged = (
            docs.select(id, text).mapInArrow(run, schema)
            .groupBy("item", "item_at", "length").agg(F.sum("n_found").alias("n_found"), F.min(place).alias("place"))
            .groupBy("item", "item_at").agg(F.max(F.struct("length", "n_found", "place")).alias("best"))
        )
        listed = docs.sparkSession.createDataFrame(
            [(i, x) for i, of in enumerate(block.ids) for x in of], "item long, item_id string"
        )
        rows = merged.join(F.broadcast(listed), "item").select(
            "item_id", "item_at", "best.length", "best.n_found",
            F.col("best.place.id").alias("doc_id"), F.col("best.place.doc_at").alias("doc_at"),
        )
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        empty = "item_id string, item_at long, length long, n_found long"
        shape = docs.sparkSession.createDataFrame([], empty)
        return shape.withColumns({"doc_id": F.lit(None).cast(kind), "doc_at": F.lit(None).cast("long")})
    return found
