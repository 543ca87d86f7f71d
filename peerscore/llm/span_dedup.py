"""Substring dedup by sliding sentence spans.

Texts are cut into sentences, every run of several consecutive sentences is hashed, and runs are
joined across the corpus. A sentence that is covered by a run found earlier is removed.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm import arrays
from peerscore.llm.frames import schema_with
from peerscore.session import scratch_root, stage

#: Bits of the filter that keeps spans which occur once from being shuffled a second time.
BITS = 1 << 25
#: Scripts written without blanks (first and last code point); each character is a word.
UNSPACED = np.array([
    (0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x9FFF), (0xF900, 0xFAFF),
    (0xFF00, 0xFF9F), (0x20000, 0x3FFFF),
])
#: Their sentence marks, and their marks that stay with the character before.
STOPS = np.array([ord(c) for c in "\u3002\uff01\uff1f\uff61\u104b\u17d4"])
JOINED = np.array([unicodedata.category(chr(c))[0] == "M" for c in range(0x3100)])


@dataclass(frozen=True)
class Params:
    """A span is the shortest run, from each sentence on, of at least ``sentences`` sentences with
    at least ``min_words`` words together. Sentences end at ``.``, ``!`` or ``?`` before a blank, at
    a newline, and at the marks of scripts without blanks, in which each character is a word.

    A sentence of over ``max_words`` words is also cut before every pair of words whose hash is the
    first smallest among ``window`` successive pairs of the sentence, unless just two of them have
    it, so that the same words are cut alike whatever precedes them; where that leaves more, after
    ``max_words`` words."""

    sentences: int = 2
    min_words: int = 12
    max_words: int = 16
    window: int = 10


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words as in arrays, but scripts without blanks are split by character; and which words end
    a sentence by a mark."""
    starts, ends, before = arrays.words(data, at)
    stop = np.isin(data[ends - 1], np.frombuffer(b".!?", dtype=np.uint8))
    place = np.flatnonzero(data >= 0xE0)
    if not len(place):
        return starts, ends, before, stop
    four = data[place] >= 0xF0
    byte = [data[np.minimum(place + k, len(data) - 1)].astype(np.int64) & 63 for k in range(4)]
    code = np.where(
        four, (byte[0] & 7) << 18 | byte[1] << 12 | byte[2] << 6 | byte[3],
        (byte[0] & 15) << 12 | byte[1] << 6 | byte[2],
    )
    at_range = np.searchsorted(UNSPACED[:, 0], code, "right") - 1
    unspaced = (at_range >= 0) & (code <= UNSPACED[at_range, 1])
    place, size, code = place[unspaced], 3 + four[unspaced], code[unspaced]
    joined = place[JOINED[np.minimum(code, len(JOINED) - 1)] & (code < len(JOINED))]
    cuts = np.setdiff1d(np.union1d(place, place + size), joined)
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[arrays.IS_WORD[data[cuts]] & arrays.IS_WORD[data[cuts - 1]]]
    starts, ends = np.union1d(starts, cuts), np.union1d(ends, cuts)
    stop = np.isin(data[ends - 1], np.frombuffer(b".!?", dtype=np.uint8))
    stop |= np.isin(ends, (place + size)[np.isin(code, STOPS)])
    return starts, ends, np.searchsorted(starts, at), stop


def _cuts(hashes: np.ndarray, heads: np.ndarray, long: np.ndarray, params: Params) -> np.ndarray:
    """The words before which content cuts these sentences, which begin at ``heads``."""
    windows = arrays.gather(heads, np.maximum(long - params.window, 0))
    if not len(windows):
        return windows
    pairs = np.lib.stride_tricks.sliding_window_view(arrays.grams(hashes, 2), params.window)[windows]
    least = pairs.argmin(1)
    times = (pairs == pairs[np.arange(len(pairs)), least][:, None]).sum(1)
    return (windows + least)[times != 2]


def spans(
    data: np.ndarray, at: np.ndarray, params: Params
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Per text: the span hashes, the first sentence of each and the one after its last, where
    sentences begin (in bytes of the text; the first at 0), and the text's length. A-Z are lower-cased, blanks don't matter."""
    starts, ends, before, stop = _words(data, at)
    hashes = arrays.hash_spans(arrays.LOWER[data], starts, ends)
    n = len(starts)
    first = np.zeros(n + 1, dtype=bool)  # whether a word begins a sentence
    if n:
        first[1:] = stop
        newlines = np.cumsum(np.append(0, data == 10))
        first[1:n] |= newlines[starts[1:]] > newlines[ends[:-1]]
    first[before] = True
    heads = np.flatnonzero(first[:n])
    long = np.diff(np.append(heads, n))
    over = long > params.max_words
    first[_cuts(hashes, heads[over], long[over], params)] = True
    heads = np.flatnonzero(first[:n])
    long = np.diff(np.append(heads, n))
    cut = arrays.gather(np.zeros(len(heads), dtype=np.int64), -(-long // params.max_words))
    heads = np.repeat(heads, -(-long // params.max_words)) + params.max_words * cut
    bounds = np.append(heads, n)
    of_text = np.searchsorted(heads, before)
    after = np.maximum(
        np.arange(len(heads)) + params.sentences, np.searchsorted(bounds, heads + params.min_words)
    )
    last = np.repeat(of_text[1:], np.diff(of_text))
    inside = np.minimum(after, last)
    runs = arrays.hash_runs(hashes, heads, bounds[inside])
    for i in range(len(at) - 1):
        lo, hi = int(of_text[i]), int(of_text[i + 1])
        firsts = lo + np.flatnonzero(after[lo:hi] <= hi)
        begin = starts[heads[lo:hi]] - at[i]
        begin[:1] = 0
        yield runs[firsts], firsts - lo, after[firsts] - lo, begin, int(at[i + 1] - at[i])


def _span_rows(docs: DataFrame, columns: list[str], text: str, params: Params, bits=None) -> DataFrame:
    """(columns, span, n): each row's distinct spans and how often it has them; with ``bits`` only
    those that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, at in arrays.chunks(batch.column(text)):
                rows, found, times = [], [], []
                for i, (hashes, *_) in enumerate(spans(data, at, params), row):
                    span, n = np.unique(hashes, return_counts=True)
                    span = span.view(np.int64)
                    if bits is not None:
                        place = span & (BITS - 1)
                        hit = (bits.value[place >> 6] >> (place & 63)) & 1 == 1
                        span, n = span[hit], n[hit]
                    rows.append(np.full(len(span), i))
                    found.append(span)
                    times.append(n)
                take = pa.array(np.concatenate(rows).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(take) for c in columns]
                    + [pa.array(np.concatenate(found)), pa.array(np.concatenate(times).astype(np.int64))],
                    [*columns, "span", "n"],
                )

    schema = schema_with(docs.select(*columns), span="long", n="long")
    return docs.select(*dict.fromkeys([*columns, text])).mapInArrow(run, schema)


def drop_repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", params: Params = Params()
) -> DataFrame:
    """All rows and columns, ``text`` without the sentences of repeated spans, with n_sentences,
    n_removed and first_ids (the ids of the rows that keep those sentences).

    A span's first occurrence is that in the row with the smallest id, there the earliest; every
    sentence that any other occurrence covers is removed, with the blanks after it.

    * Null or blank text: no sentences; null stays null.
    * Null ids come last. Rows that share the smallest id all keep their first occurrence.
    * An empty table stays empty. Columns of the new names in the input are replaced.
    """
    spark = docs.sparkSession
    scratch_root(spark)
    made = ["n_sentences", "n_removed", "first_ids"]
    clean = docs.drop(*made)
    row = F.xxhash64(id_col, text).alias("__row")
    keyed = clean.select(F.col(id_col), F.col(text), row)
    repeated = stage(
        _span_rows(keyed, [id_col], text, params)
        .groupBy("span").agg(F.sum("n").alias("times"), F.min(id_col).alias("first"))
        .filter("times > 1").drop("times"), "repeated_spans",
    )
    place = F.col("span").bitwiseAND(F.lit(BITS - 1))
    found = (
        repeated.select(F.shiftright(place, 6).alias("word"), place.bitwiseAND(F.lit(63)).alias("bit"))
        .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, cast(bit AS int))")).alias("bits"))
        .toPandas()  # BITS / 64 rows at most
    )
    held = np.zeros(BITS // 64, dtype=np.int64)
    held[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    bits = spark.sparkContext.broadcast(held)
    other = ~F.col(id_col).eqNullSafe(F.col("first"))
    hits = _span_rows(keyed, [id_col, "__row"], text, params, bits).join(repeated, "span")
    marks = (
        hits.filter(other | (F.col("n") > 1)).groupBy("__row")
        .agg(
            F.collect_set(F.when(other, F.col("span"))).alias("__all"),
            F.collect_set(F.when(~other, F.col("span"))).alias("__later"),
            F.array_sort(F.collect_set(F.when(other, F.col("first")))).alias("first_ids"),
        )
    )
    joined = clean.withColumn("__row", row).join(marks, "__row", "left").withColumn(
        "first_ids", F.coalesce("first_ids", F.array().cast(marks.schema["first_ids"].dataType))
    )
    columns = [c for c in clean.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, gone = [], [], []
            column = batch.column(text)
            for row, data, at in arrays.chunks(column):
                for i, (hashes, firsts, ends, begin, size) in enumerate(spans(data, at, params), row):
                    value = column[i].as_buffer().to_pybytes() if column[i].is_valid else None
                    lost = np.zeros(len(begin), dtype=bool)
                    if batch.column("__all")[i].is_valid:
                        hashes = hashes.view(np.int64)
                        every = np.array(batch.column("__all")[i].as_py(), dtype=np.int64)
                        later = np.array(batch.column("__later")[i].as_py(), dtype=np.int64)
                        _, earliest = np.unique(hashes, return_index=True)
                        again = np.ones(len(hashes), dtype=bool)
                        again[earliest] = False
                        hit = np.isin(hashes, every) | (again & np.isin(hashes, later))
                        lost[arrays.gather(firsts[hit], ends[hit] - firsts[hit])] = True
                        bounds = np.append(begin, size)
                        value = b"".join(
                            value[bounds[j] : bounds[j + 1]] for j in np.flatnonzero(~lost)
                        )
                    texts.append(value)
                    totals.append(len(begin))
                    gone.append(int(lost.sum()))
            kept = {text: pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_arrays(
                [kept.get(c, batch.column(c)) for c in columns]
                + [pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), batch.column("first_ids")],
                [*columns, *made],
            )

    ids = joined.schema["first_ids"].dataType.simpleString()
    schema = schema_with(clean, n_sentences="long", n_removed="long", first_ids=ids)
    return joined.select(*columns, "__all", "__later", "first_ids").mapInArrow(run, schema)
