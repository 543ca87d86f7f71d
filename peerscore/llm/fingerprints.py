"""I-Match fingerprints: terms of a band of inverse document frequencies, hashed per sub-lexicon.

Document frequencies are counted over all documents, in a fixed number of hashed cells. A text's
terms are its distinct words whose cell is in the band. Several random subsets of the lexicon, of
six densities, each give a hash of the terms that they hold; texts are alike by the share of equal
hashes. Every text has the same columns, whatever its number of terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from peerscore.llm import arrays
from peerscore.llm.frames import schema_with
from peerscore.session import stage

U64 = np.uint64


@dataclass(frozen=True)
class Params:
    """A cell is in the band if its document frequency is from ``low`` to ``high`` of all
    documents; of one document it is in it anyway. There are ``subsets`` sub-lexicons for each of
    ``densities``: with density d, a 2^d-th of all terms is in each. Sparse ones stay equal where a
    long text is edited, dense ones hold terms of short texts."""

    cell_bits: int = 22
    low: float = 1e-6
    high: float = 0.02
    subsets: int = 16
    densities: tuple[int, ...] = (1, 3, 5, 7, 9, 11)

    def columns(self) -> int:
        return self.subsets * len(self.densities)


def _cells(terms: np.ndarray, bits: int) -> np.ndarray:
    return (terms >> U64(64 - bits)).view(np.int64)


def _terms(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct words of each text, lower-cased, hashed and sorted."""
    data = arrays.LOWER[data]
    starts, ends, before = arrays.words(data, at)
    hashes = arrays.hash_spans(data, starts, ends)
    for a, b in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
        found = np.sort(hashes[a:b])
        yield found[np.append(True, found[1:] != found[:-1])] if b > a else found


def band(docs: DataFrame, text: str = "text", params: Params = Params()) -> np.ndarray:
    """One bit per cell: whether its document frequency is in the band, over all documents."""
    size = 1 << params.cell_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(size, dtype=np.int32), 0
        for batch in batches:
            rows += batch.num_rows
            for _, data, at in arrays.chunks(batch.column(0)):
                np.add.at(seen, _cells(np.concatenate([*_terms(data, at)]), params.cell_bits), 1)
        cells = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cells, -1)), pa.array(np.append(seen[cells], rows).astype(np.int64))],
            ["cell", "n"],
        )

    counts = stage(
        docs.select(text).mapInArrow(run, "cell long, n long")
        .groupBy("cell").agg(F.sum("n").alias("n")), "frequencies",
    )
    rows = counts.filter("cell = -1").agg(F.max("n")).first()[0] or 0
    inside = counts.filter(
        (F.col("cell") >= 0) & (F.col("n") >= params.low * rows)
        & ((F.col("n") <= params.high * rows) | (F.col("n") == 1))
    )
    found = (
        inside.groupBy(F.shiftright("cell", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(cell & 63 AS int))")).alias("bits"))
        .toPandas()  # a 64th of the cells at most
    )
    bits = np.zeros(size // 64, dtype=np.int64)
    bits[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64)
    return bits


def prints(texts: pa.Array, bits: np.ndarray, params: Params) -> np.ndarray:
    """Per text, a 32-bit hash of each sub-lexicon's terms (0: it holds none of them),
    and two columns with a hash of all its terms if no sub-lexicon holds one, or of the whole text
    if no term is in the band (else 0)."""
    parts = [np.zeros((0, params.columns() + 2), dtype=np.uint32)]
    for _, data, at in arrays.chunks(texts):
        kept = []
        for terms in _terms(data, at):
            cells = _cells(terms, params.cell_bits)
            kept.append(terms[(bits[cells >> 6] >> (cells & 63)) & 1 == 1])
        sizes = np.array([len(x) for x in kept])
        before = np.append(0, np.cumsum(sizes))
        terms = np.concatenate(kept)
        found = np.zeros((len(kept), params.columns() + 2), dtype=np.uint32)
        for k, picked in enumerate(_subsets(terms, params.densities, params.subsets)):
            where = np.searchsorted(picked, before)
            # the terms are sorted, so equal sets are equal runs
            found[:, k] = _filled(
                arrays.hash_runs(terms[picked], where[:-1], where[1:]), np.diff(where)
            )
        whole = np.where(
            sizes > 0, arrays.hash_runs(terms, before[:-1], before[1:]),
            arrays.hash_spans(data, at[:-1], at[1:]),
        )
        none = ~found.any(1)
        found[none, -2] = (whole[none] >> U64(32)).astype(np.uint32)
        found[none, -1] = whole[none].astype(np.uint32)
        parts.append(found)
    return np.concatenate(parts)


def _subsets(terms: np.ndarray, densities: tuple[int, ...], subsets: int) -> Iterator[np.ndarray]:
    """The places of the terms that each sub-lexicon holds; one hash serves several of them."""
    turn = 0
    for bits in densities:
        for k in range(subsets):
            j = k % (60 // bits)
            if j == 0:
                turn += 1
                drawn = arrays.mix(terms ^ U64(turn * 0xA0761D6478BD642F & (2**64 - 1)))
            yield np.flatnonzero((drawn >> U64(j * bits)) & U64((1 << bits) - 1) == 0)


def _filled(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.where(sizes > 0, (hashes >> U64(32)).astype(np.uint32) | np.uint32(1), np.uint32(0))


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The share of equal hashes among the sub-lexicons that hold a term of either text.

    1 for equal fingerprints; 0 if a text's hash is of all its terms or of the whole text and the
    other's fingerprint isn't equal to it.
    """
    a_own, b_own = a[:, :-2], b[:, :-2]
    either = (a_own | b_own) > 0
    share = (either & (a_own == b_own)).sum(1) / np.maximum(either.sum(1), 1)
    return np.where((a == b).all(1), 1.0, share)


def packed(found: np.ndarray) -> list[bytes]:
    return [x.astype(">u4").tobytes() for x in found]


def hexed(found: np.ndarray) -> list[str]:
    return [x.hex() for x in packed(found)]


def fingerprints(docs: DataFrame, text: str = "text", params: Params = Params()) -> DataFrame:
    """All rows and columns with ``fingerprint``, which replaces an input column of that name.

    Equal texts have equal fingerprints; null is an empty text. An empty table stays empty.
    """
    clean = docs.drop("fingerprint")
    bits = docs.sparkSession.sparkContext.broadcast(band(clean, text, params))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(hexed(prints(batch.column(text), bits.value, params)), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, made], [*batch.schema.names, "fingerprint"]
            )

    return clean.mapInArrow(run, schema_with(clean, fingerprint="string"))


#: Fingerprints are kept as bytes until the last step; as text they are twice as long.
MADE = {
    "n_chars": "long", "edited_sha256": "string", "fingerprint": "binary",
    "edited_fingerprint": "binary", "near_edited": "double", "near_next": "double",
}


_MADE = [pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def edited_text(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: pa.Array, texts: list[str], following: list[str], bits, params) -> list[pa.Array]:
    """The new columns of these rows; the next of a row's text is often the text of the next row."""
    edited = [edited_text(a, b) for a, b in zip(texts, following, strict=True)]
    chained = texts[1:] == following[:-1]
    every = [*texts, following[-1]] if chained else [*texts, *following]
    found = prints(pa.array(every, pa.string()), bits, params)
    own, nexts = found[: len(texts)], found[1:] if chained else found[len(texts) :]
    other = prints(pa.array(edited, pa.string()), bits, params)
    return [
        ids, pa.array([len(x) for x in texts], pa.int64()),
        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in edited], pa.string()),
        pa.array(packed(own), pa.binary()), pa.array(packed(other), pa.binary()),
        pa.array(likeness(own, other)), pa.array(likeness(own, nexts)),
    ]


def against_edits(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", params: Params = Params()
) -> DataFrame:
    """Per row: its fingerprint, that of its text edited with the next row's, and their likeness.

    The later half of the text is replaced by the beginning of the next row's text, by ascending id
    (null first; of equal ids by a hash of the text); the row after the last is the first. Rows are
    sorted across partitions and streamed; only the first and last row of each partition are
    written aside and meet in a second step. A null text is empty; a single row follows itself.
    """
    bits = docs.sparkSession.sparkContext.broadcast(band(docs, text, params))
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text), F.lit("")).alias("text"))
    key = F.xxhash64("text")
    dealt = rows.repartitionByRange(id_col, key).sortWithinPartitions(id_col, key)
    aside_kinds = {"part": "long", "place": "string", "text": "string"}
    schema = schema_with(rows.select(id_col), **MADE)
    wide = schema_with(rows.select(id_col), **MADE, **aside_kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None  # the last row so far, whose next row isn't known yet

        def aside(row: pa.RecordBatch, place: str) -> pa.RecordBatch:
            made = [row.column(0), *(pa.nulls(1, t) for t in _MADE)]
            return pa.RecordBatch.from_arrays(
                [*made, pa.array([part], pa.int64()), pa.array([place]), row.column(1)], wide.names
            )

        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                piece = batch.slice(row, 256)
                if held is None:
                    yield aside(piece.slice(0, 1), "first")
                else:
                    piece = pa.Table.from_batches([held, piece]).combine_chunks().to_batches()[0]
                held = piece.slice(piece.num_rows - 1)
                if (n := piece.num_rows - 1) > 0:
                    texts = piece.column(1).to_pylist()
                    made = _compared(piece.column(0).slice(0, n), texts[:-1], texts[1:], bits.value, params)
                    yield pa.RecordBatch.from_arrays(
                        [*made, pa.nulls(n, pa.int64()), *(pa.nulls(n, pa.string()),) * 2], wide.names
                    )
        if held is not None:
            yield aside(held, "last")

    found = stage(dealt.mapInArrow(run, wide), "edits")
    parts = found.filter("place = 'first'").select("part", F.col("text").alias("following"))
    order = Window.orderBy("part")  # one row per partition, without its text
    turn = parts.select("part").withColumn("to", F.lead("part").over(order)).withColumn(
        "to", F.coalesce("to", F.min("part").over(Window.partitionBy()))
    )
    ends = (
        found.filter("place = 'last'").select(id_col, "text", "part").join(turn, "part")
        .join(parts.withColumnRenamed("part", "to"), "to").select(id_col, "text", "following")
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 64):
                piece = batch.slice(row, 64)
                texts, following = piece.column(1).to_pylist(), piece.column(2).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    _compared(piece.column(0), texts, following, bits.value, params), schema.names
                )

    every = found.filter("place IS NULL").select(*schema.names).unionByName(
        ends.mapInArrow(finish, schema)
    )
    text_of = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return every.withColumns(text_of)
