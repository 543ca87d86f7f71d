"""Quality classifier: hashed word n-gram logistic regression, trained with FTRL-proximal updates.

Features are the 1- and 2-grams of the words, lower-cased, and of their shapes (runs of letters,
digits and capitals collapsed), hashed into a fixed number of weights. A score is a sparse dot
product of the weights with the shares of a text's features.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm import arrays
from peerscore.llm.frames import in_fold, schema_with

U64 = np.uint64


@dataclass(frozen=True)
class Params:
    """``sample`` bounds the labelled rows of each label that a model is fitted on, about."""

    bits: int = 18
    sample: int = 4_000
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4
    scale: float = 8.0


# Byte classes of a word's shape: a letter, a digit, a capital, a byte of a longer character;
# any other byte stands for itself.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123], _SHAPE[48:58], _SHAPE[65:91], _SHAPE[128:] = 97, 48, 65, 97


def features(data: np.ndarray, at: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashed features of each text, and where each text's begin.

    A text of n words has 4 n features: n words, n shapes, and the 2-grams of both, where the
    last word of a text counts as a 2-gram with the text's end.
    """
    starts, ends, before = arrays.words(data, at)
    lower = arrays.hash_spans(arrays.LOWER[data], starts, ends)
    shaped = _SHAPE[data]
    first = np.append(True, shaped[1:] != shaped[:-1])
    first[starts] = True
    place = np.append(0, np.cumsum(first))
    shape = arrays.hash_spans(shaped[first], place[starts], place[ends])
    last = np.zeros(len(starts), dtype=bool)
    last[before[1:][before[1:] > before[:-1]] - 1] = True
    found = np.empty((len(starts), 4), dtype=np.int64)
    for k, one in enumerate((lower, shape)):
        following = np.append(one[1:], U64(0))[: len(one)]
        following[last] = U64(0)
        pair = arrays.mix(one * U64(3) + following * U64(0x9E3779B97F4A7C15))
        for j, x in ((2 * k, one + U64(k)), (2 * k + 1, pair)):
            found[:, j] = (arrays.mix(x) >> U64(64 - bits)).view(np.int64)
    return found.ravel(), 4 * before


def _sums(weights: np.ndarray, found: np.ndarray, before: np.ndarray, scale: float) -> np.ndarray:
    """Logits without the bias: the scaled mean weight of each text's features; 0 without any."""
    return scale * arrays.segment_sum(weights[found], before) / np.maximum(np.diff(before), 1)


def fit_ftrl(texts: pa.Array, labels: np.ndarray, params: Params) -> tuple[np.ndarray, float]:
    """Weights and bias after so many passes over the rows, in the order given."""
    size = 1 << params.bits
    z, n = np.zeros(size + 1), np.zeros(size + 1)  # the last is the bias

    def weight(z, n):
        shrunk = np.sign(z) * params.l1 - z
        w = shrunk / ((params.beta + np.sqrt(n)) / params.alpha + params.l2)
        return np.where(np.abs(z) <= params.l1, 0.0, w)

    rows = []
    for _, data, at in arrays.chunks(texts):
        found, before = features(data, at, params.bits)
        for a, b in zip(before[:-1], before[1:], strict=True):
            index, count = np.unique(found[a:b], return_counts=True)
            rows.append((
                np.append(index, size).astype(np.int32),
                np.append(params.scale * count / max(b - a, 1), 1.0).astype(np.float32),
            ))
    for _ in range(params.epochs):
        for (index, x), y in zip(rows, labels, strict=True):
            zi, ni = z[index], n[index]
            w = weight(zi, ni)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / params.alpha
            z[index] += g - sigma * w
            n[index] += g * g
    weights = weight(z, n)
    return weights[:-1].astype(np.float32), float(weights[-1])


def sample_labels(
    labels: DataFrame, id_col: str = "doc_id", label: str = "quality",
    folds: int = 4, held_out: int = 2, params: Params = Params(),
) -> DataFrame:
    """(id, label) of the labelled rows to learn from, about ``params.sample`` of each label at most.

    Rows of the held-out fold, null ids and labels other than 0 and 1 are left out. The sample is
    those with the smallest hashes of their id, so reruns agree.
    """
    rows = (
        labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~in_fold("id", folds, held_out))
        .distinct()
    )
    share = F.lit(0.0)
    for found in rows.groupBy("label").count().collect():  # 2 rows
        of = F.lit(min(1.0, params.sample / found["count"]))
        share = F.when(F.col("label") == found["label"], of).otherwise(share)
    return rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < share * (1 << 20))


def sampled_texts(
    docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(id, label, order, text): one row for each of the sample's that has a document.

    Of several rows of one id it is that with the smallest hash; tasks pass on one row an id.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(sample), "id"
    )
    least = F.min(F.struct(F.xxhash64("id", "text").alias("order"), "text")).alias("least")
    return rows.groupBy("id", "label").agg(least).select("id", "label", "least.order", "least.text")


def fit(
    docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text: str = "text",
    params: Params = Params(),
) -> tuple[np.ndarray, float]:
    """Weights and bias learnt by one task from the texts of a bounded sample (id, label).

    Several labels of one id are separate rows; of several documents of one id, one counts. Without
    rows, all weights are 0.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("order", "ascending"), ("label", "ascending")])
        weights, bias = fit_ftrl(
            table.column("text").combine_chunks(), table.column("label").to_numpy(), params
        )
        return pa.table({
            "weights": pa.array([weights.tobytes()], pa.binary()), "bias": pa.array([bias]),
        })

    model = (
        sampled_texts(docs, sample, id_col, text)
        .groupBy(F.lit(0).alias("one")).applyInArrow(run, "weights binary, bias double").collect()
    )
    if not model:
        return np.zeros(1 << params.bits, dtype=np.float32), 0.0
    return np.frombuffer(model[0]["weights"], dtype=np.float32), model[0]["bias"]


def score(
    docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text", params: Params = Params()
) -> DataFrame:
    """All rows and columns with ``score`` (0 to 1; higher: label 1 is likelier), which replaces
    an input column of that name. A null, empty or blank text has the score of the bias alone.
    Whole texts count, however long."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # 4 << bits bytes
    clean = docs.drop("score")
    columns = clean.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = held.value
        for batch in batches:
            scores = [np.zeros(0)]
            for _, data, at in arrays.chunks(batch.column(text)):
                found, before = features(data, at, params.bits)
                logits = _sums(weights, found, before, params.scale) + bias
                scores.append(1 / (1 + np.exp(-np.clip(logits, -35, 35))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.concatenate(scores))], [*columns, "score"]
            )

    return clean.mapInArrow(run, schema_with(clean, score="double"))
