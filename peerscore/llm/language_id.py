"""Language identification of mixed texts: script ranges, word scores, Viterbi over words.

The scripts of a word's letters narrow the candidate languages; character n-grams score the word
for each. The best path through a text's words, where a change of language costs a penalty, labels
its spans.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm import arrays
from peerscore.llm.frames import schema_with
from peerscore.session import stage

U64 = np.uint64
#: Words whose scores a task holds at once, about.
BATCH_WORDS = 1_000_000

# Where blocks of the Unicode character table begin, and the script of their letters.
SCRIPT_RANGES = [
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "other"),
    (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"),
    (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"),
    (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"),
    (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"),
    (0xFB13, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"),
    (0x30000, "other"),
]
_STARTS = np.array([a for a, _ in SCRIPT_RANGES])
SCRIPTS = sorted({name for _, name in SCRIPT_RANGES})
_SCRIPT = np.array([SCRIPTS.index(name) for _, name in SCRIPT_RANGES])


@dataclass(frozen=True)
class Params:
    """``penalty`` is what a change of language costs, as a difference of log-likelihoods. A
    language uses a script if at least ``rare`` of its letters are of it."""

    bits: int = 16
    penalty: float = 24.0
    rare: float = 0.002
    languages: int = 512


@dataclass(frozen=True)
class Model:
    """Log-likelihoods of hashed n-grams by language, and the languages of each script."""

    names: list[str]
    scores: np.ndarray
    uses: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def _is_letter(points: np.ndarray) -> np.ndarray:
    found = _letters()[np.minimum(points, (1 << 16) - 1)]
    for x in np.unique(points[points >= 1 << 16]):
        found[points == x] = chr(int(x)).isalpha()
    return found


def _features(data: np.ndarray, at: np.ndarray, bits: int):
    """Of the letters of some texts: n-grams (letters by two), scripts, words, and each word's text.

    A letter's n-grams are those of 2 and 3 characters that end with it, in lower case, where
    anything that isn't a letter counts as a word's edge. A word is a run of letters.
    """
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
    lead = (data & 0xC0) != 0x80
    at = np.append(0, np.cumsum(lead))[at]
    letter = _is_letter(points)
    low = points.astype(U64)
    capital = ((points >= 65) & (points <= 90)) | ((points >= 0xC0) & (points <= 0xDE) & (points != 0xD7))
    low[capital] += U64(32)
    low[~letter] = U64(0)
    edge = np.append(True, ~letter[:-1]) if len(letter) else letter
    edge[at[:-1][at[:-1] < len(points)]] = True
    one = np.where(edge, U64(0), np.append(U64(0), low[:-1])[: len(low)])
    two = np.where(edge, U64(0), np.append(U64(0), one[:-1])[: len(low)])
    here = np.flatnonzero(letter)
    pair = low[here] | one[here] << U64(21)
    triple = pair | two[here] << U64(42)
    grams = np.stack([arrays.mix(pair * U64(2) + U64(1)), arrays.mix(triple * U64(2))], axis=1)
    scripts = _SCRIPT[np.searchsorted(_STARTS, points[here], "right") - 1]
    words = np.flatnonzero(edge[here])
    text_of = np.searchsorted(at, here[words], "right") - 1
    return (grams >> U64(64 - bits)).view(np.int64), scripts, words, text_of


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", params: Params = Params()) -> Model:
    """A model of all rows with a language. What is collected is ``languages`` tables of fixed size
    at most; more languages are an error. Without rows there are none."""
    size, extra = 1 << params.bits, len(SCRIPTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1)
            for row, data, at in arrays.chunks(batch.column(0)):
                names = np.array(langs.slice(row, len(at) - 1).to_pylist())
                grams, scripts, words, text_of = _features(data, at, params.bits)
                of_word = names[text_of]
                of_letter = np.repeat(of_word, np.diff(np.append(words, len(grams))))
                for name in np.unique(names):
                    mine = of_letter == name
                    total = seen.setdefault(str(name), np.zeros(size + extra, dtype=np.int64))
                    total[:size] += np.bincount(grams[mine].ravel(), minlength=size)
                    total[size:] += np.bincount(scripts[mine], minlength=extra)
        for name, total in seen.items():
            cells = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cells), pa.string()), pa.array(cells), pa.array(total[cells])],
                ["lang", "cell", "n"],
            )

    rows = docs.filter(F.col(lang).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    counts = stage(
        rows.mapInArrow(run, "lang string, cell long, n long").groupBy("lang", "cell")
        .agg(F.sum("n").alias("n")), "grams",
    )
    names = sorted(
        r["lang"] for r in counts.select("lang").distinct().limit(params.languages + 1).collect()
    )
    if len(names) > params.languages:
        raise ValueError(f"more than {params.languages} languages")
    found = counts.toPandas()  # languages * cells rows at most
    table = np.zeros((size + extra, len(names)))
    place = {name: i for i, name in enumerate(names)}
    table[found["cell"].to_numpy(np.int64), found["lang"].map(place).to_numpy(np.int64)] = found["n"]
    grams, scripts = table[:size] + 0.1, table[size:]
    scores = np.log(grams / grams.sum(0)) if names else grams
    return Model(names, scores.astype(np.float32), scripts > params.rare * scripts.sum(0))


def _word_scores(data, at, model: Model, params: Params):
    """Per word: its score by language, its letters, and its text."""
    grams, scripts, words, text_of = _features(data, at, params.bits)
    bounds = np.append(words, len(grams))
    scores = arrays.segment_sum(model.scores[grams[:, 0]] + model.scores[grams[:, 1]], bounds)
    # of a word's letters, as many as can be must be of scripts that a candidate uses
    bad = arrays.segment_sum((~model.uses[scripts]).astype(np.float64), bounds)
    usable = bad == bad.min(1, keepdims=True)
    top = np.where(usable, scores, -np.inf).max(1, keepdims=True)
    floor = scores.min(1, keepdims=True) - 2 * params.penalty
    scores = np.where(usable, scores, floor) - top
    return scores, np.diff(bounds), text_of


def _paths(scores: np.ndarray, begin: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each word; the texts' words are scores[begin[i]:begin[i + 1]].

    A text keeps its best single label if no run of words gains half a penalty by another one: then
    no path with changes is better. The other texts advance together, word by word.
    """
    counts = np.diff(begin)
    best = arrays.segment_sum(scores, begin).argmax(1)
    labels = np.repeat(best, counts)
    own = np.repeat(np.arange(len(counts)), counts)
    changes = np.zeros(len(counts), dtype=bool)
    single = np.take_along_axis(scores, labels[:, None], 1)[:, 0]
    for k in range(scores.shape[1]):
        total = np.cumsum(scores[:, k] - single)
        base = np.append(0.0, total)[begin[:-1]]
        inside = total - np.repeat(base, counts)  # running sums within each text
        changes |= _rises(inside, begin, own) > penalty / 2
    todo = np.flatnonzero(changes)
    todo = todo[np.argsort(-counts[todo], kind="stable")]
    if not len(todo):
        return labels
    return _viterbi(scores, begin, counts, todo, penalty, labels)


def _rises(inside: np.ndarray, begin: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The largest sum of a run of words in each text, from the running sums within texts."""
    texts = len(begin) - 1
    if not len(inside):
        return np.zeros(texts)
    # shifting each text below the one before keeps running minima within texts
    drop = (inside.max() - inside.min() + 1.0) * own
    before = np.append(0.0, inside[:-1])
    before[begin[:-1][np.diff(begin) > 0]] = 0.0
    low = np.minimum.accumulate(before - drop)
    gain = inside - drop - low
    found = np.zeros(texts)
    filled = np.flatnonzero(np.diff(begin) > 0)
    found[filled] = np.maximum.reduceat(gain, begin[:-1][filled])
    return found


def _viterbi(scores, begin, counts, todo, penalty, labels) -> np.ndarray:
    """Labels of the texts ``todo``, sorted by falling length, which advance together."""
    width = scores.shape[1]
    longest = int(counts[todo[0]])
    active = np.searchsorted(-counts[todo], -np.arange(longest), "left")  # texts longer than t
    offset = np.append(0, np.cumsum(active))
    back = np.empty((int(offset[-1]), width), dtype=np.int16)
    value = scores[begin[todo]].copy()
    for t in range(1, longest):
        n = int(active[t])
        here = value[:n]
        top = here.argmax(1)
        jump = here[np.arange(n), top] - penalty
        stay = here >= jump[:, None]
        back[offset[t] : offset[t + 1]] = np.where(stay, np.arange(width), top[:, None])
        value[:n] = np.maximum(here, jump[:, None]) + scores[begin[todo[:n]] + t]
    now = value.argmax(1)
    for t in range(longest - 1, -1, -1):
        n = int(active[t])
        labels[begin[todo[:n]] + t] = now[:n]
        if t:
            now[:n] = back[offset[t] + np.arange(n), now[:n]]
    return labels


def identify(
    docs: DataFrame, model: Model, text: str = "text", params: Params = Params()
) -> DataFrame:
    """All rows and columns with lang_pred, score and spans, which replace input columns.

    ``spans`` has the runs of words of one language: (lang, words, letters). ``lang_pred`` has the
    most letters (of equals the first by name); ``score`` is its share of them. Null texts and
    texts without a letter are ``und`` with score 0 and no spans, as is every text if the model
    knows no language. Whole texts count, however long.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    made = ["lang_pred", "score", "spans"]
    clean = docs.drop(*made)
    span = pa.struct([("lang", pa.string()), ("words", pa.int64()), ("letters", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            row = 0
            parts, rows = [], 0
            for _, data, at in arrays.chunks(batch.column(text)):
                if model.names:
                    parts.append((rows, *_word_scores(data, at, model, params)))
                rows += len(at) - 1
                if row + rows == batch.num_rows or sum(len(x[2]) for x in parts) > BATCH_WORDS:
                    piece = batch.slice(row, rows)
                    yield pa.RecordBatch.from_arrays(
                        [*piece.columns, *_labelled(parts, rows, model, params, span)],
                        [*batch.schema.names, *made],
                    )
                    row, rows, parts = row + rows, 0, []

    schema = schema_with(
        clean, lang_pred="string", score="double",
        spans="array<struct<lang:string,words:bigint,letters:bigint>>",
    )
    return clean.mapInArrow(run, schema)


def _labelled(parts, rows: int, model: Model, params: Params, span: pa.DataType) -> list[pa.Array]:
    """lang_pred, score and spans of so many texts from the scores of their words."""
    width = max(len(model.names), 1)
    scores = np.concatenate([np.zeros((0, width)), *(x[1] for x in parts)])
    letters = np.concatenate([np.zeros(0, dtype=np.int64), *(x[2] for x in parts)])
    text_of = np.concatenate([np.zeros(0, dtype=np.int64), *(x[0] + x[3] for x in parts)])
    begin = np.searchsorted(text_of, np.arange(rows + 1))
    labels = _paths(scores, begin, params.penalty)
    shares = np.zeros((rows, width), dtype=np.int64)
    np.add.at(shares, (text_of, labels), letters)
    total = shares.sum(1)
    best = shares.argmax(1)
    names = np.array([*model.names, "und"], dtype=object)
    first = np.flatnonzero(
        np.append(True, (labels[1:] != labels[:-1]) | (text_of[1:] != text_of[:-1]))[: len(labels)]
    )
    sums = np.append(0, np.cumsum(letters))
    bounds = np.append(first, len(labels))
    kept = pa.StructArray.from_arrays(
        [pa.array(names[labels[first]], pa.string()), pa.array(np.diff(bounds), pa.int64()),
         pa.array(np.diff(sums[bounds]), pa.int64())], fields=list(span),
    )
    return [
        pa.array(np.where(total > 0, names[best], "und"), pa.string()),
        pa.array(shares[np.arange(rows), best] / np.maximum(total, 1)),
        pa.ListArray.from_arrays(
            pa.array(np.searchsorted(text_of[first], np.arange(rows + 1)), pa.int32()), kept
        ),
    ]
