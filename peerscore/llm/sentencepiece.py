"""SentencePiece encoding and decoding in batched numpy.

A text is cut into units that no piece crosses. Of the distinct units of a batch, those of equal
length advance together: the hashes of all their substrings probe the sorted hashes of the pieces.
A unigram model takes the best path by Viterbi, whose vectorised maxima store backpointers. A BPE
model merges, step by step, the pair with the best score in each unit: its scores are merge
priorities, so a sum of them doesn't rank segmentations, and Viterbi would give other pieces than
the model's own encoder.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from peerscore.llm import arrays
from peerscore.llm.frames import schema_with

U64 = np.uint64
NONE = -np.inf
#: Units of more characters are encoded one by one.
LONG = 64
#: Distinct units that a task remembers with their pieces.
REMEMBER = 300_000


@dataclass
class Vocabulary:
    """Pieces by id as UTF-8 with spaces for U+2581, scores, and the kind of model.

    ``byte_ids`` has the ids of the 256 byte pieces, or is None; then unknown characters become
    ``unknown``. ``text`` says which pieces are matched in texts.
    """

    pieces: list[bytes]
    scores: np.ndarray
    text: np.ndarray
    byte_ids: np.ndarray | None
    unknown: int
    unigram: bool
    dummy: bool = True
    keys: np.ndarray = field(init=False)

    def __post_init__(self):
        matched = np.flatnonzero(self.text)
        strings = [self.pieces[i].decode() for i in matched]
        if any(" " in x.lstrip(" ") for x in strings):
            raise ValueError("a piece with a space after another character")
        hashes = np.array([_hash(x) for x in strings], dtype=U64)
        order = np.argsort(hashes)
        self.keys, self.ids = hashes[order], matched[order]
        self.longest = max(map(len, strings), default=1)
        self.seen = np.zeros(1 << 20, dtype=bool)
        self.seen[(self.keys >> U64(44)).view(np.int64)] = True
        inside = {c for x in strings if len(x) > 1 for c in x}
        # ASCII characters that are in no longer piece are units of their own
        self.alone = np.array([b < 128 and chr(b) not in inside for b in range(256)])

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """The vocabulary of a model file whose normaliser leaves texts as they are."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec, kinds = model.normalizer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models that leave texts as they are")
        trainer = model.trainer_spec
        if trainer.treat_whitespace_as_suffix or trainer.model_type not in (1, 2):
            raise ValueError("only unigram and BPE models with spaces before words")
        pieces, byte_ids = [], np.full(256, -1)
        for i, p in enumerate(model.pieces):
            is_byte = p.type == kinds.BYTE
            if is_byte:
                byte_ids[int(p.piece[1:-1], 16)] = i
            text = p.type in (kinds.NORMAL, kinds.USER_DEFINED, kinds.UNUSED)
            pieces.append(
                bytes([int(p.piece[1:-1], 16)]) if is_byte
                else p.piece.replace("▁", " ").encode() if text else b""
            )
        kind = np.array([p.type for p in model.pieces])
        return cls(
            pieces, np.array([p.score for p in model.pieces]),
            np.isin(kind, (kinds.NORMAL, kinds.USER_DEFINED)),
            byte_ids if trainer.byte_fallback and (byte_ids >= 0).all() else None,
            trainer.unk_id, trainer.model_type == 1, spec.add_dummy_prefix,
        )

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The ids of the pieces with these hashes, -1 for none."""
        found = np.full(hashes.shape, -1, dtype=np.int32)
        maybe = np.flatnonzero(self.seen[(hashes >> U64(44)).view(np.int64)].ravel())
        probe = hashes.ravel()[maybe]
        at = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
        hit = self.keys[at] == probe
        found.ravel()[maybe[hit]] = self.ids[at[hit]]
        return found


def _hash(piece: str) -> int:
    points = arrays.mix(np.array([ord(c) for c in piece], dtype=U64))
    return int(arrays.hash_runs(points, np.array([0]), np.array([len(points)]))[0])


def _substrings(points: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """ids[w, i, k]: the piece that is unit w's substring of k + 1 characters from i, or -1."""
    n = points.shape[1]
    most = min(vocabulary.longest, n)
    up, down = arrays._power(n + 1)
    sums = np.zeros((len(points), n + 1), dtype=U64)
    np.cumsum(arrays.mix(points.astype(U64)) * up[:n], axis=1, out=sums[:, 1:])
    ids = np.full((len(points), n, most), -1, dtype=np.int32)
    for k in range(1, most + 1):
        total = (sums[:, k:] - sums[:, : n - k + 1]) * down[: n - k + 1]
        ids[:, : n - k + 1, k - 1] = vocabulary.find(
            arrays.mix(total + U64(k * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        )
    return ids


def viterbi(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """first[w, i]: whether a piece of unit w's best segmentation begins at character i.

    Characters that are no piece cost 10 more than the worst piece. Of equally good paths the one
    whose last piece is the longest wins.
    """
    count, n, most = ids.shape
    worst = vocabulary.scores[vocabulary.text].min(initial=0.0) - 10.0
    scores = np.where(ids >= 0, vocabulary.scores[ids], NONE)
    scores[:, :, 0] = np.where(ids[:, :, 0] >= 0, scores[:, :, 0], worst)
    best = np.full((count, n + 1), NONE)
    best[:, 0] = 0.0
    back = np.zeros((count, n + 1), dtype=np.int32)
    for end in range(1, n + 1):
        starts = np.arange(max(end - most, 0), end)  # the longest piece first
        total = best[:, starts] + scores[:, starts, end - starts - 1]
        pick = total.argmax(1)
        back[:, end] = starts[pick]
        best[:, end] = total[np.arange(count), pick]
    first = np.zeros((count, n + 1), dtype=bool)
    at, rows = np.full(count, n), np.arange(count)
    while at.any():
        at = np.where(at > 0, back[rows, at], 0)
        first[rows, at] = True
    return first[:, :n]


def merges(ids: np.ndarray, vocabulary: Vocabulary) -> np.ndarray:
    """first[w, i] as above for BPE: the best pair of each unit merges, the leftmost of equals."""
    count, n, most = ids.shape
    padded = np.full((count, n, n + 1), NONE, dtype=np.float32)
    padded[:, :, 2 : most + 1] = np.where(ids >= 0, vocabulary.scores[ids], NONE)[:, :, 1:]
    result = np.zeros((count, n), dtype=bool)
    rows = np.arange(count)
    place = np.tile(np.append(np.arange(n), [n, n]), (count, 1))  # where symbols begin
    while len(rows):
        start, end = place[:, :-2], place[:, 2:]
        real = place[:, 1:-1] < n
        value = np.where(
            real, padded[rows[:, None], np.minimum(start, n - 1), end - start], NONE
        )
        pick = value.argmax(1)
        more = value[np.arange(len(rows)), pick] > NONE
        done = ~more
        for_rows = np.repeat(rows[done], place.shape[1])
        at = place[done].ravel()
        result[for_rows[at < n], at[at < n]] = True
        rows, place, pick = rows[more], place[more], pick[more]
        keep = np.ones(place.shape, dtype=bool)
        keep[np.arange(len(rows)), pick + 1] = False
        place = place[keep].reshape(len(rows), place.shape[1] - 1)
    return result


def merge_long(unit: str, vocabulary: Vocabulary, score_of: dict[str, float]) -> list[str]:
    """The BPE pieces of one long unit, by a heap of pairs."""
    pieces, left = list(unit), [i - 1 for i in range(len(unit))]
    right = [*range(1, len(unit)), -1]
    heap: list = []

    def push(i, j):
        if i >= 0 and j >= 0 and (s := score_of.get(pieces[i] + pieces[j])) is not None:
            heapq.heappush(heap, (-s, i, j, pieces[i], pieces[j]))

    for i in range(len(unit) - 1):
        push(i, i + 1)
    while heap:
        _, i, j, a, b = heapq.heappop(heap)
        if pieces[i] != a or pieces[j] != b or right[i] != j:
            continue
        pieces[i], pieces[j], right[i] = a + b, "", right[j]
        if right[j] >= 0:
            left[right[j]] = i
        push(left[i], i)
        push(i, right[i])
    return [x for x in pieces if x]


class Encoder:
    """Encodes texts; remembers the pieces of the units it has seen last."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.score_of = {
            vocabulary.pieces[i].decode(): float(vocabulary.scores[i])
            for i in np.flatnonzero(vocabulary.text)
        }
        self.id_of = {vocabulary.pieces[i].decode(): int(i) for i in np.flatnonzero(vocabulary.text)}
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, dtype=U64)  # sorted hashes of units
        self.at, self.size = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _units(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where units begin: at a text's start, at a space after something else, and around
        characters that stand alone."""
        space, alone = data == 32, self.vocabulary.alone[data]
        first = np.empty(len(data), dtype=bool)
        first[:1] = True
        first[1:] = (space[1:] & ~space[:-1]) | alone[1:] | alone[:-1]
        first[at[:-1][at[:-1] < len(data)]] = True
        return np.flatnonzero(first)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where each text's begin."""
        all_ids, lengths = [np.zeros(0, dtype=np.int32)], [np.zeros(0, dtype=np.int64)]
        for _, data, at in arrays.chunks(texts):
            data, at = self._prepared(data, at)
            starts = self._units(data, at)
            ends = np.append(starts[1:], len(data))
            hashes = arrays.hash_spans(data, starts, ends)
            unique, first, which = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self.known) + len(unique) > REMEMBER:
                self.forget()
            place = np.searchsorted(self.known, unique)
            new = np.ones(len(unique), dtype=bool)
            inside = place < len(self.known)
            new[inside] = self.known[place[inside]] != unique[inside]
            if new.any():
                self._learn(data, starts[first[new]], ends[first[new]], unique[new])
            place = np.searchsorted(self.known, unique)[which]
            size = self.size[place]
            all_ids.append(self.ids[arrays.gather(self.at[place], size)])
            before = np.append(0, np.cumsum(size))[np.searchsorted(starts, at)]
            lengths.append(np.diff(before))
        return np.concatenate(all_ids), np.append(0, np.cumsum(np.concatenate(lengths)))

    def _prepared(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts with U+2581 as a space, and a space before each that isn't empty."""
        size = np.diff(at)
        mark = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81))
        if len(mark):
            data = data.copy()
            data[mark] = 32
            keep = np.ones(len(data), dtype=bool)
            keep[mark + 1] = keep[mark + 2] = False
            at = np.append(0, np.cumsum(keep))[at]
            data, size = data[keep], np.diff(at)
        if not self.vocabulary.dummy:
            return data, at
        filled = size > 0
        out_at = np.append(0, np.cumsum(size + filled))
        out = np.full(out_at[-1], 32, dtype=np.uint8)
        out[arrays.gather(out_at[:-1] + filled, size)] = data
        return out, out_at

    def _learn(self, data, starts, ends, hashes) -> None:
        lead = np.append(0, np.cumsum((data & 0xC0) != 0x80))
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype=np.uint32)
        begin, chars = lead[starts], lead[ends] - lead[starts]
        ids, size, order = [], [], []
        for n in np.unique(chars).tolist():
            group = np.flatnonzero(chars == n)
            if n > LONG and not self.vocabulary.unigram:
                for g in group.tolist():
                    unit = data[starts[g] : ends[g]].tobytes().decode()
                    found = [
                        y for x in merge_long(unit, self.vocabulary, self.score_of)
                        for y in self._ids(x)
                    ]
                    ids.append(np.array(found, dtype=np.int32))
                    size.append([len(found)])
                    order.append([g])
                continue
            step = max(1, 2_000_000 // (n * min(n, self.vocabulary.longest) + n * n))
            for a in range(0, len(group), step):
                part = group[a : a + step]
                found, sizes = self._segment(points[begin[part][:, None] + np.arange(n)])
                ids.append(found)
                size.append(sizes)
                order.append(part)
        size, order = np.concatenate(size).astype(np.int64), np.concatenate(order)
        at = len(self.ids) + np.append(0, np.cumsum(size))[:-1]
        known = np.append(self.known, hashes[order])
        rank = np.argsort(known)
        self.known = known[rank]
        self.at = np.append(self.at, at)[rank]
        self.size = np.append(self.size, size)[rank]
        self.ids = np.concatenate([self.ids, *ids])

    def _ids(self, piece: str) -> list[int]:
        if (found := self.id_of.get(piece)) is not None:
            return [found]
        if self.vocabulary.byte_ids is None:
            return [self.vocabulary.unknown]
        return [int(self.vocabulary.byte_ids[b]) for b in piece.encode()]

    def _segment(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units of equal length, one unit after the other, and how many each has."""
        ids = _substrings(points, self.vocabulary)
        cut = viterbi if self.vocabulary.unigram else merges
        first = cut(ids, self.vocabulary)
        unit, begin = np.nonzero(first)
        end = np.append(begin[1:], 0)
        end[np.append(unit[1:] != unit[:-1], True)] = points.shape[1]
        found = ids[unit, begin, end - begin - 1]
        unknown = np.flatnonzero(found < 0)
        size = np.ones(len(found), dtype=np.int64)
        spelled = [self._ids(chr(x)) for x in points[unit[unknown], begin[unknown]].tolist()]
        size[unknown] = [len(x) for x in spelled]
        out = np.repeat(found, size)
        if spelled:
            at = np.append(0, np.cumsum(size))[:-1][unknown]
            out[arrays.gather(at, size[unknown])] = np.concatenate(spelled)
        return out, np.bincount(unit, weights=size, minlength=len(points)).astype(np.int64)


def decode(ids: np.ndarray, before: np.ndarray, vocabulary: Vocabulary) -> list[bytes]:
    """The texts of runs ids[before[i]:before[i + 1]]; control pieces vanish."""
    size = np.array([len(x) for x in vocabulary.pieces], dtype=np.int64)
    at = np.append(0, np.cumsum(size))
    flat = np.frombuffer(b"".join(vocabulary.pieces), dtype=np.uint8)
    data = flat[arrays.gather(at[:-1][ids], size[ids])].tobytes()
    ends = np.append(0, np.cumsum(size[ids]))[before].tolist()
    texts = [data[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return [x[1:] if vocabulary.dummy and x[:1] == b" " else x for x in texts]


def with_ids(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids") -> DataFrame:
    """All rows and columns with ``ids``, an array of piece ids, which replaces an input column.

    Null and empty texts have an empty array. Texts are not normalised; whole texts are encoded.
    """
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    clean = docs.drop(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(held.value)
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                piece = batch.slice(row, 500)
                found, before = encoder.encode(piece.column(text))
                made = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays([*piece.columns, made], [*batch.schema.names, ids])

    return clean.mapInArrow(run, schema_with(clean, **{ids: "array<int>"}))


def with_text(rows: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """All rows and columns with ``text``, decoded from ``ids``; it replaces an input column.

    Null ids give null. Bytes that are no UTF-8 become U+FFFD; unknown ids are an error.
    """
    held = rows.sparkSession.sparkContext.broadcast(vocabulary)
    clean = rows.drop(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(0, batch.num_rows, 500):
                piece = batch.slice(row, 500)
                column = piece.column(ids)
                flat = column.flatten().to_numpy(zero_copy_only=False)
                size = column.value_lengths().fill_null(0).to_numpy()
                found = decode(flat, np.append(0, np.cumsum(size)), held.value)
                valid = column.is_valid().to_pylist()
                made = pa.array(
                    [x.decode(errors="replace") if v else None for x, v in zip(found, valid, strict=True)],
                    pa.string(),
                )
                yield pa.RecordBatch.from_arrays([*piece.columns, made], [*batch.schema.names, text])

    return clean.mapInArrow(run, schema_with(clean, **{text: "string"}))
