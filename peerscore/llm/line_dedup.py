"""Line dedup: sharded minimal perfect hashes over the distinct lines, probed by documents.

Every shard of the index holds a minimal perfect hash over its distinct line hashes, and two
arrays in that order: fingerprints, and the number of documents per line. The probes of documents
are dealt to the shards; each task streams them past one shard's arrays at a time. Only the lines
to drop travel back to their documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from peerscore.llm.arrays import mix
from peerscore.llm.frames import schema_with
from peerscore.session import stage

U64 = np.uint64
BLANK = b" \t\n\x0b\x0c\r"
#: Distinct lines per shard of the index, about; a shard's arrays take some 5 bytes a line.
SHARD_LINES = 250_000
#: Probes that one task streams past a shard, about; shards with hot lines are probed by several.
SHARD_PROBES = 1_000_000
#: Bits a key in each level of the perfect hash.
GAMMA = 2.0


def line_key(line: bytes, min_chars: int) -> int | None:
    """The 64-bit hash of a line's key; None if the key is too short to be compared."""
    key = line.strip(BLANK).lower()  # of bytes: A-Z only
    if len(key) < min_chars or len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_64_intdigest(key) - (1 << 63)


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit keys: a cascade of bit arrays.

    On each level a key that is alone in its cell keeps it; the others go on to the next level.
    A key's index is the number of cells kept before its own.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        kept = np.concatenate([np.zeros(0, dtype=bool), *levels])
        self.rank = np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])

    @staticmethod
    def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = U64((level * 0x9E3779B97F4A7C15 + 1) & (2**64 - 1))
        return (mix(keys ^ seed) % U64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = math.ceil(GAMMA * len(keys)) + 1
            cells = cls._cells(keys, len(levels), size)
            alone = np.bincount(cells, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[cells]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key of the set; -1 or any index for others."""
        found = np.full(len(keys), -1, dtype=np.int64)
        todo, base = np.arange(len(keys)), 0
        for level, alone in enumerate(self.levels):
            cells = self._cells(keys[todo], level, len(alone))
            hit = alone[cells]
            found[todo[hit]] = self.rank[base + cells[hit]]
            todo, base = todo[~hit], base + len(alone)
        return found

    def dump(self) -> list[bytes]:
        return [np.packbits(x).tobytes() + bytes([-len(x) % 8]) for x in self.levels]

    @classmethod
    def load(cls, levels: list[bytes]) -> PerfectHash:
        return cls([
            np.unpackbits(np.frombuffer(x[:-1], dtype=np.uint8)).astype(bool)
            [: 8 * (len(x) - 1) - x[-1]] for x in levels
        ])


def _fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(~keys) >> U64(32)).astype(np.uint32)


def _line_keys(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(row, line): each row's distinct line keys; ``row`` is a hash of its id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, lines = [], []
            texts = batch.column(text)
            for row, value in zip(batch.column("row").to_pylist(), texts, strict=True):
                found = {line_key(x, min_chars) for x in _bytes(value).split(b"\n")} - {None}
                rows += [row] * len(found)
                lines += found
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(lines, pa.int64())], ["row", "line"]
            )

    return docs.select("row", text).mapInArrow(run, "row long, line long")


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def build_index(lines: DataFrame, shards: int) -> DataFrame:
    """(shard, levels, fingerprints, counts, probes) from (line, n_docs): one row per shard."""

    def run(table: pa.Table) -> pa.Table:
        keys = table.column("line").to_numpy().view(U64)
        counts = table.column("n_docs").to_numpy()
        perfect = PerfectHash.build(keys)
        at = perfect.index(keys)
        prints, ordered = np.zeros(len(keys), dtype=np.uint32), np.zeros(len(keys), dtype=np.uint32)
        prints[at] = _fingerprints(keys)
        ordered[at] = np.minimum(counts, 2**32 - 1)
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()),
            "levels": pa.array([perfect.dump()], pa.list_(pa.binary())),
            "fingerprints": pa.array([prints.tobytes()], pa.binary()),
            "counts": pa.array([ordered.tobytes()], pa.binary()),
            "probes": pa.array([int(counts.sum())], pa.int64()),
        })

    schema = "shard long, levels array<binary>, fingerprints binary, counts binary, probes long"
    return (
        lines.withColumn("shard", F.pmod("line", F.lit(shards)))
        .groupBy("shard").applyInArrow(run, schema)
    )


def _probe(lines: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """(row, line) of the probes (row, line) whose line is in at least ``min_docs`` documents.

    Index and probes of a shard meet in a task; a shard with many probes is dealt to several.
    """
    parts = index.select("shard", F.ceil(F.col("probes") / SHARD_PROBES).cast("int").alias("parts"))
    busy = parts.filter("parts > 1")  # at most 1 for each SHARD_PROBES probes
    probes = (
        lines.withColumn("shard", F.pmod("line", F.lit(shards))).join(busy, "shard", "left")
        .select(
            "shard", F.pmod(F.xxhash64("row"), F.coalesce("parts", F.lit(1))).alias("part"),
            F.lit(1).alias("kind"), "row", "line",
        )
    )
    arrays = index.join(parts, "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.greatest("parts", F.lit(1)) - 1)).alias("part"),
        F.lit(0).alias("kind"), "levels", "fingerprints", "counts",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = None
        for batch in batches:
            kind, shard = batch.column("kind").to_numpy(), batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard) | np.diff(kind)) + 1), len(kind)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a == b:
                    continue
                if kind[a] == 0:
                    levels, prints, counts = (
                        batch.column(x)[int(a)].as_py() for x in ("levels", "fingerprints", "counts")
                    )
                    loaded = (
                        shard[a], PerfectHash.load(levels),
                        np.frombuffer(prints, dtype=np.uint32), np.frombuffer(counts, dtype=np.uint32),
                    )
                    continue
                of, perfect, prints, counts = loaded
                if of != shard[a]:
                    raise ValueError(f"no index of shard {shard[a]}")
                keys = batch.column("line").to_numpy()[a:b]
                at = perfect.index(keys.view(U64))
                found = (at >= 0) & (prints[at] == _fingerprints(keys.view(U64)))
                often = found & (counts[at] >= min_docs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(batch.column("row").to_numpy()[a:b][often]), pa.array(keys[often])],
                    ["row", "line"],
                )

    both = arrays.unionByName(probes, allowMissingColumns=True)
    dealt = both.select(
        "shard", "part", "kind", F.coalesce("row", F.lit(0)).alias("row"),
        F.coalesce("line", F.lit(0)).alias("line"), "levels", "fingerprints", "counts",
    ).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")
    return dealt.mapInArrow(run, "row long, line long")


def drop_frequent_lines(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text",
    min_docs: int = 10, min_chars: int = 1,
) -> DataFrame:
    """All rows and columns, with ``text`` without its frequent lines, and n_lines, n_dropped.

    A text is split at newlines. A line's key is the line without blanks at its ends, A-Z
    lower-cased. A key of at least ``min_chars`` code points that is in at least ``min_docs`` rows
    loses all its lines in all rows; the other lines stay, joined by newlines.

    * Null or empty text: one empty line; its text becomes "" (nothing is dropped).
    * A text of which nothing is left is "". Repeated rows count as documents of their own.
    * An empty table gives an empty table. Columns n_lines and n_dropped of the input are replaced.
    """
    key = F.xxhash64(*([id_col] if id_col in docs.columns else []), text)
    clean = docs.drop("n_lines", "n_dropped")
    lines = stage(_line_keys(docs.select(key.alias("row"), text), text, min_chars), "lines")
    seen = Observation()
    counted = stage(
        lines.groupBy("line").agg(F.count("*").alias("n_docs"))
        .observe(seen, F.count("*").alias("lines")), "line_counts",
    )
    shards = max(1, math.ceil(seen.get["lines"] / SHARD_LINES))
    index = stage(build_index(counted, shards), "line_index")
    dropped = (
        _probe(lines, index, shards, min_docs)
        .groupBy(F.col("row").alias("__row")).agg(F.collect_set("line").alias("__lines"))
    )
    joined = clean.withColumn("__row", key).join(dropped, "__row", "left").drop("__row")
    columns = clean.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, drops = [], [], []
            for value, gone in zip(batch.column(text), batch.column("__lines"), strict=True):
                parts = _bytes(value).split(b"\n")
                kept = parts
                if gone.is_valid:
                    lost = set(gone.as_py())
                    kept = [x for x in parts if line_key(x, min_chars) not in lost]
                texts.append(b"\n".join(kept))
                totals.append(len(parts))
                drops.append(len(parts) - len(kept))
            made = {text: pa.array(texts, pa.binary()).cast(pa.string())}
            yield pa.RecordBatch.from_arrays(
                [made.get(c, batch.column(c)) for c in columns]
                + [pa.array(totals, pa.int64()), pa.array(drops, pa.int64())],
                [*columns, "n_lines", "n_dropped"],
            )

    schema = schema_with(clean, n_lines="long", n_dropped="long")
    return joined.select(*columns, "__lines").mapInArrow(run, schema)


