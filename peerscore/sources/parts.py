"""Tables kept in parts by a hash of their key, of which a run rewrites only what it touches.

``<root>/v00000001`` holds the parts that one run wrote, and ``parts.json``, the list of where every
part of every table is: in this version or in an earlier one. A version counts once its marker
exists, for all of its tables at once. A run that dies leaves a version without a marker, which
readers ignore, and the parts that it did not touch were never moved.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peerscore.sources import files
from peerscore.sources.versions import READY

LIST = "parts.json"
#: The column that names the part while a table is written; it is no column of the table.
PART = "part_no"


@dataclass(frozen=True)
class Listing:
    """Where the parts of a version are: table -> part -> path below the root."""

    parts: int
    schemas: dict[str, StructType]
    paths: dict[str, dict[int, str]]

    def text(self) -> str:
        return json.dumps({
            "parts": self.parts,
            "schemas": {t: s.jsonValue() for t, s in self.schemas.items()},
            "paths": self.paths,
        })

    @classmethod
    def of(cls, text: str) -> Listing:
        found = json.loads(text)
        return cls(
            found["parts"], {t: StructType.fromJson(s) for t, s in found["schemas"].items()},
            {t: {int(p): path for p, path in of.items()} for t, of in found["paths"].items()},
        )


@dataclass(frozen=True)
class PartStore:
    """Several tables, each in ``parts`` parts by the key that ``keys`` names for it.

    The number of parts stays what it was when the first version was written.
    """

    spark: SparkSession
    root: str
    keys: dict[str, str]
    parts: int = 64

    def __post_init__(self):
        object.__setattr__(self, "root", self.root.rstrip("/"))

    def _versions(self) -> list[str]:
        if not files.exists(self.spark, self.root):
            return []
        return [n for n in files.names(self.spark, self.root) if n[:1] == "v" and n[1:].isdigit()]

    def _ready(self) -> list[str]:
        return [v for v in self._versions() if files.exists(self.spark, f"{self.root}/{v}/{READY}")]

    def _listing(self, version: str) -> Listing:
        path = f"{self.root}/{version}/{LIST}"
        return Listing.of(self.spark.read.option("wholetext", True).text(path).first()["value"])

    def current(self) -> Listing:
        """The newest complete version; an empty one before the first run."""
        ready = self._ready()
        if not ready:
            return Listing(self.parts, {}, {})
        found = self._listing(ready[-1])
        if found.parts != self.parts:
            raise ValueError(f"{self.root} has {found.parts} parts, not {self.parts}")
        return found

    def part_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")

    def touched(self, table: str, rows: DataFrame) -> list[int]:
        """The parts of a table that the keys of these rows fall into."""
        part = self.part_of(F.col(self.keys[table])).alias(PART)
        return sorted(r[PART] for r in rows.select(part).distinct().collect())

    def read(self, table: str, parts: list[int] | None = None) -> DataFrame | None:
        """A table of the newest version, or some of its parts; None before the first run."""
        return self._open(self.current(), table, parts)

    def _open(self, listing: Listing, table: str, parts: list[int] | None) -> DataFrame | None:
        if table not in listing.schemas:
            return None
        schema, at = listing.schemas[table], listing.paths.get(table, {})
        paths = [f"{self.root}/{path}" for part, path in sorted(at.items()) if parts is None or part in parts]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def draft(self) -> Draft:
        versions = self._versions()
        number = int(versions[-1][1:]) + 1 if versions else 1
        return Draft(self, f"v{number:08d}", self.current())

    def prune(self, keep: int = 2) -> list[str]:
        """Delete the parts that none of the newest ``keep`` complete versions reads any more."""
        if keep < 1:
            raise ValueError("keep at least one version")
        ready = self._ready()
        if len(ready) <= keep:
            return []
        read = {
            path for v in ready[-keep:] for of in self._listing(v).paths.values() for path in of.values()
        }
        gone = []
        for version in (v for v in self._versions() if v < ready[-keep]):
            files.remove(self.spark, f"{self.root}/{version}/{READY}")
            tables = [n for n in files.names(self.spark, f"{self.root}/{version}") if n in self.keys]
            written = [
                f"{version}/{t}/{n}" for t in tables
                for n in files.names(self.spark, f"{self.root}/{version}/{t}") if n.startswith(f"{PART}=")
            ]
            unread = [path for path in written if path not in read]
            if len(unread) == len(written):
                unread = [version]
            for path in unread:
                files.remove(self.spark, f"{self.root}/{path}")
            gone += unread
        return gone


class Draft:
    """The next version of a store, which nobody sees before ``commit``."""

    def __init__(self, store: PartStore, version: str, listing: Listing):
        self.store, self.version, self.base = store, version, listing
        self.schemas = dict(listing.schemas)
        self.paths = {t: dict(of) for t, of in listing.paths.items()}

    def before(self, table: str, parts: list[int]) -> DataFrame | None:
        """Parts of the version that the draft began from."""
        return self.store._open(self.base, table, parts)

    def write(self, table: str, rows: DataFrame, parts: list[int]) -> DataFrame:
        """Replace these parts of a table by rows, all of which must fall into them; read them back.

        A part with many rows is written by several tasks.
        """
        store, path = self.store, f"{self.version}/{table}"
        part = store.part_of(F.col(store.keys[table]))
        (
            rows.withColumn(PART, part).hint("rebalance", PART)
            .write.mode("errorifexists").partitionBy(PART).parquet(f"{store.root}/{path}")
        )
        found = [n for n in files.names(store.spark, f"{store.root}/{path}") if n.startswith(f"{PART}=")]
        written = {int(n.removeprefix(f"{PART}=")): f"{path}/{n}" for n in found}
        if strange := set(written) - set(parts):
            raise ValueError(f"{table}: rows of parts {sorted(strange)[:3]} that are not replaced")
        self.schemas[table] = rows.schema
        kept = {p: x for p, x in self.paths.get(table, {}).items() if p not in parts}
        self.paths[table] = kept | written
        return store._open(self.listing(), table, parts)

    def listing(self) -> Listing:
        return Listing(self.store.parts, self.schemas, self.paths)

    def commit(self) -> str:
        path = f"{self.store.root}/{self.version}"
        files.write_text(self.store.spark, f"{path}/{LIST}", self.listing().text())
        files.mark(self.store.spark, f"{path}/{READY}")
        return path
