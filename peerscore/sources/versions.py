"""A Parquet table kept as numbered versions, so that no run overwrites what it reads.

``<root>/v00000001`` holds the files of one version. A version counts only once its marker
``_READY`` exists; readers take the highest one. A run that dies half-way, or whose quality gate
fails, leaves a version without a marker, which readers ignore.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from peerscore.sources import files

READY = "_READY"
BUCKETS = "_BUCKETS_"


@dataclass(frozen=True)
class VersionedTable:
    spark: SparkSession
    root: str
    buckets: int = 0
    key: str = "place_id"

    def __post_init__(self):
        object.__setattr__(self, "root", self.root.rstrip("/"))

    def _versions(self) -> list[str]:
        if not files.exists(self.spark, self.root):
            return []
        found = [n for n in files.names(self.spark, self.root) if not n.startswith((".", "_"))]
        other = [n for n in found if not (n[:1] == "v" and n[1:].isdigit())]
        if other:
            raise ValueError(f"{self.root} holds something else than versions: {other[:3]}")
        return [f"{self.root}/{n}" for n in found]

    def current(self) -> str | None:
        """Path of the newest complete version, or None before the first run.

        Only a missing folder or marker means "first run"; an unreadable store raises.
        """
        for path in reversed(self._versions()):
            if files.exists(self.spark, f"{path}/{READY}"):
                return path
        return None

    def read(self) -> DataFrame | None:
        path = self.current()
        return None if path is None else self.open(path)

    def open(self, path: str) -> DataFrame:
        """One version, with its bucketing if it has any."""
        count = self._bucket_count(path)
        if not count:
            return self.spark.read.parquet(path)
        name = self._entry(path)
        if not self.spark.catalog.tableExists(name):
            fields = self.spark.read.parquet(path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {count} BUCKETS "
                f"LOCATION '{path}'"
            )
        return self.spark.table(name)

    def is_aligned(self) -> bool:
        """The current version has the buckets that the next one will have."""
        path = self.current()
        return bool(self.buckets and path and self._bucket_count(path) == self.buckets)

    def _bucket_count(self, path: str) -> int:
        marks = [n for n in files.names(self.spark, path) if n.startswith(BUCKETS)]
        return int(marks[0].removeprefix(BUCKETS)) if marks else 0

    @staticmethod
    def _entry(path: str) -> str:
        return f"default.version_{hashlib.md5(path.encode()).hexdigest()}"

    def next_path(self) -> str:
        versions = self._versions()
        number = int(versions[-1].rsplit("/v", 1)[1]) + 1 if versions else 1
        return f"{self.root}/v{number:08d}"

    def stage_part(self, path: str, name: str, df: DataFrame) -> str:
        """Write one of several tables that become visible together."""
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        return f"{path}/{name}"

    def read_part(self, name: str) -> DataFrame | None:
        path = self.current()
        return None if path is None else self.spark.read.parquet(f"{path}/{name}")

    def stage(self, df: DataFrame) -> str:
        """Write the next version without making it visible; returns its path."""
        path = self.next_path()
        if not self.buckets:
            df.write.mode("errorifexists").parquet(path)
            return path
        if not self.is_aligned():
            # One task per bucket. Rows joined from an aligned version already sit that way.
            df = df.repartition(self.buckets, self.key)
        (
            df.write.mode("errorifexists").format("parquet").option("path", path)
            .bucketBy(self.buckets, self.key).sortBy(self.key).saveAsTable(self._entry(path))
        )
        files.mark(self.spark, f"{path}/{BUCKETS}{self.buckets}")
        return path

    def promote(self, path: str) -> None:
        files.mark(self.spark, f"{path}/{READY}")

    def replace(self, df: DataFrame) -> str:
        path = self.stage(df)
        self.promote(path)
        return path

    def prune(self, keep: int = 2) -> list[str]:
        """Delete all but the newest ``keep`` complete versions, and failed ones older than them."""
        if keep < 1:
            raise ValueError("keep at least one version")
        versions = self._versions()
        ready = [v for v in versions if files.exists(self.spark, f"{v}/{READY}")]
        if len(ready) <= keep:
            return []
        gone = [v for v in versions if v < ready[-keep]]
        for path in gone:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._entry(path)}")
            files.remove(self.spark, path)
        return gone
