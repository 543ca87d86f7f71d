"""Where a job may keep intermediate tables, and how small tables are settled and joined."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    DateType,
    NumericType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from peerscore.sources import files

# A table is broadcast only when it has been measured to stay below both bounds.
BROADCAST_ROWS = 2_000_000
BROADCAST_BYTES = 128 * 1024 * 1024

# The keys of a batch and the districts that it moved are broadcast again and again by one run, and
# the driver gathers them each time, so they must be fewer.
REPEATED_BYTES = 8 * 1024 * 1024

# A group with more rows than this is hot.
HOT_ROWS = 1_000_000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; a cluster must name
    one that every executor can reach.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="peerscore-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


#: Paths handed out within the innermost scope; None outside of any.
_handed_out: ContextVar[list[str] | None] = ContextVar("handed_out", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (paths := _handed_out.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end, also after a failure, what was staged within.

    Tables are lazy: whatever is to be kept must be written before the scope ends.
    """
    paths: list[str] = []
    outer = _handed_out.set(paths)
    try:
        yield
    finally:
        _handed_out.reset(outer)
        for path in paths:
            files.remove(spark, path)


def _width(df: DataFrame) -> Column:
    """Bytes of a row, about: 16 a column, and the text of each value that has no fixed width."""
    fixed = (NumericType, DateType, BooleanType, TimestampType, TimestampNTZType)
    width = F.lit(16 * len(df.columns)).cast("long")
    for field in df.schema:
        if not isinstance(field.dataType, fixed):
            value = F.col(field.name)
            if not isinstance(field.dataType, (StringType, BinaryType)):
                value = value.cast("string")
            width += F.coalesce(F.octet_length(value), F.lit(0))
    return width


def is_small(size: dict) -> bool:
    return size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES


def fewer(size: dict) -> bool:
    """Whether a table is small enough to be broadcast by many jobs of a run."""
    return is_small(size) and size["bytes"] <= REPEATED_BYTES


def settle(df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
    """Run a derived table once; its size and further metrics are counted on the way.

    A reliable checkpoint cuts the lineage and survives the loss of executors.
    """
    scratch_root(df.sparkSession)
    seen = Observation()
    rows = F.count("*").alias("rows")
    size = F.coalesce(F.sum(_width(df)), F.lit(0)).alias("bytes")
    settled = df.observe(seen, rows, size, *metrics).checkpoint()
    return settled, seen.get


def measure(df: DataFrame) -> dict:
    """Rows and bytes of a derived table that is cheap to derive again, and so is not kept."""
    rows = F.count("*").alias("rows")
    return df.agg(rows, F.coalesce(F.sum(_width(df)), F.lit(0)).alias("bytes")).first().asDict()


@dataclass(frozen=True)
class Groups:
    """A settled table with one row per group, and how it may be joined to the groups' rows."""

    df: DataFrame
    every: DataFrame
    keys: list[str]
    size: str
    small: bool
    few_hot: bool
    hot_rows: int

    def filter(self, condition: Column) -> Groups:
        return replace(self, df=self.df.filter(condition))

    def join(self, rows: DataFrame, how: str = "inner") -> DataFrame:
        """Join rows to the groups that are left; ``how`` is inner or left.

        A small table is broadcast. Of a larger one only the hot groups are: they are few, since
        each holds more than ``hot_rows`` rows. The rows of the others are shuffled, and no key
        of those is hot.
        """
        if self.small:
            return rows.join(F.broadcast(self.df), self.keys, how)
        if not self.few_hot:
            return rows.join(self.df, self.keys, how)
        is_hot = F.coalesce(F.col(self.size) > self.hot_rows, F.lit(False))
        hot_keys = F.broadcast(self.every.filter(is_hot).select(*self.keys))
        hot = F.broadcast(self.df.filter(is_hot))
        others = self.df.filter(~is_hot)
        return (
            rows.join(hot_keys, self.keys, "left_semi").join(hot, self.keys, how)
            .unionByName(rows.join(hot_keys, self.keys, "left_anti").join(others, self.keys, how))
        )

    def judge(self, rows: DataFrame, counts: Column) -> DataFrame:
        """All rows, those that count with their group's columns.

        ``size`` is the number of rows that count. The others, which may be any number in one
        group or have none, never enter a shuffle; theirs are NULL if the table is not small.
        """
        if self.small:
            return rows.join(F.broadcast(self.df), self.keys, "left")
        counts = F.coalesce(counts, F.lit(False))
        known = self.join(rows.filter(counts), "left")
        return known.unionByName(rows.filter(~counts), allowMissingColumns=True)

    def join_hot(self, rows: DataFrame) -> DataFrame:
        """Inner join to a table of which only hot groups are left."""
        few = self.small or self.few_hot
        return rows.join(F.broadcast(self.df) if few else self.df, self.keys)


def settle_groups(
    df: DataFrame, keys: list[str], size: str, *metrics: Column, hot_rows: int = HOT_ROWS
) -> tuple[Groups, dict]:
    """Settle a table with one row per group; ``size`` is its column with the rows per group."""
    hot = F.col(size) > hot_rows
    settled, seen = settle(
        df,
        F.count_if(hot).alias("hot_groups"),
        F.coalesce(F.sum(F.when(hot, _width(df))), F.lit(0)).alias("hot_bytes"),
        *metrics,
    )
    few_hot = is_small({"rows": seen["hot_groups"], "bytes": seen["hot_bytes"]})
    return Groups(settled, settled, keys, size, is_small(seen), few_hot, hot_rows), seen


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
