"""bronze -> silver -> gate -> gold -> gate -> publish, in one session."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from peerscore.operators.merge import BATCH_WINS, check_keys, merge
from peerscore.operators.quality import gold_checks, require, silver_checks
from peerscore.operators.scoring import score_places
from peerscore.operators.silver import RULES, clean, first_version
from peerscore.session import scratch_path, scratch_scope
from peerscore.sources.arrays import read_arrays
from peerscore.sources.bronze import checked_date, read_bronze
from peerscore.sources.catalog import ensure_database, publish_all
from peerscore.sources.versions import VersionedTable

log = logging.getLogger(__name__)

SCORED = "scored_places"
UNQUALIFIED = "unqualified_places"


class CorruptInput(RuntimeError):
    pass


class MissingLayer(RuntimeError):
    pass


@dataclass(frozen=True)
class PipelineConfig:
    bronze_path: str
    silver_path: str
    gold_path: str
    run_date: str = field(default_factory=lambda: date.today().isoformat())
    database: str | None = None
    database_location: str | None = None
    multi_line: bool = False
    policy: str = BATCH_WINS
    keep_versions: int = 2
    silver_buckets: int = 0

    def __post_init__(self):
        for name in ("bronze_path", "silver_path", "gold_path"):
            if not getattr(self, name) or "None" in getattr(self, name).split("/"):
                raise ValueError(f"{name} is not set: {getattr(self, name)!r}")
        checked_date(self.run_date)


@dataclass
class PipelineReport:
    rows: dict[str, int] = field(default_factory=dict)
    dropped: dict[str, int] = field(default_factory=dict)


def write_batch(bronze: DataFrame, run_date: str, path: str) -> tuple[DataFrame, dict]:
    """Clean one snapshot into a stored batch in a single pass, which also counts its rows."""
    seen = Observation()
    rows = clean(bronze, run_date, seen)
    rows.write.parquet(path)
    if seen.get["corrupt"]:
        raise CorruptInput(f"{seen.get['corrupt']} raw records do not parse; nothing was merged")
    return bronze.sparkSession.read.schema(rows.schema).parquet(path), seen.get


def next_silver(silver: VersionedTable, batch: DataFrame, policy: str = BATCH_WINS) -> DataFrame:
    """The silver rows after a stored batch; without a current version it is the first run."""
    history = silver.read()
    if history is None:
        check_keys(batch)
        return first_version(batch)
    return merge(history, batch, policy=policy, full_outer=silver.is_aligned())


@dataclass
class Stored:
    path: str
    rows: DataFrame
    seen: dict


def _store(
    write: Callable[[DataFrame], str], read: Callable[[str], DataFrame], df: DataFrame,
    *metrics: Column,
) -> Stored:
    """Write a table, count its rows on the way, and read it back."""
    seen = Observation()
    path = write(df.observe(seen, F.count("*").alias("rows"), *metrics))
    return Stored(path, read(path), seen.get)


def _silver(spark: SparkSession, cfg: PipelineConfig) -> VersionedTable:
    return VersionedTable(spark, cfg.silver_path, cfg.silver_buckets)


def build_silver(spark: SparkSession, cfg: PipelineConfig) -> PipelineReport:
    """Clean the snapshot and merge it; the new version is visible once it has passed its gate."""
    silver = _silver(spark, cfg)
    with scratch_scope(spark):
        read = read_arrays if cfg.multi_line else read_bronze
        bronze = read(spark, cfg.bronze_path)
        batch, counts = write_batch(bronze, cfg.run_date, scratch_path(spark, "batch"))
        places = _store(silver.stage, silver.open, next_silver(silver, batch, cfg.policy))
    require("silver", silver_checks(places.rows))
    silver.promote(places.path)
    return PipelineReport(
        {"bronze": counts["rows"], "batch": counts["kept"], "silver": places.seen["rows"]},
        {rule: counts[rule] for rule in RULES},
    )


def build_gold(spark: SparkSession, cfg: PipelineConfig) -> PipelineReport:
    """Score the current silver version; both tables pass their gate, then are visible together."""
    places = _silver(spark, cfg).read()
    if places is None:
        raise MissingLayer(f"no silver version at {cfg.silver_path}")
    gold = VersionedTable(spark, cfg.gold_path)
    version = gold.next_path()
    other = F.count_if(F.col("category") == "other").alias("other")
    with scratch_scope(spark):
        scored, unqualified = score_places(places)
        tables = {
            name: _store(partial(gold.stage_part, version, name), spark.read.parquet, df, other)
            for name, df in {SCORED: scored, UNQUALIFIED: unqualified}.items()
        }
    rows = {name: stored.seen["rows"] for name, stored in tables.items()}
    others = sum(stored.seen["other"] for stored in tables.values())
    if others:
        log.warning("%d places are neither cafe nor bakery", others)
    require("gold", gold_checks(tables[SCORED].rows, tables[UNQUALIFIED].rows))
    gold.promote(version)
    # Places with a NULL review count or district are in neither gold table.
    return PipelineReport(rows, {"neither_gold_table": places.count() - sum(rows.values())})


def publish_current(spark: SparkSession, cfg: PipelineConfig) -> dict[str, int]:
    """Publish the current gold version; returns the row counts read back."""
    gold = VersionedTable(spark, cfg.gold_path)
    tables = {name: gold.read_part(name) for name in (SCORED, UNQUALIFIED)}
    if None in tables.values():
        raise MissingLayer(f"no gold version at {cfg.gold_path}")
    ensure_database(spark, cfg.database, cfg.database_location)
    return publish_all(tables, cfg.database)


def run_pipeline(spark: SparkSession, cfg: PipelineConfig) -> PipelineReport:
    """One whole run: silver, gold, and the published tables if a database is named.

    Each stage starts from what the one before made visible, so a failed stage is run again alone.
    """
    report = build_silver(spark, cfg)
    gold = build_gold(spark, cfg)
    if cfg.database:
        publish_current(spark, cfg)
    _silver(spark, cfg).prune(cfg.keep_versions)
    VersionedTable(spark, cfg.gold_path).prune(cfg.keep_versions)
    return PipelineReport(report.rows | gold.rows, report.dropped | gold.dropped)
