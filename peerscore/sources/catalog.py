"""Publishing gold tables to the session catalog, replaced in full on every run.

A published name is a view of one immutable table, ``<name>__<time>``. All tables of a run are
written and counted before the first name is pointed at them, so a run that dies while it writes
leaves every name as it was.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{where}")


def _measures(df: DataFrame) -> list[Column]:
    """Number of rows, and two sums over the rows' hashes that do not depend on their order.

    Rows that are swapped for others change both; a row that is doubled while another is lost
    leaves the number alone, two copies of a row cancel out in the xor, and not in the sum.
    """
    row = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    none = F.lit(0).cast("long")
    return [
        F.count("*").alias("rows"), F.coalesce(F.bit_xor(row), none).alias("xor"),
        F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)")).alias("sum"),
    ]


def content(df: DataFrame) -> dict:
    """What a table holds, as three numbers, whatever the order of its rows."""
    return df.agg(*_measures(df)).first().asDict()


def _write(df: DataFrame, database: str, name: str) -> int:
    """Write a new table, and compare what arrived with what was sent, by number and by content."""
    seen = Observation()
    counted = df.observe(seen, *_measures(df))
    counted.write.mode("errorifexists").format("parquet").saveAsTable(f"`{database}`.`{name}`")
    sent, arrived = seen.get, content(df.sparkSession.table(f"`{database}`.`{name}`"))
    if arrived["rows"] != sent["rows"]:
        raise RuntimeError(f"{database}.{name}: sent {sent['rows']} rows, read back {arrived['rows']}")
    if arrived != sent:
        raise RuntimeError(f"{database}.{name}: {sent['rows']} rows arrived, but not the same ones")
    return arrived["rows"]


def _point(spark: SparkSession, database: str, table: str, version: str) -> None:
    name = f"`{database}`.`{table}`"
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # a plain table of an older release
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM `{database}`.`{version}`")


def _versions(spark: SparkSession, database: str, table: str) -> list[str]:
    """Tables that were written for a name, oldest first."""
    names = (t.name for t in spark.catalog.listTables(database))
    return sorted(n for n in names if n.startswith(f"{table}__"))


def publish_all(tables: dict[str, DataFrame], database: str, keep: int = 2) -> dict[str, int]:
    """Replace stored tables together; returns the row counts read back.

    The newest ``keep`` tables of each name stay, for readers that started on the one before.
    """
    spark = next(iter(tables.values())).sparkSession
    time = datetime.now(UTC).strftime("%Y%m%d%H%M%S%f")
    names = {table: f"{table}__{time}" for table in tables}
    try:
        arrived = {table: _write(df, database, names[table]) for table, df in tables.items()}
    except Exception:
        for name in names.values():
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        raise
    for table, name in names.items():
        _point(spark, database, table, name)
        for old in _versions(spark, database, table)[:-keep]:
            spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{old}`")
    return arrived
