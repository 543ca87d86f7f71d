"""From landed search answers to an immutable snapshot without repeated places."""

from __future__ import annotations

from pyspark.sql import SparkSession

from peerscore.operators.tiles import first_found
from peerscore.session import scratch_path
from peerscore.sources import files
from peerscore.sources.bronze import explode_responses, land_snapshot, read_answers


def land_answers(spark: SparkSession, answers_path: str, root: str, run_date: str) -> str:
    """Unpack every answer, keep each place as its first tile found it, and land the snapshot.

    Answers hold the same place again wherever circles overlap. The places are stored before they
    are landed, so an answer that does not parse leaves no half-written snapshot behind.
    """
    found = first_found(explode_responses(read_answers(spark, answers_path)), "id")
    path = scratch_path(spark, "places")
    try:
        found.write.parquet(path)
        return land_snapshot(spark.read.schema(found.schema).parquet(path), root, run_date)
    finally:
        files.remove(spark, path)
