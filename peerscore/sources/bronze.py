"""Raw place snapshots: JSON in, JSON out, one immutable folder per run date."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from peerscore.schemas import BRONZE, CORRUPT
from peerscore.sources import files


# Ends a record where a whole file is one. JSON text in UTF-8 never holds it; other encodings do, and
# give corrupt records.
NEVER = "\0"


def read_bronze(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Raw places with an explicit schema: absent fields are NULL, and no pass infers types.

    JSON Lines files split over many tasks. ``multi_line`` reads files that hold one top-level
    array, one task per file, as single records: Spark's ``multiLine`` opens the file once more for
    every number that is read as text. Such a file has less than 2 GB; ``arrays.read_arrays`` reads
    larger ones. Text that does not parse is kept in the corrupt-record column.
    """
    schema = StructType([*BRONZE.fields, StructField(CORRUPT, StringType())])
    reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", CORRUPT)
    if multi_line:
        reader = reader.option("lineSep", NEVER)
    return reader.json(path)


def write_bronze(df: DataFrame, path: str) -> None:
    """JSON Lines in UTF-8; refuses to touch an existing folder."""
    df.select(*[c for c in BRONZE.names if c in df.columns]).write.mode("errorifexists").json(path)


def snapshot_path(root: str, run_date: str) -> str:
    return f"{root.rstrip('/')}/bronze/{checked_date(run_date).isoformat()}"


def land_snapshot(df: DataFrame, root: str, run_date: str) -> str:
    path = snapshot_path(root, run_date)
    write_bronze(df, path)
    return path


def snapshot_dates(spark: SparkSession, root: str) -> list[str]:
    """Run dates whose snapshot was written to the end, oldest first."""
    base = f"{root.rstrip('/')}/bronze"
    return [d for d in files.names(spark, base) if files.exists(spark, f"{base}/{d}/_SUCCESS")]


def read_snapshot(spark: SparkSession, root: str, run_date: str | None = None) -> DataFrame:
    """A pinned snapshot, or the latest complete one."""
    if run_date is None:
        dates = snapshot_dates(spark, root)
        if not dates:
            raise FileNotFoundError(f"no complete snapshot below {root}")
        run_date = dates[-1]
    return read_bronze(spark, snapshot_path(root, run_date))


def checked_date(text: str) -> date:
    """A run date must be a real date; a bad one stops the run before any work."""
    try:
        return date.fromisoformat(text)
    except ValueError as error:
        raise ValueError(f"run date must be YYYY-MM-DD, got {text!r}") from error


def write_arrays(df: DataFrame, path: str, file: Column) -> None:
    """Files of one top-level JSON array each, for ``read_bronze(multi_line=True)``.

    ``file`` numbers the array that a row goes to. One task holds an array, so keep them small.
    """
    record = F.to_json(F.struct(*[c for c in BRONZE.names if c in df.columns]))
    records = F.array_join(F.collect_list("record"), ",\n")
    (
        df.select(file.alias("file"), record.alias("record")).groupBy("file")
        .agg(F.concat(F.lit("["), records, F.lit("]")).alias("value"))
        .write.mode("errorifexists").partitionBy("file").text(path)
    )


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Landed search answers, JSON Lines of (i, j, places); one that does not parse ends the job."""
    places = ArrayType(BRONZE)
    schema = StructType([
        StructField("i", LongType()), StructField("j", LongType()), StructField("places", places),
    ])
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def explode_responses(responses: DataFrame) -> DataFrame:
    """One row per place of each search response; a missing ``places`` array yields none.

    ``rank`` is the 1-based position inside the response.
    """
    keys = [c for c in responses.columns if c != "places"]
    return responses.select(*keys, F.posexplode("places").alias("pos", "place")).select(
        *keys, (F.col("pos") + 1).alias("rank"), "place.*"
    )
