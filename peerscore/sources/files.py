"""The few file-system questions a layer needs answered, on any store Spark can reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _open(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; a missing folder is an error."""
    fs, where = _open(spark, path)
    return sorted(status.getPath().getName() for status in fs.listStatus(where))


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty marker file in one atomic step."""
    fs, where = _open(spark, path)
    fs.create(where, True).close()


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _open(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one go; an existing one is replaced."""
    fs, where = _open(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
