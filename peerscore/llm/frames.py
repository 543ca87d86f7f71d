"""Small helpers on DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType


def schema_with(df: DataFrame, **kinds: str) -> StructType:
    """The schema of a table with further nullable columns of these SQL types."""
    more = [StructField(name, DataType.fromDDL(kind)) for name, kind in kinds.items()]
    return StructType([*df.schema.fields, *more])


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id is in no fold."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))
