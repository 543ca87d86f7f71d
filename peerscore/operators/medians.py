"""Lower discrete median per group: the ceil(n/2)-th smallest value, an actual element."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

from peerscore.session import HOT_ROWS, Groups, settle, settle_groups

CELLS = 4096
INFINITY = float("inf")


def _rows(df: DataFrame, groups: list[str], measure: str) -> DataFrame:
    """The groups and the measure as _v, in its own type. NaN becomes NULL: it is no value in any
    method. Rows without a group are left out."""
    present = reduce(lambda a, b: a & b, [F.col(g).isNotNull() for g in groups])
    value = F.col(measure)
    if isinstance(df.schema[measure].dataType, (FloatType, DoubleType)):
        value = F.when(~F.isnan(value), value)
    return df.filter(present).select(*groups, value.alias("_v"))


def _running(count: str, groups: list[str], order: str) -> Column:
    rows = W.partitionBy(*groups).orderBy(F.col(order).asc_nulls_first())
    return F.sum(count).over(rows.rowsBetween(W.unboundedPreceding, W.currentRow))


def scale_medians(
    df: DataFrame, groups: list[str], measure: str, most_values: int = HOT_ROWS
) -> DataFrame:
    """Group size and median for a measure on a fixed scale, such as ratings in tenths.

    Rows collapse to (group, value, count) before any shuffle, so a group of any size becomes as
    many rows as it has distinct values. One pass over the input. If a group turns out to have
    more than ``most_values`` distinct values, ``exact_medians`` gives the same result.
    """
    rows = _rows(df, groups, measure)
    counted, _ = settle(rows.groupBy(*groups, "_v").agg(F.count("*").alias("_n")))
    widest = counted.groupBy(*groups).count().agg(F.max("count").alias("widest")).first()["widest"]
    if (widest or 0) > most_values:
        return exact_medians(df, groups, measure)
    return medians_of_counts(counted, groups)


def medians_of_counts(counted: DataFrame, groups: list[str]) -> DataFrame:
    """Group size and median from one row per group and value (_v), with its count (_n)."""
    valued = counted.withColumn("_m", F.when(F.col("_v").isNotNull(), F.col("_n")).otherwise(0))
    total = F.sum("_m").over(W.partitionBy(*groups))
    ranked = valued.select(
        *groups, "_v", "_n", _running("_m", groups, "_v").alias("_upto"), total.alias("_total")
    )
    reached = F.col("_upto") * 2 >= F.col("_total")
    return ranked.groupBy(*groups).agg(
        F.sum("_n").alias("group_size"),
        F.min(F.when(reached, F.col("_v"))).alias("group_median"),
    )


def approx_medians(df: DataFrame, groups: list[str], measure: str, accuracy: int = 10_000) -> DataFrame:
    """Group size and approximate median in one pass, for callers who need no exact value."""
    return _rows(df, groups, measure).groupBy(*groups).agg(
        F.count("*").alias("group_size"),
        F.percentile_approx("_v", 0.5, accuracy).alias("group_median"),
    )


def exact_medians(
    df: DataFrame,
    groups: list[str],
    measure: str,
    cells: int = CELLS,
    open_rows: int = HOT_ROWS,
) -> DataFrame:
    """Group size and exact median for a numeric measure with any number of distinct values.

    Each group keeps a bracket [lo, hi] known to hold its median, and the rank of the median
    inside it. A round counts the values of every wide bracket in cells, with partial counts
    before the shuffle, and narrows the bracket to the cell that holds the rank; no task sees more
    than ``cells`` rows of a group. Rounds go on until no bracket with two different values holds
    more than ``open_rows`` rows, and what is left is ranked as (value, count) rows.

    Cells are equally wide, and as long as a round leaves less than an eighth of the rows, few
    rounds are needed. A bracket that once shrinks less is first split by sign, then into cells
    of equal ratio, and at last, between lo and 2 lo, equally again: with 4096 cells, 1 + 1 + 5
    rounds reach a single value for any doubles. Integers and decimals keep their type: brackets
    and medians are exact, and cells follow from exact differences. NULL and NaN count towards the
    size, not the median. The input is read once a round, so pass a stored table.
    """
    rows = _rows(df, groups, measure)
    kind = rows.schema["_v"].dataType
    values = rows.filter(F.col("_v").isNotNull())

    is_open = F.col("_lo") < F.col("_hi")
    # A difference of the longest decimals is rounded; the few values so close are not narrowed.
    is_wide = is_open & (_apart(F.col("_hi"), F.col("_lo"), kind) > 0)
    widest = F.max(F.when(is_wide, F.col("_inside"))).alias("widest")
    first = rows.groupBy(*groups).agg(
        F.count("*").alias("group_size"),
        F.count("_v").alias("_inside"),
        F.min("_v").alias("_lo"),
        F.max("_v").alias("_hi"),
    ).withColumns({"_rank": F.expr("(_inside + 1) div 2"), "_uneven": F.lit(False)})
    brackets, seen = settle_groups(first, groups, "group_size", widest, hot_rows=open_rows)
    while (seen["widest"] or 0) > open_rows:
        wide = F.coalesce(is_wide & (F.col("_inside") > open_rows), F.lit(False))
        narrowed = _narrow(values, brackets.filter(wide), cells, kind)
        after = brackets.df.filter(~wide).unionByName(narrowed)
        brackets, seen = settle_groups(after, groups, "group_size", widest, hot_rows=open_rows)
    return _finish(values, brackets, is_open)


def _side(value: Column) -> Column:
    """-2, -1, 0, 1, 2 for minus infinity, negative, zero, positive and infinity."""
    sign = F.signum(value).cast("int")
    return F.when(F.abs(value) == INFINITY, sign * 2).otherwise(sign)


def _apart(high: Column, low: Column, kind: DataType) -> Column:
    """high - low as a double, from the exact difference of integers and decimals."""
    inexact = high.cast("double") - low.cast("double")
    if isinstance(kind, (FloatType, DoubleType)):
        return inexact
    if isinstance(kind, DecimalType):
        return F.coalesce(F.try_subtract(high, low).cast("double"), inexact)
    return (high.cast("decimal(20,0)") - low.cast("decimal(20,0)")).cast("double")


def _cell(cells: int, kind: DataType) -> Column:
    """Number of the cell a value falls into; it never decreases as the value grows."""
    lo, hi, value = F.col("_lo"), F.col("_hi"), F.col("_v")
    equal = F.try_divide(_apart(value, lo, kind), _apart(hi, lo, kind))
    lo, hi, value = (x.cast("double") for x in (lo, hi, value))
    ratio = F.try_divide(F.ln(F.abs(value)) - F.ln(F.abs(lo)), F.ln(F.abs(hi)) - F.ln(F.abs(lo)))
    steep = (F.abs(hi) / 2 > F.abs(lo)) | (F.abs(lo) / 2 > F.abs(hi))
    share = F.when(F.col("_uneven") & steep, ratio).otherwise(equal)
    # The difference of the widest doubles overflows; such a bracket is left whole, thus uneven.
    number = F.floor(F.nanvl(F.coalesce(share, F.lit(0.0)), F.lit(0.0)) * cells).cast("int")
    by_sign = F.col("_uneven") & (_side(lo) != _side(hi))
    return F.when(by_sign, _side(value)).otherwise(F.least(number, F.lit(cells - 1)))


def _in_bracket() -> Column:
    return (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))


def _narrow(values: DataFrame, wide: Groups, cells: int, kind: DataType) -> DataFrame:
    """Replace each bracket by the cell that holds its rank; lo and hi become actual values."""
    lo, hi = (F.abs(F.col(c).cast("double")) for c in ("_lo", "_hi"))
    edge = (lo == INFINITY) | (hi == INFINITY)
    cell = _cell(cells, kind).alias("_cell")
    counted = (
        wide.join_hot(values)
        .filter(_in_bracket())
        .withColumn("_uneven", F.col("_uneven") | edge)
        .groupBy(*wide.keys, "group_size", "_rank", "_inside", "_uneven", cell)
        .agg(
            F.count("*").alias("_count"),
            F.min("_v").alias("_lo"),
            F.max("_v").alias("_hi"),
        )
    )
    before = F.col("_upto") - F.col("_count")
    return (
        counted.withColumn("_upto", _running("_count", wide.keys, "_cell"))
        .filter((F.col("_upto") >= F.col("_rank")) & (before < F.col("_rank")))
        .select(
            *wide.keys, "group_size", "_lo", "_hi",
            F.col("_count").alias("_inside"),
            (F.col("_rank") - before).alias("_rank"),
            (F.col("_uneven") | (F.col("_count") * 8 > F.col("_inside"))).alias("_uneven"),
        )
    )


def _finish(values: DataFrame, brackets: Groups, is_open: Column) -> DataFrame:
    counted = (
        brackets.filter(is_open).join(values)
        .filter(_in_bracket())
        .groupBy(*brackets.keys, "_rank", "_v")
        .agg(F.count("*").alias("_count"))
    )
    picked = (
        counted.withColumn("_upto", _running("_count", brackets.keys, "_v"))
        .filter(F.col("_upto") >= F.col("_rank"))
        .groupBy(*brackets.keys)
        .agg(F.min("_v").alias("_picked"))
    )
    if brackets.small:  # at most one row per bracket
        picked = F.broadcast(picked)
    # A closed bracket holds one value; that value is the median.
    return brackets.df.join(picked, brackets.keys, "left").select(
        *brackets.keys, "group_size", F.coalesce("_picked", "_lo").alias("group_median")
    )
