"""Quantiles from stored KLL sketches, one per group and date, that merge over any dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.session import settle_groups

#: Size of a sketch. Groups of at most so many values are kept whole.
K = 1024


def rank_error(k: int = K) -> float:
    """How far, as a share of all values, the rank of a quantile may be off: 99 of 100 are nearer."""
    return 2.296 / k**0.9723


def sketch(rows: DataFrame, groups: list[str], measure: str, k: int = K) -> DataFrame:
    """(groups, n, sketch): one row per group, built in part by each task, so no group is gathered.

    NULL and NaN are no values. A group without any has n = 0. Name a date among the groups to
    store one sketch per group and date.
    """
    value = F.nanvl(F.col(measure).cast("double"), F.lit(None).cast("double"))
    return rows.select(*groups, value.alias("_v")).groupBy(*groups).agg(
        F.count("_v").alias("n"), F.kll_sketch_agg_double("_v", k).alias("sketch")
    )


def merge(sketches: DataFrame, groups: list[str], k: int = K) -> DataFrame:
    """Stored sketches as those of coarser groups, such as all dates of a district; no row is read."""
    return sketches.filter("n > 0").groupBy(*groups).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch")
    )


def quantile(rank: float = 0.5) -> Column:
    """A value whose rank is about ``rank``; NULL for a group without values."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(rank)))


def rank_range(rows: DataFrame, groups: list[str], measure: str, estimates: DataFrame) -> DataFrame:
    """(groups, estimate, n, below, up_to): how many values are below an estimate, and up to it.

    ``estimates`` has one row per group with ``estimate`` and ``n``. It travels to the rows if it is
    measured to be small; else only the rows of groups that are not hot are shuffled.
    """
    value = F.col(measure)
    known, _ = settle_groups(estimates.select(*groups, "estimate", F.col("n").alias("_size")), groups, "_size")
    return known.join(rows).groupBy(*groups).agg(
        F.first("estimate").alias("estimate"), F.count(value).alias("n"),
        F.count_if(value < F.col("estimate")).alias("below"),
        F.count_if(value <= F.col("estimate")).alias("up_to"),
    )
