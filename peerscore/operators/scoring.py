"""Score each row by its gap to the median of its own group, where the group is large enough."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.functions import category
from peerscore.operators.medians import approx_medians, exact_medians, scale_medians
from peerscore.schemas import (
    GOLD_SCORED,
    GOLD_UNQUALIFIED,
    LOW_REVIEWS,
    MIN_PLACES,
    MIN_REVIEWS,
    SMALL_DISTRICT,
)
from peerscore.session import settle_groups

# How the medians are found: on a fixed scale, for any numbers, or approximately.
MEDIANS: dict[str, Callable[[DataFrame, list[str], str], DataFrame]] = {
    "scale": scale_medians,
    "exact": exact_medians,
    "approx": approx_medians,
}


def add_category(silver: DataFrame) -> DataFrame:
    return silver.withColumn("category", category(F.col("place_types")))


def category_counts(silver: DataFrame) -> DataFrame:
    return add_category(silver).groupBy("category").agg(F.count("*").alias("places"))


def district_stats(
    silver: DataFrame, min_reviews: int = MIN_REVIEWS, method: str = "scale"
) -> DataFrame:
    """Candidate count and median rating per district, from places with enough reviews."""
    candidates = silver.filter(
        (F.col("user_rating_count") >= min_reviews) & F.col("khet").isNotNull()
    )
    return MEDIANS[method](candidates, ["khet"], "rating").select(
        "khet",
        F.col("group_size").alias("khet_candidate_count"),
        F.col("group_median").alias("khet_median_rating"),
    )


def gap(value: Column, median: Column) -> Column:
    return F.round(value - median, 2)


def score_places(
    silver: DataFrame,
    min_reviews: int = MIN_REVIEWS,
    min_places: int = MIN_PLACES,
    method: str = "scale",
) -> tuple[DataFrame, DataFrame]:
    """(scored, unqualified) places.

    ``silver`` should be a stored table: it is read once for the district statistics and once
    for each result. The statistics are settled once and joined to every place, so no place is
    shuffled as long as the measured district table is small enough to broadcast. Beyond that only
    candidates are joined, and only those of districts that are not hot are shuffled. A place whose
    review count is NULL, or a candidate whose district is NULL, is in neither result.
    """
    stats = district_stats(silver, min_reviews, method)
    return score_with(add_category(silver), stats, min_reviews, min_places)


def score_with(
    places: DataFrame,
    stats_rows: DataFrame,
    min_reviews: int = MIN_REVIEWS,
    min_places: int = MIN_PLACES,
) -> tuple[DataFrame, DataFrame]:
    """(scored, unqualified) of places with a category, by the statistics of their districts."""
    stats, _ = settle_groups(stats_rows, ["khet"], "khet_candidate_count")
    candidate = F.col("user_rating_count") >= min_reviews
    trusted = F.col("khet_candidate_count") >= min_places

    scored = (
        stats.filter(trusted).join(places.filter(candidate))
        .withColumn("gem_score", gap(F.col("rating"), F.col("khet_median_rating")))
        .select(*GOLD_SCORED)
    )
    reason = (
        F.when(F.col("user_rating_count") < min_reviews, LOW_REVIEWS)
        .when(candidate & ~trusted, SMALL_DISTRICT)
    )
    unqualified = (
        stats.judge(places, candidate & F.col("khet").isNotNull())
        .withColumn("reason", reason)
        .filter(F.col("reason").isNotNull())
        .select(*GOLD_UNQUALIFIED)
    )
    return scored, unqualified


def small_groups(silver: DataFrame, min_places: int = MIN_PLACES) -> DataFrame:
    """Candidates of districts with too few candidates for a median."""
    small = F.col("khet_candidate_count") < min_places
    stats, _ = settle_groups(
        district_stats(silver).filter(small), ["khet"], "khet_candidate_count"
    )
    candidates = silver.filter(F.col("user_rating_count") >= MIN_REVIEWS)
    return stats.join(candidates).select("place_id", "khet", "khet_candidate_count")


def top_gems(scored: DataFrame, k: int = 20) -> DataFrame:
    """The k places furthest above their district median."""
    return scored.orderBy(F.col("gem_score").desc(), "place_id").limit(k)


def gap_to_group_median(
    df: DataFrame,
    key: str,
    group: str,
    measure: str,
    support: str | None = None,
    min_support: int = MIN_REVIEWS,
    min_group: int = MIN_PLACES,
    method: str = "exact",
) -> DataFrame:
    """The same score over any table: key, group, measure, group size, median, gap and outcome.

    Rows below ``min_support`` do not shape the median, and their group size is NULL. The gap is
    NULL unless the outcome is ``scored``. Rows with a NULL group or support keep a NULL outcome.
    ``df`` is read several times by the exact method; store it if it is dear.
    """
    enough = F.col(support) >= min_support if support else F.lit(True)
    candidates = df.filter(enough & F.col(group).isNotNull())
    stats, _ = settle_groups(
        MEDIANS[method](candidates, [group], measure), [group], "group_size"
    )
    large = F.col("group_size") >= min_group
    outcome = (
        F.when(~enough, "low_support").when(enough & large, "scored")
        .when(enough & ~large, "small_group")
    )
    scored = F.col("outcome") == "scored"
    rows = df.select(key, group, measure, *([support] if support else []))
    return (
        stats.judge(rows, enough & F.col(group).isNotNull())
        .withColumn("outcome", outcome)
        .select(
            key, group, measure, F.when(enough, F.col("group_size")).alias("group_size"),
            F.when(scored, F.col("group_median")).alias("group_median"),
            F.when(scored, gap(F.col(measure), F.col("group_median"))).alias("gap"),
            "outcome",
        )
    )
