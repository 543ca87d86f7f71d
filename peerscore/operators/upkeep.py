"""District medians and scores kept up to date from the rows that a merge changes.

The state of the districts is (khet, rating, places): how many candidates have which rating. A merge
takes rows away and puts rows in; counted with their sign they are folded into the state, so that
medians follow from counts, and neither the history nor an untouched district is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.operators.medians import medians_of_counts
from peerscore.schemas import MIN_PLACES, MIN_REVIEWS


def district_counts(silver: DataFrame, min_reviews: int = MIN_REVIEWS, sign: int = 1) -> DataFrame:
    """(khet, rating, places) of the candidates. Rows without a district are no candidates; NaN and
    NULL ratings are one value, which counts in a district's size and not in its median."""
    rating = F.nanvl("rating", F.lit(None).cast("double")).alias("rating")
    candidates = (F.col("user_rating_count") >= min_reviews) & F.col("khet").isNotNull()
    return silver.filter(candidates).groupBy("khet", rating).agg((sign * F.count("*")).alias("places"))


def fold(*counts: DataFrame) -> DataFrame:
    """Counts added up; values that are no longer there leave no row."""
    every = counts[0]
    for more in counts[1:]:
        every = every.unionByName(more)
    return every.groupBy("khet", "rating").agg(F.sum("places").alias("places")).filter("places <> 0")


def signed_changes(
    before: DataFrame, after: DataFrame, min_reviews: int = MIN_REVIEWS
) -> DataFrame:
    """What replacing some rows by others changes in the state: -1 for each that goes, +1 for each
    that comes. A place that keeps its district, rating and candidacy changes nothing."""
    return fold(district_counts(before, min_reviews, -1), district_counts(after, min_reviews))


def stats_of(state: DataFrame) -> DataFrame:
    """Candidate count and lower discrete median per district, from counts alone."""
    found = medians_of_counts(state.select("khet", F.col("rating").alias("_v"), F.col("places").alias("_n")), ["khet"])
    return found.select(
        "khet", F.col("group_size").alias("khet_candidate_count"),
        F.col("group_median").alias("khet_median_rating"),
    )


def moved(before: DataFrame, after: DataFrame, min_places: int = MIN_PLACES) -> DataFrame:
    """(khet) of districts whose median changed, or that now have enough candidates or no more."""
    def known(stats: DataFrame, name: str) -> DataFrame:
        enough = F.col("khet_candidate_count") >= min_places
        return stats.select("khet", F.struct(enough, F.when(enough, F.col("khet_median_rating"))).alias(name))

    both = known(before, "old").join(known(after, "new"), "khet", "full_outer")
    return both.filter(~F.col("old").eqNullSafe(F.col("new"))).select("khet")
