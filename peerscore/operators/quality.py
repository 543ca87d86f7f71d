"""Quality gates between the layers. Each gate is a table (check, failed_rows, status)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.functions import in_region
from peerscore.schemas import LOW_REVIEWS, RATING_RANGE, REQUIRED_SIGNALS, SILVER, SMALL_DISTRICT

PASS, FAIL, SKIPPED = "pass", "fail", "skipped"


class GateFailed(RuntimeError):
    """Raised to block everything downstream; ``failures`` holds the failed checks."""

    def __init__(self, gate: str, failures: list[tuple[str, int]]):
        super().__init__(f"{gate}: " + ", ".join(f"{c} ({n} rows)" for c, n in failures))
        self.failures = failures


def require(gate: str, checks: DataFrame) -> None:
    """Read the handful of check rows and stop the run if any failed."""
    failures = [(r["check"], r["failed_rows"]) for r in checks.collect() if r["status"] == FAIL]
    if failures:
        raise GateFailed(gate, failures)


def _check_rows(totals: DataFrame, checks: dict[str, tuple[Column, Column | None]]) -> DataFrame:
    """Turn one row of totals into one row per check: (failed rows, condition to run it)."""
    rows = []
    for name, (failed, runs) in checks.items():
        status = F.when(failed > 0, FAIL).otherwise(PASS)
        if runs is not None:
            status = F.when(runs, status).otherwise(SKIPPED)
            failed = F.when(runs, failed)
        rows.append(F.struct(
            F.lit(name).alias("check"),
            failed.cast("long").alias("failed_rows"),
            status.alias("status"),
        ))
    return totals.select(F.inline(F.array(*rows)))


def silver_checks(silver: DataFrame) -> DataFrame:
    """All silver checks in one aggregate.

    An empty table or a missing column stops the later checks, which are then not listed.
    """
    rows, rating, reviews = F.col("rows"), F.col("rating"), F.col("user_rating_count")
    missing = [c for c in SILVER.names if c not in silver.columns]
    found = [F.count("*").alias("rows")]
    checks = {
        "row_count": ((rows == 0).cast("long"), None),
        "required_columns": (F.lit(len(missing)), rows > 0),
    }
    if not missing:
        low, high = RATING_RANGE
        found += [
            F.count_if(F.col("place_id").isNull()).alias("null_ids"),
            F.count_distinct("place_id").alias("ids"),
            F.count_if((rating < low) | (rating > high)).alias("ratings"),
            F.count_if(reviews < 1).alias("reviews"),
            F.count_if(~in_region(F.col("province"))).alias("provinces"),
        ]
        # A NULL id counts as one distinct value.
        distinct = F.col("ids") + (F.col("null_ids") > 0).cast("long")
        checks |= {
            "no_null_place_ids": (F.col("null_ids"), rows > 0),
            "no_duplicate_place_ids": (rows - distinct, rows > 0),
            "rating_range": (F.col("ratings"), rows > 0),
            "user_rating_count": (F.col("reviews"), rows > 0),
            "province_in_region": (F.col("provinces"), rows > 0),
        }
    return _check_rows(silver.agg(*found), checks).filter(F.col("status") != SKIPPED)


def null_checks(silver: DataFrame) -> DataFrame:
    """Opt-in checks that the columns scoring relies on are never NULL.

    The range checks above let a NULL pass, because a comparison with NULL is not true.
    """
    needed = [c for c in REQUIRED_SIGNALS if c not in ("latitude", "longitude")]
    totals = silver.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed])
    return _check_rows(totals, {f"no_null_{c}": (F.col(c), None) for c in needed})


def overlap(scored: DataFrame, unqualified: DataFrame) -> DataFrame:
    """Place ids in both gold tables; NULL ids count as equal.

    One shuffle of the ids, after copies of an id were combined.
    """
    ids = scored.select("place_id", F.lit(True).alias("scored")).unionByName(
        unqualified.select("place_id", F.lit(False).alias("scored"))
    )
    sides = ids.groupBy("place_id").agg(
        F.bool_or("scored").alias("some"), F.bool_and("scored").alias("all")
    )
    return sides.filter(F.col("some") & ~F.col("all")).select("place_id")


def gold_checks(scored: DataFrame, unqualified: DataFrame) -> DataFrame:
    """All gold checks: one aggregate per table and one over the ids of both."""
    score, median = F.col("gem_score"), F.col("khet_median_rating")
    off = F.abs(score - F.round(F.col("rating") - median, 2)) > 0.001
    left = scored.agg(
        F.count("*").alias("scored"),
        F.count_if(score.isNull()).alias("null_scores"),
        F.count_if(median.isNull()).alias("null_medians"),
        F.count_if(off).alias("wrong"),
    )
    reason = F.col("reason")
    right = unqualified.agg(
        F.count_if(~reason.isin(LOW_REVIEWS, SMALL_DISTRICT)).alias("bad_reasons"),
        F.count_if(reason.isNull()).alias("null_reasons"),
    )
    both = overlap(scored, unqualified).agg(F.count("*").alias("overlap"))
    complete = (F.col("null_scores") == 0) & (F.col("null_medians") == 0)
    return (
        _check_rows(left, {
            "scored_row_count": ((F.col("scored") == 0).cast("long"), None),
            "no_null_gem_score": (F.col("null_scores"), None),
            "no_null_khet_median": (F.col("null_medians"), None),
            "gem_score_math": (F.col("wrong"), complete),
        })
        .unionByName(_check_rows(right, {
            "valid_reasons": (F.col("bad_reasons"), None),
            "no_null_reasons": (F.col("null_reasons"), None),
        }))
        .unionByName(_check_rows(both, {"no_place_id_overlap": (F.col("overlap"), None)}))
    )
