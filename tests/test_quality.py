import pytest
from pyspark.sql import functions as F

from peerscore.operators import quality, scoring
from tests.helpers import district, silver_row, silver_table, steps


def outcome(checks):
    return {r["check"]: (r["failed_rows"], r["status"]) for r in checks.collect()}


def failed(checks):
    return {k: n for k, (n, status) in outcome(checks).items() if status == "fail"}


def test_good_silver_passes(spark):
    checks = quality.silver_checks(silver_table(spark, district("A", steps(5))))
    assert len(outcome(checks)) == 7 and failed(checks) == {}
    quality.require("silver", checks)


@pytest.mark.parametrize(("changes", "check"), [
    ({"place_id": None}, "no_null_place_ids"),
    ({"place_id": "A-0"}, "no_duplicate_place_ids"),
    ({"rating": 0.9}, "rating_range"),
    ({"rating": 5.1}, "rating_range"),
    ({"rating": float("nan")}, "rating_range"),
    ({"user_rating_count": 0}, "user_rating_count"),
    ({"province": "Chiang Mai"}, "province_in_region"),
])
def test_each_silver_check_fails_for_its_own_reason(spark, changes, check):
    rows = district("A", steps(5)) + [silver_row("z", **changes) if "place_id" not in changes
                                      else silver_row(**changes)]
    checks = quality.silver_checks(silver_table(spark, rows))
    assert failed(checks) == {check: 1}
    with pytest.raises(quality.GateFailed, match=check) as error:
        quality.require("silver", checks)
    assert error.value.failures == [(check, 1)]


def test_null_ids_count_as_one_distinct_value(spark):
    rows = [silver_row(None), silver_row(None), silver_row("a"), silver_row("a")]
    assert failed(quality.silver_checks(silver_table(spark, rows))) == {
        "no_null_place_ids": 2, "no_duplicate_place_ids": 2,
    }


def test_nulls_pass_the_range_checks_but_not_the_opt_in_ones(spark):
    empty = {"rating": None, "user_rating_count": None, "province": None, "khet": None}
    df = silver_table(spark, [silver_row("a", **empty), silver_row("b")])
    assert failed(quality.silver_checks(df)) == {}
    assert failed(quality.null_checks(df)) == {f"no_null_{c}": 1 for c in empty}


def test_empty_silver_stops_at_the_first_check(spark):
    checks = quality.silver_checks(silver_table(spark, []))
    assert outcome(checks) == {"row_count": (1, "fail")}
    bare = silver_table(spark, []).drop("khet")
    assert outcome(quality.silver_checks(bare)) == {"row_count": (1, "fail")}


def test_missing_columns_stop_the_value_checks(spark):
    df = silver_table(spark, [silver_row()]).drop("khet", "rating")
    assert outcome(quality.silver_checks(df)) == {
        "row_count": (0, "pass"), "required_columns": (2, "fail"),
    }


@pytest.fixture(scope="module")
def gold(spark):
    rows = district("A", steps(6)) + district("B", steps(3)) + [silver_row("low", user_rating_count=1)]
    scored, unqualified = scoring.score_places(silver_table(spark, rows))
    return scored, unqualified


def test_good_gold_passes(gold):
    checks = outcome(quality.gold_checks(*gold))
    assert len(checks) == 7 and {s for _, s in checks.values()} == {"pass"}


def nulled(df, column, where):
    return df.withColumn(column, F.when(~F.expr(where), F.col(column)))


@pytest.mark.parametrize(("damage", "expected"), [
    (lambda s, u: (s.filter("false"), u), {"scored_row_count": 1}),
    (lambda s, u: (nulled(s, "gem_score", "place_id = 'A-0'"), u), {"no_null_gem_score": 1}),
    (lambda s, u: (nulled(s, "khet_median_rating", "place_id < 'A-2'"), u),
     {"no_null_khet_median": 2}),
    (lambda s, u: (s.withColumn("gem_score", F.col("gem_score") + 0.01), u), {"gem_score_math": 6}),
    (lambda s, u: (s, u.withColumn("reason", F.lit("none"))), {"valid_reasons": 4}),
    (lambda s, u: (s, nulled(u, "reason", "place_id = 'low'")), {"no_null_reasons": 1}),
    (lambda s, u: (s, u.withColumn("place_id", F.lit("A-1"))), {"no_place_id_overlap": 1}),
])
def test_each_gold_check_fails_for_its_own_reason(gold, damage, expected):
    assert failed(quality.gold_checks(*damage(*gold))) == expected


def test_score_check_is_skipped_without_scores(gold):
    scored, unqualified = gold
    checks = outcome(quality.gold_checks(nulled(scored, "gem_score", "true"), unqualified))
    assert checks["gem_score_math"] == (None, "skipped")


def test_small_score_differences_pass(gold):
    scored, unqualified = gold
    near = scored.withColumn("gem_score", F.col("gem_score") + 0.0005)
    assert failed(quality.gold_checks(near, unqualified)) == {}


def test_null_ids_overlap(gold):
    scored, unqualified = (df.withColumn("place_id", F.lit(None).cast("string")) for df in gold)
    assert quality.overlap(scored, unqualified).collect()[0]["place_id"] is None
