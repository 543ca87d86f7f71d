import random
from datetime import datetime
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from peerscore.operators import medians, scoring
from peerscore.schemas import GOLD_SCORED, GOLD_UNQUALIFIED, LOW_REVIEWS, SMALL_DISTRICT
from peerscore.session import stage
from tests.helpers import district, plan, silver_row, silver_table, steps

METHODS = ["scale", "exact", "approx"]


def test_category(spark):
    expected = [
        (["cafe", "food"], "cafe"), (["bakery"], "bakery"), (["bakery", "cafe"], "cafe and bakery"),
        (["food"], "other"), ([], "other"), (None, "other"), ([None], "other"),
        # Whether a bakery hides behind the NULL type is unknown, so the cafe decides.
        ([None, "cafe"], "cafe"), (["cafe", "bakery", None], "cafe and bakery"),
    ]
    rows = [silver_row(str(i), place_types=types) for i, (types, _) in enumerate(expected)]
    found = scoring.add_category(silver_table(spark, rows)).collect()
    assert {int(r["place_id"]): r["category"] for r in found} == {
        i: category for i, (_, category) in enumerate(expected)
    }


@pytest.mark.parametrize("method", METHODS)
def test_median_is_the_lower_actual_element(spark, method):
    medians_of = {5: 4.2, 6: 4.2, 7: 4.3, 8: 4.3}
    rows = [r for n in medians_of for r in district(f"d{n}", steps(n))]
    scored, unqualified = scoring.score_places(silver_table(spark, rows), method=method)
    found = scored.collect()
    assert scored.columns == GOLD_SCORED and unqualified.columns == GOLD_UNQUALIFIED
    assert {(r["khet"], r["rating"], r["khet_median_rating"], r["gem_score"]) for r in found} == {
        (f"d{n}", rating, median, round(rating - median, 2))
        for n, median in medians_of.items() for rating in steps(n)
    }
    assert unqualified.count() == 0


def test_thresholds_are_inclusive(spark):
    rows = (
        district("Five", steps(5), reviews=5)
        + district("Four", steps(4), reviews=5)
        + [silver_row("low", khet="Five", user_rating_count=4, rating=1.0)]
        + [silver_row("low-small", khet="Four", user_rating_count=4)]
    )
    scored, unqualified = scoring.score_places(silver_table(spark, rows))
    assert {r["khet"] for r in scored.collect()} == {"Five"}
    assert scored.count() == 5
    reasons = {r["place_id"]: r["reason"] for r in unqualified.collect()}
    assert reasons == {
        "low": LOW_REVIEWS, "low-small": LOW_REVIEWS,
        **{f"Four-{i}": SMALL_DISTRICT for i in range(4)},
    }


def test_low_review_places_do_not_shape_the_median(spark):
    rows = district("A", steps(5)) + district("A", [1.0] * 20, reviews=4)
    rows = [{**r, "place_id": str(i)} for i, r in enumerate(rows)]
    stats = scoring.district_stats(silver_table(spark, rows)).collect()
    assert [tuple(r) for r in stats] == [("A", 5, 4.2)]


def test_null_count_or_district_lands_in_neither_table(spark):
    rows = district("A", steps(5)) + [
        silver_row("no-count", khet="A", user_rating_count=None),
        silver_row("no-khet", khet=None),
        silver_row("no-khet-low", khet=None, user_rating_count=1),
    ]
    scored, unqualified = scoring.score_places(silver_table(spark, rows))
    assert scored.count() == 5
    assert [r["place_id"] for r in unqualified.collect()] == ["no-khet-low"]


@pytest.mark.parametrize("method", METHODS)
def test_null_ratings_count_as_candidates_only(spark, method):
    rows = district("A", [3.0, 4.0, 5.0, None, None]) + district("B", [None] * 5)
    stats = scoring.district_stats(silver_table(spark, rows), method=method)
    assert {tuple(r) for r in stats.collect()} == {("A", 5, 4.0), ("B", 5, None)}
    scored, _ = scoring.score_places(silver_table(spark, rows), method=method)
    assert scored.count() == 10


def test_score_is_rounded_half_up(spark):
    rows = district("A", [1.005, 0.0, 0.0, 0.0, 0.0])
    scored, _ = scoring.score_places(silver_table(spark, rows))
    assert max(r["gem_score"] for r in scored.collect()) == 1.01


def test_every_place_in_exactly_one_table(spark):
    rng = random.Random(3)
    rows = [
        silver_row(str(i), khet=f"k{rng.randint(0, 60)}", rating=rng.randint(10, 50) / 10,
                   user_rating_count=rng.randint(0, 9))
        for i in range(600)
    ]
    scored, unqualified = scoring.score_places(silver_table(spark, rows))
    ids = [r[0] for df in (scored, unqualified) for r in df.select("place_id").collect()]
    assert sorted(ids) == sorted(str(i) for i in range(600))
    small = scoring.small_groups(silver_table(spark, rows))
    assert small.count() == unqualified.filter(F.col("reason") == SMALL_DISTRICT).count() > 0


def test_top_gems(spark):
    scored, _ = scoring.score_places(silver_table(spark, district("A", steps(8))))
    assert [r["place_id"] for r in scoring.top_gems(scored, 2).collect()] == ["A-7", "A-6"]
    assert "TakeOrderedAndProject" in plan(scoring.top_gems(scored, 2))


def lower_medians(rows):
    groups = {}
    for group, value in rows:
        groups.setdefault(group, []).append(value)
    found = {}
    for group, every in groups.items():
        valued = sorted(v for v in every if v is not None)
        found[group] = (len(every), valued[(len(valued) - 1) // 2])
    return found


DRAWS = {
    "uniform": lambda rng: rng.uniform(-5, 5),
    "heavy tail": lambda rng: rng.paretovariate(0.2),
    "negative": lambda rng: -rng.paretovariate(0.2),
    "ties": lambda rng: float(rng.randint(0, 3)),
    "tiny and huge": lambda rng: rng.choice([-1, 1]) * 10.0 ** rng.randint(-300, 300),
    "subnormal": lambda rng: 5e-324 * rng.randint(0, 50),
    "widest": lambda rng: rng.choice([-1.7e308, -1.6e308, 1.6e308, 1.7e308, 0.0, -0.0]),
    "neighbours": lambda rng: 1e300 * (1 + rng.randint(0, 9) * 2.0 ** -52),
    "one value": lambda rng: 2.5,
    "infinities": lambda rng: rng.choice([float("-inf"), float("inf"), rng.random()]),
    "nulls": lambda rng: rng.choice([None, rng.random()]),
}


def values(kind, n, seed=1):
    """Groups of one kind of numbers; one of them holds a third of all rows."""
    rng = random.Random(f"{kind}{seed}")
    return [
        (f"{kind} {'hot' if i % 3 == 0 else i % 7}", DRAWS[kind](rng)) for i in range(n)
    ]


def by_group(df):
    return {r["g"]: (r["group_size"], r["group_median"]) for r in df.collect()}


@pytest.mark.parametrize("open_rows", [1, 40, 10**6])
def test_exact_medians_equal_sorting(spark, open_rows):
    rows = [row for kind in DRAWS for row in values(kind, 400)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = medians.exact_medians(df, ["g"], "v", cells=64, open_rows=open_rows)
    assert by_group(found) == lower_medians(rows)
    assert by_group(medians.scale_medians(df, ["g"], "v")) == lower_medians(rows)


@pytest.mark.parametrize(("kind", "bound", "open_rows"), [
    ("uniform", 3, 60), ("uniform", 0, 60), ("uniform", 3, 10**6), ("ties", 3, 60),
])
def test_exact_medians_of_more_groups_than_broadcast(spark, monkeypatch, kind, bound, open_rows):
    monkeypatch.setattr("peerscore.session.BROADCAST_ROWS", bound)
    rows = values(kind, 300)
    df = spark.createDataFrame(rows, "g string, v double")
    found = medians.exact_medians(df, ["g"], "v", cells=8, open_rows=open_rows)
    assert by_group(found) == lower_medians(rows)


@pytest.mark.parametrize("bound", [0, 1, 3])
def test_score_places_of_more_districts_than_broadcast(spark, monkeypatch, bound):
    rows = [r for k in "ABCDEFG" for r in district(k, steps(6))] + district("Hot", steps(10))
    rows += district("Small", steps(2)) + [silver_row("low", khet="Hot", user_rating_count=1)]
    rows += [silver_row("none", khet="Nowhere", user_rating_count=1)]
    expected = [sorted(map(str, df.collect())) for df in scoring.score_places(silver_table(spark, rows))]
    monkeypatch.setattr("peerscore.session.BROADCAST_ROWS", bound)
    monkeypatch.setattr(scoring.settle_groups, "__kwdefaults__", {"hot_rows": 8})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        tables = scoring.score_places(silver_table(spark, rows))
        assert [sorted(map(str, df.collect())) for df in tables] == expected
        # The hot district is broadcast, unless even the hot ones are too many.
        assert ("BroadcastHashJoin" in plan(tables[0])) == (bound > 0)
        assert "SortMergeJoin" in plan(tables[0])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize(("kind", "draw"), [
    ("bigint", lambda rng: 9007199254740993 + rng.randint(0, 400)),
    ("bigint", lambda rng: rng.choice([-(2**63), 2**63 - 1, rng.randint(-9, 9)])),
    ("int", lambda rng: rng.randint(-2**31, 2**31 - 1)),
    ("decimal(38,19)", lambda rng: Decimal(rng.randint(0, 30)).scaleb(-19) + 5),
    ("decimal(38,0)", lambda rng: Decimal(rng.randint(-(10**38) + 1, 10**38 - 1))),
    ("float", lambda rng: float(rng.randint(-64, 64)) / 8),
])
@pytest.mark.parametrize("open_rows", [1, 60])
def test_exact_medians_keep_the_type(spark, kind, draw, open_rows):
    rng = random.Random(4)
    with localcontext(prec=60):
        rows = [("hot" if i % 3 else f"g{i % 5}", draw(rng)) for i in range(300)]
        rows += [("one", rows[0][1])] * 3
        df = spark.createDataFrame(rows, f"g string, v {kind}")
        found = medians.exact_medians(df, ["g"], "v", cells=16, open_rows=open_rows)
        assert found.schema["group_median"].dataType == df.schema["v"].dataType
        assert by_group(found) == lower_medians(rows)
        assert by_group(medians.scale_medians(df, ["g"], "v", most_values=3)) == lower_medians(rows)


@pytest.mark.parametrize("method", METHODS)
def test_nan_is_no_value(spark, method):
    nan = float("nan")
    rows = [("a", x) for x in (1.0, 2.0, 3.0, nan, nan, nan, nan, None)] + [("b", nan)]
    found = scoring.MEDIANS[method](spark.createDataFrame(rows, "g string, v double"), ["g"], "v")
    assert by_group(found) == {"a": (8, 2.0), "b": (1, None)}


def test_groups_of_any_type(spark):
    day, other = datetime(2026, 8, 27, 10), datetime(2026, 8, 28)
    rows = [(i, day, [1, 2], float(i)) for i in range(5)] + [(5, other, [3], 1.0)]
    df = spark.createDataFrame(rows, "id int, t timestamp, a array<int>, v double")
    for group in ("t", "a"):
        found = scoring.gap_to_group_median(df, "id", group, "v").collect()
        assert sorted((r["id"], r["outcome"], r["group_median"]) for r in found)[:5] == [
            (i, "scored", 2.0) for i in range(5)
        ]


def test_rows_that_do_not_count_are_not_shuffled(spark, monkeypatch):
    """A crowded district of low-review places, and rows without a group, stay where they are."""
    rows = [r for k in "ABCDEFG" for r in district(k, steps(6))]
    rows += [silver_row(f"low-{i}", khet="Low", user_rating_count=1) for i in range(400)]
    rows += [silver_row("near", khet="Low")]
    places = stage(silver_table(spark, rows).repartition(8, "place_id"), "silver")
    values = places.select("place_id", F.nullif("khet", F.lit("Low")).alias("khet"), "rating")
    monkeypatch.setattr("peerscore.session.BROADCAST_ROWS", 1)
    monkeypatch.setattr(scoring.settle_groups, "__kwdefaults__", {"hot_rows": 100})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        tables = [
            scoring.score_places(places)[1],
            scoring.gap_to_group_median(values, "place_id", "khet", "rating"),
        ]
        for df, n in zip(tables, (401, 443), strict=True):
            per_task = df.groupBy(F.spark_partition_id()).count().collect()
            assert sum(r["count"] for r in per_task) == n
            assert max(r["count"] for r in per_task) < 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gap_outcomes(spark):
    rows = [(i, "a", float(i), 9) for i in range(5)] + [
        (10, "a", 100.0, 1), (11, "b", 1.0, 9), (12, None, 1.0, 9), (13, "a", 1.0, None),
    ]
    df = spark.createDataFrame(rows, "id int, g string, v double, n int")
    found = {r["id"]: r for r in scoring.gap_to_group_median(df, "id", "g", "v", support="n").collect()}
    assert len(found) == len(rows)
    assert [(found[i]["group_median"], found[i]["gap"]) for i in (0, 4)] == [(2.0, -2.0), (2.0, 2.0)]
    assert {i: found[i]["outcome"] for i in (0, 10, 11, 12, 13)} == {
        0: "scored", 10: "low_support", 11: "small_group", 12: None, 13: None,
    }
    assert found[10]["gap"] is None and found[11]["gap"] is None


def test_scoring_moves_no_place(spark):
    places = stage(silver_table(spark, district("A", steps(6))), "silver")
    scored, unqualified = scoring.score_places(places)
    for df in (scored, unqualified):
        text = plan(df)
        assert "BroadcastHashJoin" in text
        assert "Exchange hashpartitioning" not in text
    assert "GreaterThanOrEqual(user_rating_count,5)" in plan(scored)
    assert "ingestion_date" not in plan(scored)
