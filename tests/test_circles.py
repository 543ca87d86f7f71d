"""Circles of any radii against all distances, at the poles and across 180 degrees."""

import math
import random

import pytest
from pyspark.sql import functions as F

from peerscore.functions.geo import EARTH_RADIUS_M
from peerscore.operators import circles as c
from tests.helpers import optimized, plan

PLACES = "place_id int, latitude double, longitude double, radius_m string, distance_m string"
CIRCLES = "circle_id int, latitude double, longitude double, radius_m double"


def metres(a, b):
    lat1, lat2, turn = math.radians(a[0]), math.radians(b[0]), math.radians(b[1] - a[1])
    chord = math.sin((lat2 - lat1) / 2) ** 2 + math.cos(lat1) * math.cos(lat2) * math.sin(turn / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(chord, 1.0)))


def spot(rng):
    kind = rng.randrange(5)
    if kind == 0:
        return rng.uniform(-90, 90), rng.uniform(-180, 180)
    if kind == 1:
        return rng.choice([-1, 1]) * rng.uniform(89, 90), rng.uniform(-180, 180)
    if kind == 2:
        return rng.uniform(-60, 60), rng.choice([-1, 1]) * rng.uniform(179.5, 180)
    if kind == 3:
        return rng.choice([90.0, -90.0, 0.0, 45.0]), rng.choice([-180.0, 180.0, 0.0, 181.0, 540.0])
    return 13.7 + rng.gauss(0, 0.01), 100.5 + rng.gauss(0, 0.01)


def rows():
    rng = random.Random(11)
    places = [(i, *spot(rng), "own", "own") for i in range(600)]
    places += [(900, None, 1.0, "", ""), (901, 1.0, None, "", ""), (902, float("nan"), 1.0, "", ""), (903, 90.5, 0.0, "", "")]
    radii = [0.0, 0.4, 30.0, 700.0, 5_000.0, 120_000.0, 2_000_000.0, 9_900_000.0]
    circles = [(i, *spot(rng), rng.choice(radii)) for i in range(120)]
    circles += [(200, places[3][1], places[3][2], 0.0), (201, 90.0, 12.0, 5e4), (202, -90.0, 0.0, 1e5)]
    circles += [(300, None, 1.0, 5.0), (301, 1.0, None, 5.0), (302, 1.0, 1.0, None), (303, 1.0, 1.0, -1.0)]
    return places, circles


@pytest.mark.parametrize("small", [True, False])
def test_members_equal_all_distances(spark, monkeypatch, small):
    if not small:  # as with more circles than may travel; some cells are hot, and theirs do
        answers = iter([False, True])
        monkeypatch.setattr(c, "is_small", lambda size: next(answers))
    places, circles = rows()
    found = c.circle_members(
        spark.createDataFrame(places, PLACES), spark.createDataFrame(circles, CIRCLES), hot_rows=60
    )
    assert found.columns == ["place_id", "latitude", "longitude", "radius_m", "circle_id", "distance_m"]
    expected, near = set(), set()
    for place_id, lat, lon, *_ in places:
        for circle_id, at, along, radius in circles:
            if None in (lat, lon, at, along, radius) or radius < 0 or not -90 <= lat <= 90:
                continue
            d = metres((lat, lon), (at, along))
            if abs(d - radius) <= 0.002:
                near.add((place_id, circle_id))
            elif d < radius:
                expected.add((place_id, circle_id))
    got = [(r["place_id"], r["circle_id"]) for r in found.collect()]
    assert len(got) == len(set(got)) > 1000
    assert set(got) - near == expected
    assert (3, 200) in set(got)


def test_a_circle_reaches_few_cells(spark):
    _, circles = rows()
    given = spark.createDataFrame(circles, CIRCLES).filter("radius_m >= 0 AND latitude IS NOT NULL")
    cells = c._covered(given.selectExpr("circle_id", "latitude AS _lat", "longitude AS _lon", "radius_m AS _radius"))
    per_circle = cells.groupBy("circle_id").count().collect()
    assert max(r["count"] for r in per_circle) <= 40
    assert cells.count() == cells.distinct().count()


def test_no_circles_no_places(spark):
    places, circles = rows()
    some, none = spark.createDataFrame(places, PLACES), spark.createDataFrame([], CIRCLES)
    assert c.circle_members(some, none).count() == 0
    assert c.circle_members(some.limit(0), spark.createDataFrame(circles, CIRCLES)).count() == 0
    with pytest.raises(ValueError, match="radius"):
        c.circle_members(some, spark.createDataFrame([(1, 0.0, 0.0, 1.5e7)], CIRCLES))


def test_many_circles_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Spark takes the cells for as small as the files that they come from."""
    monkeypatch.setattr(c, "is_small", lambda size: False)
    places, circles = rows()
    spark.createDataFrame(places, PLACES).write.parquet(str(tmp_path / "places"))
    spark.createDataFrame(circles, CIRCLES).write.parquet(str(tmp_path / "circles"))
    found = c.circle_members(spark.read.parquet(str(tmp_path / "places")), spark.read.parquet(str(tmp_path / "circles")))
    joins = [line for line in plan(found).splitlines() if "Join [_level" in line and "Inner" in line]
    assert len(joins) == 2 and all("SortMergeJoin" in line for line in joins)


def brute(places, circles):
    """Pairs by all distances, rounded to the millimetre."""
    return {
        (place_id, circle_id) for place_id, lat, lon, *_ in places for circle_id, at, along, radius in circles
        if None not in (lat, lon, at, along, radius) and radius >= 0 and -90 <= lat <= 90
        and round(metres((lat, lon), (at, along)), 3) <= radius
    }


def pairs(spark, places, circles, **more):
    found = c.circle_members(
        spark.createDataFrame(places, PLACES), spark.createDataFrame(circles, CIRCLES), **more
    ).select("place_id", "circle_id").collect()
    assert len(found) == len(set(found))
    return {tuple(r) for r in found}


@pytest.mark.parametrize(
    ("part_places", "parts", "hot_rows"), [(8, 500_000, 1_000_000), (8, 500, 1_000_000), (4, 500_000, 20)]
)
def test_crowded_cells_are_met_by_part(spark, monkeypatch, part_places, parts, hot_rows):
    """Also at the poles and across 180 degrees, with larger parts where there are many, and hot ones."""
    monkeypatch.setattr(c, "is_small", lambda size: False)
    monkeypatch.setattr(c, "PART_PLACES", part_places)
    monkeypatch.setattr(c, "PARTS", parts)
    places, circles = rows()
    places += [(2000 + i, 13.7, 100.5, "", "") for i in range(30)]  # one spot
    assert pairs(spark, places, circles, hot_rows=hot_rows) == brute(places, circles)


@pytest.mark.parametrize("small", [True, False])
def test_the_rounded_distance_decides_at_the_edge(spark, monkeypatch, small):
    monkeypatch.setattr(c, "is_small", lambda size: small)
    monkeypatch.setattr(c, "PART_PLACES", 4)
    rng = random.Random(5)
    places, circles = [], []
    while len(circles) < 90:
        centre, place = spot(rng), spot(rng)
        if rng.random() < 0.5:
            place = (max(-90.0, min(90.0, centre[0] + rng.gauss(0, 0.001))), centre[1] + rng.gauss(0, 0.001))
        d = metres(centre, place)
        if d < 9e6 and abs(d * 1000 % 1 - 0.5) > 0.2:
            n = len(places)
            places.append((n, *place, "", ""))
            circles += [(3 * n + k, *centre, round(d, 3) + 0.001 * k - 0.001) for k in range(3) if d > 0.002]
    expected = brute(places, circles)
    assert sum((p, 3 * p + 1) in expected for p, *_ in places) > 20
    assert pairs(spark, places, circles) == expected


def test_longitudes_that_went_around_often(spark, monkeypatch):
    places = [(1, 0.0, 3.6e8, "", ""), (2, 0.0, 3.6e8 + 1, "", ""), (3, 0.0, 0.001, "", ""), (4, 0.0, math.inf, "", "")]
    circles = [(1, 0.0, 0.0, 1000.0), (2, 0.0, -7.2e8, 1000.0), (3, 0.0, math.inf, 1000.0)]
    expected = {(1, 1), (1, 2), (3, 1), (3, 2)}
    assert pairs(spark, places, circles) == expected
    monkeypatch.setattr(c, "is_small", lambda size: False)
    monkeypatch.setattr(c, "PART_PLACES", 1)
    assert pairs(spark, places, circles) == expected


@pytest.mark.parametrize("small", [True, False])
def test_distances_are_worked_out_at_the_edge_only(spark, monkeypatch, small):
    monkeypatch.setattr(c, "is_small", lambda size: small)
    monkeypatch.setattr(c, "metres_between", lambda *at: F.raise_error(F.concat_ws(" ", *at)).cast("double"))
    places, circles = rows()
    circles = [r for r in circles if r[3] and r[3] >= 30.0]  # those of radius 0 have places on their edge
    assert len(pairs(spark, places, circles)) > 1000


def test_cells_of_a_circle_are_worked_out_once(spark):
    """Spark would work out what it explodes once per use, and again for a test for empty arrays."""
    _, circles = rows()
    given = spark.createDataFrame(circles, CIRCLES).selectExpr(
        "circle_id", "latitude AS _lat", "longitude AS _lon", "radius_m AS _radius"
    )
    steps = optimized(c._covered(given))
    assert steps.count("sequence(") == 2
    assert steps.count("POWER(") < 20


def test_circles_meet_few_places_outside_of_them(spark, monkeypatch):
    """In a crowded cell, places of parts that a circle doesn't reach don't meet it."""
    monkeypatch.setattr(c, "is_small", lambda size: False)
    monkeypatch.setattr(c, "PART_PLACES", 16)
    rng = random.Random(2)
    places = [(i, rng.uniform(-3, 3), rng.uniform(-3, 3), "", "") for i in range(4000)]
    circles = [(i, rng.uniform(-2, 2), rng.uniform(-2, 2), 110_000.0) for i in range(40)]
    within = pairs(spark, places, circles)
    assert within == brute(places, circles)
    # From here on every pair that meets is within, so what meets is returned. Parts are asked first.
    lines = iter([c._square, lambda *at: F.lit(0.0)])
    monkeypatch.setattr(c, "_square", lambda *at: next(lines)(*at))
    assert len(within) < len(pairs(spark, places, circles)) < 2 * len(within)
