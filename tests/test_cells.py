"""The fewest cells that no search cuts, against splitting from the top."""

import random

import pytest

from peerscore.operators import cells
from peerscore.operators.tiles import Grid

BOX = Grid(min_lat=10.0, max_lat=12.0, min_lon=-1.0, max_lon=3.0)
SCHEMA = "place_id string, latitude double, longitude double, level string"


def points():
    rng = random.Random(1)
    made = [(rng.uniform(10, 12), rng.uniform(-1, 3)) for _ in range(150)]
    made += [(rng.gauss(10.2, 0.02), rng.gauss(2.9, 0.02)) for _ in range(150)]
    made += [(11.0, 1.0)] * 9 + [(12.0, 3.0), (10.0, -1.0), (12.0, -1.0), (10.0, 3.0), (11.0, 3.0)]
    made += [(None, 1.0), (11.0, None), (float("nan"), 1.0), (9.999, 1.0), (11.0, 3.001)]
    return [(f"p{i}", *at, "own") for i, at in enumerate(made)]


def split(inside, box, cap, depth, level=0, y=0, x=0):
    if not inside:
        return []
    if len(inside) <= cap or level == depth:
        return [(level, y, x, sorted(p for p, _, _ in inside))]
    found = []
    for dy in (0, 1):
        for dx in (0, 1):
            at = 2 * y + dy, 2 * x + dx
            part = [
                p for p in inside
                if (p[1] >> (depth - level - 1), p[2] >> (depth - level - 1)) == at
            ]
            found += split(part, box, cap, depth, level + 1, *at)
    return found


def brute(rows, cap, depth):
    last, inside = (1 << depth) - 1, []
    for place_id, lat, lon, _ in rows:
        if lat is not None and lon is not None and 10 <= lat <= 12 and -1 <= lon <= 3:
            y = min(int((lat - 10) / 2 * 2.0**depth), last)
            x = min(int((lon + 1) / 4 * 2.0**depth), last)
            inside.append((place_id, y, x))
    return split(inside, BOX, cap, depth)


@pytest.mark.parametrize(("cap", "depth"), [(15, 8), (4, 5), (1000, 5), (3, 0)])
def test_leaves_equal_splitting_from_the_top(spark, cap, depth):
    places = spark.createDataFrame(points(), SCHEMA)
    found = cells.leaves(places, BOX, cap, depth)
    expected = brute(points(), cap, depth)
    boxes = {
        (r["level"], round((r["south"] - 10) / 2 * 2 ** r["level"]), round((r["west"] + 1) / 4 * 2 ** r["level"]),
         r["members"])
        for r in cells.with_box(found, BOX).collect()
    }
    assert boxes == {(level, y, x, len(of)) for level, y, x, of in expected}
    crowded = [len(of) for level, _, _, of in expected if len(of) > cap]
    assert all(level == depth for level, _, _, of in expected if len(of) > cap)
    assert (max(crowded) >= 9) == (cap < 9) if crowded else cap >= 9
    members = {}
    for r in cells.leaf_of_each(places.drop("level"), BOX, found, depth).collect():
        members.setdefault((r["level"], r["cell"]), []).append(r["place_id"])
    assert sorted(sorted(x) for x in members.values()) == sorted(of for *_, of in expected)


def test_no_places_no_leaves(spark):
    none = spark.createDataFrame([], "place_id string, latitude double, longitude double")
    found = cells.leaves(none, BOX)
    assert found.count() == 0
    assert cells.leaf_of_each(none, BOX, found).count() == 0


def test_a_box_without_extent(spark):
    spot = Grid(min_lat=1.0, max_lat=1.0, min_lon=2.0, max_lon=2.0)
    places = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0)], "place_id string, latitude double, longitude double")
    assert [tuple(r) for r in cells.leaves(places, spot, 1, 3).collect()] == [(3, 0, 2)]
    with pytest.raises(ValueError, match="depth"):
        cells.leaves(places, spot, 1, 40)
