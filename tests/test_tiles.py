import math
import random

import pytest

from peerscore.operators import tiles
from tests.helpers import plan

CITY = tiles.Grid()


def reference_tiles(grid):
    """Accumulated steps, as a plain loop."""
    found, lat = [], grid.min_lat
    while lat <= grid.max_lat:
        lon = grid.min_lon
        while lon <= grid.max_lon:
            found.append((lat, lon))
            lon += grid.lat_step / math.cos(math.radians(lat))
        lat += grid.lat_step
    return found


def metres(lat1, lon1, lat2, lon2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    b = math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
    c = math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6_371_008.8 * math.asin(math.sqrt(a + b * c))


def test_city_grid(spark):
    rows = tiles.tiles(spark, CITY).orderBy("i", "j").collect()
    expected = reference_tiles(CITY)
    assert len(rows) == len(expected) == 462
    for row, (lat, lon) in zip(rows, expected, strict=True):
        assert row["lat"] == pytest.approx(lat, abs=1e-11)
        assert row["lon"] == pytest.approx(lon, abs=1e-11)
        assert CITY.min_lat <= row["lat"] <= CITY.max_lat
        assert CITY.min_lon <= row["lon"] <= CITY.max_lon
    assert len({(round(r["lat"], 6), round(r["lon"], 6)) for r in rows}) == 462


def test_smaller_radius_makes_more_tiles(spark):
    counts = [tiles.tiles(spark, tiles.Grid(radius_m=r)).count() for r in (500.0, 700.0, 1500.0)]
    assert counts == sorted(counts, reverse=True) and len(set(counts)) == 3


def test_single_point_box(spark):
    grid = tiles.Grid(10.0, 10.0, 20.0, 20.0)
    assert [tuple(r) for r in tiles.tiles(spark, grid).collect()] == [(0, 0, 10.0, 20.0)]


@pytest.mark.parametrize("box", [(2.0, 1.0, 0.0, 1.0), (0.0, 1.0, 2.0, 1.0)])
def test_empty_box(box):
    with pytest.raises(ValueError, match="empty box"):
        tiles.Grid(*box)


@pytest.mark.parametrize("radius", [0.0, -1.0, float("nan"), float("inf")])
def test_bad_radius(radius):
    with pytest.raises(ValueError, match="not a grid"):
        tiles.Grid(radius_m=radius)


def scattered(spark, grid, n, seed=5, margin=0.01):
    rng = random.Random(seed)
    rows = [
        (f"p{i:04d}", ["cafe"] if i % 2 else ["food", None],
         rng.uniform(grid.min_lat - margin, grid.max_lat + margin),
         rng.uniform(grid.min_lon - margin, grid.max_lon + margin))
        for i in range(n)
    ]
    # Right on tile centres, and on the borders between cells.
    for i, (lat, lon) in enumerate(reference_tiles(grid)[::40]):
        rows.append((f"c{i}", ["bakery"], lat, lon))
        rows.append((f"d{i}", None, lat + grid.lat_step / 2, lon))
    schema = "place_id string, place_types array<string>, latitude double, longitude double"
    return rows, spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("grid", [
    CITY, tiles.Grid(-0.05, 0.05, -0.05, 0.05), tiles.Grid(60.0, 60.1, 20.0, 20.2, 900.0),
])
def test_members_equal_the_cross_product(spark, grid):
    rows, df = scattered(spark, grid, 300)
    centres = {(r["i"], r["j"]): (r["lat"], r["lon"]) for r in tiles.tiles(spark, grid).collect()}
    expected = {
        (r[0], i, j)
        for r in rows
        for (i, j), (lat, lon) in centres.items()
        if round(metres(r[2], r[3], lat, lon), 3) <= grid.radius_m
    }
    members = tiles.tile_members(df, grid)
    assert {(r["place_id"], r["i"], r["j"]) for r in members.collect()} == expected
    covered = {p for p, _, _ in expected}
    missing = {r["place_id"] for r in tiles.uncovered(df, grid).collect()}
    assert missing == {r[0] for r in rows} - covered
    assert "Exchange" not in plan(members) and "Exchange" not in plan(tiles.uncovered(df, grid))


def test_places_without_coordinates_are_ignored(spark):
    df = spark.createDataFrame(
        [("a", None, 100.5), ("b", 13.7, None), ("c", float("inf"), 100.5), ("d", float("nan"), 1.0)],
        "place_id string, latitude double, longitude double",
    )
    assert tiles.tile_members(df, CITY).count() == 0
    assert {r["place_id"] for r in tiles.uncovered(df, CITY).collect()} <= {"c", "d"}


def test_cap_ties_and_types(spark):
    schema = "place_id string, place_types array<string>, latitude double, longitude double"
    same = [(f"p{i:02d}", ["cafe"] if i else ["food"], CITY.min_lat, CITY.min_lon) for i in range(40)]
    members = tiles.tile_members(spark.createDataFrame(same, schema), CITY)
    results = tiles.search_results(members)
    assert [(r["rank"], r["place_id"]) for r in results.orderBy("rank").collect()] == [
        (i + 1, f"p{i:02d}") for i in range(15)
    ]
    typed = tiles.search_results(tiles.of_types(members))
    assert "p00" not in {r["place_id"] for r in typed.collect()} and typed.count() == 15
    # A crowded tile is cut before the shuffle.
    before_shuffle = plan(results).split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def found(spark, rows):
    return spark.createDataFrame(rows, "place_id string, i int, j int, rank int")


def test_first_tile_wins(spark):
    results = found(spark, [
        ("a", 1, 0, 1), ("a", 0, 5, 2), ("a", 0, 5, 9), ("b", 0, 6, 1), ("b", 0, 5, 7),
        (None, 0, 0, 1), ("", 0, 0, 2),
    ])
    assert sorted(map(tuple, tiles.first_found(results).collect())) == [("a", 0, 5, 2), ("b", 0, 5, 7)]
    assert "WindowGroupLimit" in plan(tiles.first_found(results)).split("Exchange hashpartitioning")[1]


def test_sweep_statistics(spark):
    grid = tiles.Grid(0.0, 0.01, 0.0, 0.02)
    order = [(r["i"], r["j"]) for r in tiles.tiles(spark, grid).orderBy("i", "j").collect()]
    rng = random.Random(2)
    rows = [
        (rng.choice(["", None, *"abcdefghij"]), i, j, rank)
        for i, j in order[::2] for rank in range(1, 5)
    ]
    seen, expected = set(), {}
    for tile in order:
        mine = [r for r in rows if r[1:3] == tile]
        new = {r[0] for r in mine if r[0]} - seen
        seen |= new
        expected[tile] = (len(mine), len(new), len(seen))
    stats = tiles.sweep_stats(spark, grid, found(spark, rows)).collect()
    assert {(r["i"], r["j"]): (r["returned"], r["new"], r["total"]) for r in stats} == expected
    gaps = tiles.sweep_gaps(spark, grid, found(spark, rows), cap=3).collect()
    assert {(r["i"], r["j"]): r["status"] for r in gaps} == {
        t: "crowded" if expected[t][0] else "empty" for t in order
    }


def test_bounding_grid(spark):
    _, df = scattered(spark, CITY, 20)
    grid = tiles.bounding_grid(df)
    assert grid.min_lat < grid.max_lat and grid.min_lon < grid.max_lon
    with pytest.raises(ValueError, match="no place"):
        tiles.bounding_grid(df.filter("false"))
