"""Tile a box with search circles, assign places to tiles, and merge the overlapping results.

A tile is named by its row ``i`` (south to north) and its column ``j`` (west to east). Everything
about a tile follows from (i, j) by arithmetic, so places find their tiles without a join.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import floor, isfinite

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerscore.functions import metres_between
from peerscore.functions.geo import METRES_PER_DEGREE_LAT
from peerscore.schemas import SEARCH_TYPES
from peerscore.session import settle

# Step between centres in radii, results per search, searched types.
STEP_IN_RADII = 1.5
RESULT_CAP = 15


@dataclass(frozen=True)
class Grid:
    """Circle centres over a box, both edges included. The default box is the inner city."""

    min_lat: float = 13.65
    max_lat: float = 13.85
    min_lon: float = 100.45
    max_lon: float = 100.65
    radius_m: float = 700.0

    def __post_init__(self):
        edges = (self.min_lat, self.max_lat, self.min_lon, self.max_lon, self.radius_m)
        if not all(isfinite(e) for e in edges) or self.radius_m <= 0:
            raise ValueError(f"not a grid: {self}")
        if self.min_lat > self.max_lat or self.min_lon > self.max_lon:
            raise ValueError(f"empty box: {self}")

    @property
    def lat_step(self) -> float:
        return self.radius_m * STEP_IN_RADII / METRES_PER_DEGREE_LAT

    @property
    def last_row(self) -> int:
        return floor((self.max_lat - self.min_lat) / self.lat_step)

    def lat(self, i: Column) -> Column:
        return F.lit(self.min_lat) + i * F.lit(self.lat_step)

    def lon_step(self, i: Column) -> Column:
        """Degrees of longitude shrink away from the equator."""
        return F.lit(self.lat_step) / F.cos(F.radians(self.lat(i)))

    def lon(self, i: Column, j: Column) -> Column:
        return F.lit(self.min_lon) + j * self.lon_step(i)

    def last_column(self, i: Column) -> Column:
        return F.floor(F.lit(self.max_lon - self.min_lon) / self.lon_step(i)).cast("int")


def bounding_grid(places: DataFrame, radius_m: float = 700.0) -> Grid:
    """The grid over the box that holds every place."""
    box = places.agg(
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_lon"), F.max("longitude").alias("max_lon"),
    ).first()
    if box["min_lat"] is None:
        raise ValueError("no place has coordinates")
    return Grid(**box.asDict(), radius_m=radius_m)


def tiles(spark: SparkSession, grid: Grid) -> DataFrame:
    """All tiles of the grid: i, j, lat, lon."""
    i, j = F.col("i"), F.col("j")
    rows = spark.range(grid.last_row + 1).select(F.col("id").cast("int").alias("i"))
    return rows.select(
        "i", F.explode(F.sequence(F.lit(0), grid.last_column(i))).alias("j")
    ).select("i", "j", grid.lat(i).alias("lat"), grid.lon(i, j).alias("lon"))


def _first_row(grid: Grid) -> Column:
    return F.floor((F.col("latitude") - grid.min_lat) / grid.lat_step).try_cast("int")


def _first_column(grid: Grid, i: Column) -> Column:
    return F.floor((F.col("longitude") - grid.min_lon) / grid.lon_step(i)).try_cast("int")


def _is_tile(grid: Grid, i: Column, j: Column) -> Column:
    return (i >= 0) & (i <= grid.last_row) & (j >= 0) & (j <= grid.last_column(i))


def _distance(grid: Grid, i: Column, j: Column) -> Column:
    return metres_between(F.col("latitude"), F.col("longitude"), grid.lat(i), grid.lon(i, j))


def _in_band(grid: Grid, i: Column) -> Column:
    """No circle reaches further north or south than its radius; 111 km is less than a degree."""
    return F.abs(F.col("latitude") - grid.lat(i)) <= grid.radius_m / 111_000


def _reached(grid: Grid, i: Column, j: Column) -> Column:
    is_row = (i >= 0) & (i <= grid.last_row)
    return is_row & _in_band(grid, i) & (_distance(grid, i, j) <= grid.radius_m)


def tile_members(places: DataFrame, grid: Grid) -> DataFrame:
    """(place, tile) pairs where the place lies within the tile's circle.

    The radius is smaller than the step, so only the two rows and two columns around a place can
    reach it: four candidates by arithmetic, then the exact distance. No join, no shuffle.
    """
    i, j = F.col("i"), F.col("j")
    on_rows = places.withColumn("_i", _first_row(grid)).select(
        *places.columns, F.explode(F.array(F.col("_i"), F.col("_i") + 1)).alias("i")
    )
    on_tiles = on_rows.filter(_in_band(grid, i)).withColumn("_j", _first_column(grid, i)).select(
        *places.columns, "i", F.explode(F.array(F.col("_j"), F.col("_j") + 1)).alias("j")
    )
    return (
        on_tiles.filter(_is_tile(grid, i, j))
        .withColumn("distance_m", _distance(grid, i, j))
        .filter(F.col("distance_m") <= grid.radius_m)
    )


def uncovered(places: DataFrame, grid: Grid) -> DataFrame:
    """Places outside every circle, decided on the place's own row, without a join.

    In each of the two tile rows around a place, the nearest column is the one to test. The
    one-element explode keeps the optimizer from copying the distances into the filter, past the
    size the JVM compiles.
    """
    def nearest_column(i: Column) -> Column:
        steps = F.round((F.col("longitude") - grid.min_lon) / grid.lon_step(i)).try_cast("int")
        return F.greatest(F.least(steps, grid.last_column(i)), F.lit(0))

    rows = {up: F.col("_i") + up for up in (0, 1)}
    cells = places.withColumn("_i", _first_row(grid)).withColumns(
        {f"_j{up}": nearest_column(i) for up, i in rows.items()}
    )
    covered = [F.coalesce(_reached(grid, i, F.col(f"_j{up}")), F.lit(False)) for up, i in rows.items()]
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    return (
        cells.filter(located)
        .select(*places.columns, F.explode(F.array(covered[0] | covered[1])).alias("_covered"))
        .filter(~F.col("_covered"))
        .drop("_covered")
    )


def of_types(members: DataFrame, types: tuple[str, ...] = SEARCH_TYPES) -> DataFrame:
    """Only places with one of the searched types."""
    return members.filter(F.arrays_overlap("place_types", F.array(*map(F.lit, types))))


def search_results(members: DataFrame, cap: int = RESULT_CAP) -> DataFrame:
    """The ``cap`` nearest places of each tile, ranked from 1; ties go by place id.

    Every task keeps at most ``cap`` places per tile before the shuffle, so a crowded tile is
    never gathered whole.
    """
    nearest = W.partitionBy("i", "j").orderBy("distance_m", "place_id")
    return members.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= cap)


def first_found(results: DataFrame, key: str = "place_id") -> DataFrame:
    """One row per place id, from the first tile that holds it; rows without an id are dropped.

    Within a tile the first by rank counts, or the nearest if the rows have no rank. Only the first
    row of an id leaves each task, so a repeated id stays cheap.
    """
    within = "rank" if "rank" in results.columns else "distance_m"
    order = W.partitionBy(key).orderBy("i", "j", within)
    return (
        results.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        .withColumn("_nth", F.row_number().over(order))
        .filter(F.col("_nth") == 1)
        .drop("_nth")
    )


def sweep_stats(spark: SparkSession, grid: Grid, results: DataFrame) -> DataFrame:
    """Per tile: places found, new places, and the running total of places in tile order.

    ``results`` should be a stored table, of all members of the tiles. A tile without any stays in the sweep with zeros. The running total adds up whole rows
    first and then the tiles of one row, so no window holds more than one row of tiles.
    """
    returned = results.groupBy("i", "j").agg(F.count("*").alias("returned"))
    new = first_found(results).groupBy("i", "j").agg(F.count("*").alias("new"))
    counted, _ = settle(
        tiles(spark, grid)
        .join(returned, ["i", "j"], "left")
        .join(new, ["i", "j"], "left")
        .fillna(0, ["returned", "new"])
    )
    south = W.orderBy("i").rowsBetween(W.unboundedPreceding, -1)
    below = counted.groupBy("i").agg(F.sum("new").alias("_row_new")).select(
        "i", F.coalesce(F.sum("_row_new").over(south), F.lit(0)).alias("_below")
    )
    west = W.partitionBy("i").orderBy("j").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        counted.join(below, "i")
        .withColumn("total", F.col("_below") + F.sum("new").over(west))
        .select("i", "j", "lat", "lon", "returned", "new", "total")
    )


def sweep_gaps(spark: SparkSession, grid: Grid, results: DataFrame, cap: int = RESULT_CAP) -> DataFrame:
    """Tiles without a member, and crowded ones, of whose members a search returns only ``cap``."""
    returned = results.groupBy("i", "j").agg(F.count("*").alias("returned"))
    status = F.when(F.col("returned") == 0, "empty").when(F.col("returned") > cap, "crowded")
    return (
        tiles(spark, grid)
        .join(returned, ["i", "j"], "left")
        .fillna(0, ["returned"])
        .select("i", "j", "returned", status.alias("status"))
        .filter(F.col("status").isNotNull())
    )
