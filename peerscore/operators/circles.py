"""Places within circles of any radii, anywhere on the sphere: across 180 degrees and at the poles.

The sphere is cut into rows of equal height, and each row into cells about as wide as high, fewer
towards the poles. There is one such grid per level, each half as high as the one before. A circle
goes to the level whose rows are just higher than its radius, so it reaches three rows and a few
cells of each; a place is in one cell of every level. Circles and places meet in equal cells.

Whether a place that meets a circle is within it follows from the straight line between them, which
takes no trigonometry; only within a centimetre of the circle the distance itself decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from peerscore.functions import metres_between
from peerscore.functions.geo import EARTH_RADIUS_M
from peerscore.session import HOT_ROWS, is_small, measure, settle

#: Rows on level 0 are half a sphere high; on this one some 30 cm.
LEVELS = 26
#: A circle may reach a quarter of the way around the sphere, less a little.
MOST_M = 9_900_000.0
#: Cells with more places than this are cut into parts of about so many, which circles meet one by one.
PART_PLACES = 512
#: Parts of all cells together, at most; beyond, they are larger.
PARTS = 500_000
#: Nearer to the circle than this, or with a larger longitude, the rounded distance decides.
EDGE_M, MOST_LON = 0.01, 1e6
_CELL = ["_level", "_row", "_column"]
_PART = [*_CELL, "_part"]


def _height(level: Column) -> Column:
    """Degrees of latitude per row."""
    return F.lit(180.0) / F.pow(F.lit(2.0), level)


def _row_of(lat: Column, level: Column) -> Column:
    row = F.floor((lat + F.lit(90.0)) / _height(level))
    last = F.pow(F.lit(2.0), level) - 1
    return F.greatest(F.least(row, last.cast("long")), F.lit(0)).cast("long")


def _columns(row: Column, level: Column) -> Column:
    """Cells of a row: as many as fit into its longer edge, the one nearer to the equator."""
    south = row * _height(level) - F.lit(90.0)
    north = south + _height(level)
    nearest = F.when(south >= 0, south).when(north <= 0, north).otherwise(F.lit(0.0))
    fit = F.floor(F.lit(360.0) * F.cos(F.radians(nearest)) / _height(level))
    return F.greatest(fit, F.lit(1)).cast("long")


def _turned(lon: Column) -> Column:
    """Degrees east of 180 degrees west, from 0 up to 360."""
    return F.pmod(lon + F.lit(180.0), F.lit(360.0))


def _level_of(radius: Column) -> Column:
    """The deepest level whose rows are higher than the radius."""
    degrees = F.degrees(radius / F.lit(EARTH_RADIUS_M)) * 1.000001
    fits = F.floor(F.log2(F.lit(180.0) / degrees)).cast("int")
    return F.greatest(F.least(F.when(radius > 0, fits).otherwise(LEVELS), F.lit(LEVELS)), F.lit(0))


def _known(number: Column) -> Column:
    """A number of which Spark knows that it is not NULL, and so does not test it for each pair."""
    return F.coalesce(number, F.lit(float("nan")))


def _point(lat: Column, lon: Column) -> list[Column]:
    """Where a place is on a sphere of radius 1; NaN if its longitude is too large to tell exactly."""
    turn = F.radians(F.when(F.abs(lon) <= MOST_LON, lon).otherwise(float("nan")))
    flat = F.cos(F.radians(lat))
    return [_known(c) for c in (flat * F.cos(turn), flat * F.sin(turn), F.sin(F.radians(lat)))]


def _line(radius: Column) -> Column:
    """Length of the straight line between two places on that sphere that are so far apart."""
    return F.lit(2.0) * F.sin(radius / F.lit(2.0 * EARTH_RADIUS_M))


def _square(x: Column, y: Column, z: Column, to_x: Column, to_y: Column, to_z: Column) -> Column:
    return (x - to_x) * (x - to_x) + (y - to_y) * (y - to_y) + (z - to_z) * (z - to_z)


def _pointed(circles: DataFrame) -> DataFrame:
    """Circles with their centres on the sphere, and the squares of the lines that are surely within
    (``_near``) and that may be within (``_far``)."""
    radius = F.col("_radius")
    near, far = _line(radius - F.lit(EDGE_M)), _line(radius + F.lit(EDGE_M))
    at = dict(zip(("_cx", "_cy", "_cz"), _point(F.col("_lat"), F.col("_lon")), strict=True))
    lines = {"_near": _known(F.when(radius > EDGE_M, near * near).otherwise(-1.0)), "_far": _known(far * far)}
    given = {c: _known(F.col(c)) for c in ("_lat", "_lon", "_radius")}
    return circles.withColumns(at | lines | given)


def _covered(circles: DataFrame) -> DataFrame:
    """Circles with the cells that they may reach, each cell once.

    What is used more than once has a column of its own, or it would be worked out as often; so would
    it by the filter against empty arrays that Spark puts below a plain explode.
    """
    level, kept = F.col("_level"), circles.columns
    reach = F.degrees(F.col("_radius") / F.lit(EARTH_RADIUS_M)) * 1.000001 + 1e-9
    low, high = F.col("_lat") - F.col("_reach"), F.col("_lat") + F.col("_reach")
    # How far east and west a circle reaches; all around where it holds a pole.
    ratio = F.sin(F.radians("_reach")) / F.cos(F.radians("_lat"))
    around = (low <= -90) | (high >= 90) | (F.col("_ratio") >= 1)
    wide = F.when(around, F.lit(180.0)).otherwise(F.degrees(F.asin("_ratio")) * 1.000001 + 1e-9)
    rows = (
        circles.withColumns({"_level": _level_of(F.col("_radius")), "_reach": reach})
        .withColumns({"_ratio": ratio, "_rows": F.sequence(_row_of(low, level), _row_of(high, level))})
        .withColumns({"_wide": wide, "_east": _turned(F.col("_lon"))})
        .select(*kept, "_level", "_wide", "_east", F.explode_outer("_rows").alias("_row"))
    )
    first = F.floor((F.col("_east") - F.col("_wide")) / F.col("_width")).cast("long")
    steps = F.floor((F.col("_east") + F.col("_wide")) / F.col("_width")).cast("long") - F.col("_first")
    columns = F.sequence("_first", F.col("_first") + F.least(steps, F.col("_count") - 1))
    return (
        rows.withColumn("_count", _columns(F.col("_row"), level))
        .withColumn("_width", F.lit(360.0) / F.col("_count")).withColumn("_first", first)
        .withColumn("_columns", columns)
        .select(*kept, "_level", "_row", "_count", F.explode_outer("_columns").alias("_column"))
        .select(*kept, *_CELL[:2], F.pmod("_column", "_count").alias("_column"))
    )


def _placed(places: DataFrame, levels: list[int]) -> DataFrame:
    """Places with their cell on each of these levels."""
    level = F.col("_level")
    rows = places.withColumn("_level", F.explode(F.array(*map(F.lit, levels)))).withColumn(
        "_row", _row_of(F.col("latitude"), level)
    )
    count = _columns(F.col("_row"), level)
    column = F.floor(_turned(F.col("longitude")) / (F.lit(360.0) / count)).cast("long")
    return rows.withColumn("_column", F.least(column, count - 1))


def _parts_of(crowded: DataFrame, places: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Places of crowded cells by part, and all places with theirs: ``side`` by ``side`` equal parts of
    a cell, -1 if it is not crowded."""
    level, row, column, side = (F.col(c) for c in (*_CELL, "_side"))
    width = F.lit(360.0) / _columns(row, level)

    def strip(along: Column) -> Column:
        return F.greatest(F.least(F.floor(along * side), side - 1), F.lit(0)).cast("long")

    up = strip((F.col("latitude").cast("double") + F.lit(90.0)) / _height(level) - row)
    right = strip(_turned(F.col("longitude").cast("double")) / width - column)
    part = F.when(side.isNotNull(), up * side + right).otherwise(-1)
    few = F.broadcast(crowded.select(*_CELL, "_side"))
    by_part = places.join(few, _CELL).withColumn("_part", part).groupBy(*_PART, "_side").agg(F.count("*").alias("n"))
    every = places.join(few, _CELL, "left").withColumn("_part", part).drop("_side")
    return by_part, every


def _middles(parts: DataFrame) -> DataFrame:
    """Parts with the point in their middle, and the line from there that none of their places exceeds."""
    level, row, column, side = (F.col(c) for c in (*_CELL, "_side"))
    high, wide = _height(level) / side, F.lit(360.0) / _columns(row, level) / side
    up, right = F.floor(F.col("_part") / side), F.pmod(F.col("_part"), side)
    edges = parts.withColumns({
        "_high": high, "_wide": wide, "_south": row * _height(level) - F.lit(90.0) + up * high,
        "_west": (column * side + right) * wide - F.lit(180.0),
    })
    south, north = F.col("_south"), F.col("_south") + F.col("_high")
    nearest = F.when(south >= 0, south).when(north <= 0, north).otherwise(F.lit(0.0))
    lat, lon = south + F.col("_high") / 2, F.col("_west") + F.col("_wide") / 2
    # Haversines of half the height and half the width, this one along the longer edge.
    reach = F.pow(F.sin(F.radians(F.col("_high") / 4)), 2.0) + F.cos(F.radians(lat)) * F.cos(
        F.radians(nearest)
    ) * F.pow(F.sin(F.radians(F.col("_wide") / 4)), 2.0)
    middle = [c.alias(name) for c, name in zip(_point(lat, lon), ("_mx", "_my", "_mz"), strict=True)]
    return edges.select(*_PART, "n", *middle, (F.lit(2.0) * F.sqrt(reach) + 1e-9).alias("_reach"))


def circle_members(
    places: DataFrame, circles: DataFrame, circle: str = "circle_id", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """All columns of places with ``circle``, for each place within a circle, and ``distance_m``.

    ``places`` has latitude and longitude, ``circles`` the column ``circle`` and latitude, longitude
    and radius_m. Latitudes are from -90 to 90; longitudes may be any, 181 is -179. A place on the
    circle counts, and so does one at the centre of a circle of radius 0. Rows without coordinates,
    with NaN, with another latitude, or with a negative radius, meet nothing; a radius of more than
    9,900 km is refused.

    Circles that were measured to be few travel to the places. Otherwise both are shuffled by cell,
    and crowded cells by part, of which a circle meets those that it may reach. But for parts with
    more than ``hot_rows`` places: their circles travel, if those are few. What was measured not to be
    small is never broadcast: Spark's own estimate of it follows from the files that circles and
    places come from, and leaves out that each meets many cells. Parts are few: each stands for many
    places.
    """
    given, seen = settle(
        circles.select(
            F.col(circle), F.col("latitude").cast("double").alias("_lat"),
            F.col("longitude").cast("double").alias("_lon"), F.col("radius_m").cast("double").alias("_radius"),
        ).filter(
            F.col("_lat").between(-90, 90) & F.col("_lon").isNotNull() & ~F.isnan("_lon") & (F.col("_radius") >= 0)
        ),
        F.max("_radius").alias("most"),
    )
    if (seen["most"] or 0) > MOST_M:
        raise ValueError(f"a radius of {seen['most']} m is more than {MOST_M} m")
    cells = _covered(_pointed(given))
    size = measure(cells)
    levels = sorted(r[0] for r in given.select(_level_of(F.col("_radius"))).distinct().collect())
    located = places.filter(
        F.col("latitude").between(-90, 90) & F.col("longitude").isNotNull() & ~F.isnan("longitude")
    )
    made = [c for c in places.columns if c not in (circle, "distance_m")]
    point = _point(F.col("latitude").cast("double"), F.col("longitude").cast("double"))
    pointed = located.select(*made, *(c.alias(name) for c, name in zip(point, ("_px", "_py", "_pz"), strict=True)))
    at = _placed(pointed, levels or [0])
    if is_small(size):
        met = at.join(F.broadcast(cells), _CELL)
    else:
        least = min(PART_PLACES, hot_rows)
        counted = at.groupBy(*_CELL).agg(F.count("*").alias("n")).filter(F.col("n") > least)
        counts, seen = settle(counted, F.sum("n").alias("places"))
        # A cell has at most four times as many parts as it has this many places.
        least = max(least, 4 * (seen["places"] or 0) / PARTS)
        crowded = counts.filter(F.col("n") > least).select(
            *_CELL, F.ceil(F.sqrt(F.col("n") / F.lit(float(least)))).alias("_side")
        )
        by_part, at = _parts_of(crowded, at)
        parts, _ = settle(_middles(by_part))
        hot = parts.filter(F.col("n") > hot_rows).select(*_PART)
        line = F.sqrt(_square(*map(F.col, ("_cx", "_cy", "_cz", "_mx", "_my", "_mz"))))
        # NaN is more than any number, so what has no point meets every part.
        reached = F.sqrt("_far") + F.col("_reach") - line >= 0
        cut = cells.alias("c").join(
            F.broadcast(parts.alias("p")), [F.col(f"c.{c}") == F.col(f"p.{c}") for c in _CELL] + [reached], "left"
        ).select("c.*", F.coalesce("_part", F.lit(-1)).alias("_part"))
        over, over_size = settle(cut.join(F.broadcast(hot), _PART, "left_semi"))
        met = at.join(F.broadcast(hot), _PART, "left_anti").join(cut.hint("merge"), _PART).unionByName(
            at.join(F.broadcast(hot), _PART, "left_semi").join(
                F.broadcast(over) if is_small(over_size) else over.hint("merge"), _PART
            )
        )
    distance = metres_between(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
    square = _square(*map(F.col, ("_px", "_py", "_pz", "_cx", "_cy", "_cz")))
    # The second difference is at least 0 also where it is NaN.
    within = (square < F.col("_near")) | ((F.col("_far") - square >= 0) & (distance <= F.col("_radius")))
    return met.filter(within).select(*made, circle, distance.alias("distance_m"))
