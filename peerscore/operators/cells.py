"""Split a box into the fewest cells of a quadtree of which none holds more than a search returns.

A place's cell on the deepest level is a Morton number: the bits of its row and column, interleaved.
Cutting two bits off gives the cell around it, so counts are rolled up level by level from one row
per deepest cell, and never by reading the places again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerscore.operators.tiles import RESULT_CAP, Grid
from peerscore.session import is_small, settle

#: Halvings of the box at most. Places that share a cell there are not told apart.
DEPTH = 12
# Masks that spread the low 32 bits of a number to its even bits.
_SPREAD = (
    (16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333), (1, 0x5555555555555555),
)


def _spread(number: Column) -> Column:
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def _step(value: Column, low: float, high: float, depth: int) -> Column:
    """Number of the strip that a coordinate falls into; the box's far edge is in the last one."""
    if low == high:
        return F.lit(0).cast("long")
    strip = F.floor((value - F.lit(low)) / F.lit(high - low) * F.lit(float(1 << depth)))
    return F.least(strip, F.lit((1 << depth) - 1)).cast("long")


def with_cell(places: DataFrame, grid: Grid, depth: int = DEPTH) -> DataFrame:
    """The places inside the box, edges included, with ``cell``, the Morton number on that level.

    Places without coordinates, or with NaN, are in no box.
    """
    if not 0 <= depth <= 31:
        raise ValueError(f"depth must be 0 to 31, got {depth}")
    lat, lon = F.col("latitude"), F.col("longitude")
    inside = lat.between(grid.min_lat, grid.max_lat) & lon.between(grid.min_lon, grid.max_lon)
    row = _spread(_step(lat, grid.min_lat, grid.max_lat, depth))
    column = _spread(_step(lon, grid.min_lon, grid.max_lon, depth))
    return places.filter(inside).withColumn("cell", F.shiftleft(row, 1).bitwiseOR(column))


def leaves(
    places: DataFrame, grid: Grid, cap: int = RESULT_CAP, depth: int = DEPTH
) -> DataFrame:
    """(level, cell, members): the fewest cells that hold all places of the box, ``cap`` at most each.

    A cell is a leaf if it holds at most ``cap`` places and the cell around it holds more, or if it
    is the whole box. Cells without a place are not listed. On level ``depth`` a cell is a leaf
    however many places it holds: copies on one spot end there, and ``members`` tells.
    """
    deepest = with_cell(places, grid, depth).groupBy("cell").agg(F.count("*").alias("members"))
    counts, _ = settle(deepest)
    found = []
    for level in range(depth, 0, -1):
        # The four cells of one cell around them meet in one task; theirs is the only shuffle.
        around = F.shiftright("cell", 2)
        known = counts.withColumn("around", around).withColumn(
            "together", F.sum("members").over(W.partitionBy("around"))
        )
        small = F.lit(True) if level == depth else F.col("members") <= cap
        found.append(
            known.filter(small & (F.col("together") > cap))
            .select(F.lit(level).alias("level"), "cell", "members")
        )
        # Above, only the sum counts, once per cell.
        counts, _ = settle(
            known.groupBy(F.col("around").alias("cell")).agg(F.sum("members").alias("members"))
        )
    whole = F.lit(True) if depth == 0 else F.col("members") <= cap
    found.append(counts.filter(whole).select(F.lit(0).alias("level"), "cell", "members"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


def _gathered(number: Column) -> Column:
    """The even bits of a number, closed up."""
    number = number.bitwiseAND(F.lit(_SPREAD[-1][1]))
    masks = [m for _, m in _SPREAD[-2::-1]] + [0x00000000FFFFFFFF]
    for (shift, _), mask in zip(_SPREAD[::-1], masks, strict=True):
        number = number.bitwiseOR(F.shiftright(number, shift)).bitwiseAND(F.lit(mask))
    return number


def with_box(cells: DataFrame, grid: Grid) -> DataFrame:
    """Cells with the edges of their boxes: south, west, north, east."""
    parts = F.expr("shiftleft(1L, level)")
    row, column = _gathered(F.shiftright("cell", 1)), _gathered(F.col("cell"))

    def edge(low: float, high: float, step: Column) -> Column:
        return F.lit(low) + F.lit(high - low) * step / parts

    return cells.withColumns({
        "south": edge(grid.min_lat, grid.max_lat, row), "west": edge(grid.min_lon, grid.max_lon, column),
        "north": edge(grid.min_lat, grid.max_lat, row + 1),
        "east": edge(grid.min_lon, grid.max_lon, column + 1),
    })


def leaf_of_each(
    places: DataFrame, grid: Grid, found: DataFrame, depth: int = DEPTH
) -> DataFrame:
    """The places of the box with the ``level`` and ``cell`` of their leaf.

    A place names its cells on all levels that have leaves, and exactly one of them is a leaf. The
    leaves travel to the places if they were measured to be small.
    """
    kept, seen = settle(found.select("level", "cell"))
    levels = [r["level"] for r in kept.select("level").distinct().collect()]
    candidates = F.explode(F.array(*(
        F.struct(F.lit(n).alias("level"), F.shiftright("deepest", 2 * (depth - n)).alias("cell"))
        for n in sorted(levels)
    ))) if levels else None
    located = with_cell(places, grid, depth).withColumnRenamed("cell", "deepest")
    if candidates is None:  # no leaf, so no place
        return located.limit(0).select(*places.columns, F.lit(0).alias("level"), F.col("deepest").alias("cell"))
    each = located.withColumn("at", candidates).select(*places.columns, "at.level", "at.cell")
    return each.join(F.broadcast(kept) if is_small(seen) else kept, ["level", "cell"], "left_semi")
