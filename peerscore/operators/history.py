"""What changed between snapshots: the states of every place, from when to when each one held."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from peerscore.operators.merge import DuplicateKeys
from peerscore.session import is_small, settle


def _numbered(rows: DataFrame, key: str, date: str) -> tuple[DataFrame, int]:
    """Rows with ``_n``, their snapshot's number from 1, ``_next``, the date of the one after it,
    and how many snapshots there are."""
    dates, seen = settle(
        rows.groupBy(date).agg(F.count("*").alias("_rows")).filter(F.col(date).isNotNull())
    )
    # One row per snapshot, of which there are as many as runs.
    order = W.orderBy(date)
    ranked = dates.select(date, F.row_number().over(order).alias("_n"), F.lead(date).over(order).alias("_next"))
    return rows.join(F.broadcast(ranked) if is_small(seen) else ranked, date), seen["rows"]


def _same(fields: list[str], other: str) -> Column:
    return reduce(and_, (F.col(f).eqNullSafe(F.col(f"{other}.{f}")) for f in fields), F.lit(True))


def states(
    rows: DataFrame, fields: list[str], key: str = "place_id", date: str = "ingestion_date"
) -> DataFrame:
    """(key, fields, valid_from, valid_to, vanished, changed): one row per state of a place.

    ``rows`` holds whole snapshots, stored, one after the other, told apart by ``date``. A state
    lasts as long as consecutive snapshots hold the place with the same fields; NULL equals NULL.
    ``valid_to`` is the date of the first snapshot that differs, NULL if the state still holds.
    ``vanished`` says that this snapshot does not hold the place at all; if it returns, that is a
    new state, even with the same fields. ``changed`` names the fields that differ from the place's
    state before, empty for one that returns as it was, and NULL for its first state.

    Rows without a key or a date are in no snapshot. A snapshot that repeats a key is refused. A
    place has at most one row per snapshot, so no window is larger than the number of snapshots.
    """
    known, last = _numbered(rows.select(key, date, *fields).filter(F.col(key).isNotNull()), key, date)
    twice = known.groupBy(key, "_n").count().filter("count > 1").first()
    if twice:
        raise DuplicateKeys(f"key {twice[key]!r} occurs {twice['count']} times in one snapshot")
    by_place = W.partitionBy(key).orderBy("_n")
    before = F.lag(F.struct("_n", *fields)).over(by_place)
    runs = (
        known.withColumn("_before", before)
        .withColumn("_goes_on", F.coalesce(
            (F.col("_before._n") == F.col("_n") - 1) & _same(fields, "_before"), F.lit(False)
        ))
        .withColumn("_run", F.count_if(~F.col("_goes_on")).over(by_place.rowsBetween(W.unboundedPreceding, 0)))
    )
    changed = F.when(F.col("_before").isNotNull(), F.filter(
        F.array(*(
            F.when(~F.col(f).eqNullSafe(F.col(f"_before.{f}")), F.lit(f)) for f in fields
        )), lambda name: name.isNotNull()
    ))
    # The rows of a place are in one task already; a run's first row has what it began with.
    held = runs.withColumn("_changed", changed).groupBy(key, "_run").agg(
        *(F.min_by(f, "_n").alias(f) for f in fields),
        F.min(date).alias("valid_from"), F.max_by("_next", "_n").alias("valid_to"),
        F.max("_n").alias("_until"), F.min("_n").alias("_from"), F.min_by("_changed", "_n").alias("changed"),
    )
    after = F.lead("_from").over(W.partitionBy(key).orderBy("_run"))
    gone = (F.col("_until") < last) & ~F.coalesce(after == F.col("_until") + 1, F.lit(False))
    return held.withColumn("vanished", gone).select(
        key, *fields, "valid_from", "valid_to", "vanished", "changed"
    )


def changes_on(found: DataFrame, date: str) -> DataFrame:
    """States that began, ended or vanished on one date: what one snapshot changed."""
    day = F.lit(date).cast("date")
    return found.filter((F.col("valid_from") == day) | (F.col("valid_to") == day))
