"""Merge a batch into the accumulated history, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.session import fewer

BATCH_WINS = "batch_wins"
NEWEST_WINS = "newest_wins"


class DuplicateKeys(ValueError):
    pass


def check_keys(df: DataFrame, key: str = "place_id") -> bool:
    """Refuse a table that repeats a key; tell whether its keys are small enough to broadcast.

    One job. Copies of a key are added up before the shuffle, so a hot key stays cheap.
    """
    copies = df.groupBy(key).agg(F.count("*").alias("copies"))
    seen = copies.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 16), F.lit(0)).alias("bytes"),
        F.max(F.struct("copies", key)).alias("most"),
    ).first()
    if seen["rows"] and seen["most"]["copies"] > 1:
        raise DuplicateKeys(f"key {seen['most'][key]!r} occurs {seen['most']['copies']} times")
    return fewer(seen.asDict())


def keys_of(batch: DataFrame, small: bool, key: str = "place_id") -> DataFrame:
    """The keys of a batch, to be joined to. Those that were not measured to be small are shuffled;
    Spark would broadcast them if their files were well compressed."""
    keys = batch.select(key)
    return F.broadcast(keys) if small else keys.hint("merge")


def first_seen(history: DataFrame, batch: DataFrame, key: str = "place_id") -> DataFrame:
    """Earliest date per key over history and batch."""
    return (
        history.select(key, "first_seen_date")
        .unionByName(batch.select(key, F.col("ingestion_date").alias("first_seen_date")))
        .groupBy(key)
        .agg(F.min("first_seen_date").alias("first_seen_date"))
    )


def carried_over(history: DataFrame, batch: DataFrame, key: str = "place_id") -> DataFrame:
    """History rows whose key is absent from the batch."""
    return history.join(keys_of(batch, check_keys(batch, key), key), key, "left_anti")


def merge(
    history: DataFrame,
    batch: DataFrame,
    key: str = "place_id",
    policy: str = BATCH_WINS,
    full_outer: bool = False,
) -> DataFrame:
    """Batch rows replace history rows; the earliest first-seen date is kept; nothing else goes.

    Both inputs should be stored tables with unique, non-null keys: a batch that repeats a key is
    refused. A batch whose keys were measured to be small is broadcast, and the history is not
    shuffled at all; otherwise, or if ``full_outer`` asks for it, one full outer join moves both
    sides once by the key, and not even the history where that is bucketed by the key.
    ``newest_wins`` keeps the history row where it has the later ingestion date.
    """
    if policy not in (BATCH_WINS, NEWEST_WINS):
        raise ValueError(f"unknown policy {policy!r}")
    small = check_keys(batch, key) and not full_outer
    same_key = F.col(f"h.{key}") == F.col(f"n.{key}")
    if not small:
        joined = history.alias("h").join(batch.alias("n"), same_key, "full_outer")
        return _resolve(joined, history.columns, key, policy)

    keys = keys_of(batch, small, key)
    untouched = history.join(keys, key, "left_anti")
    # The history keys are unique, so the matched rows are at most as many as the batch rows.
    matched = history.join(keys, key, "left_semi")
    if policy == NEWEST_WINS:
        joined = batch.alias("n").join(matched.alias("h"), same_key, "left")
        return untouched.unionByName(_resolve(joined, history.columns, key, policy))
    dates = matched.select(key, "first_seen_date")
    updated = batch.join(dates, key, "left").withColumn(
        "first_seen_date", F.least("first_seen_date", "ingestion_date")
    )
    return untouched.unionByName(updated)


def _resolve(joined: DataFrame, columns: list[str], key: str, policy: str) -> DataFrame:
    """Pick each column from the batch (n) or the history (h) side of a joined row."""
    take_batch = F.col(f"n.{key}").isNotNull()
    if policy == NEWEST_WINS:
        older = F.col("n.ingestion_date") < F.col("h.ingestion_date")
        take_batch &= ~F.coalesce(older, F.lit(False))
    picked = []
    for name in columns:
        if name == "first_seen_date":
            # least() skips the NULL of the side that is missing.
            picked.append(F.least("h.first_seen_date", "n.ingestion_date").alias(name))
        else:
            picked.append(
                F.when(take_batch, F.col(f"n.{name}")).otherwise(F.col(f"h.{name}")).alias(name)
            )
    return joined.select(*picked)
