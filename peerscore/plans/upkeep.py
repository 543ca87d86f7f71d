"""A weekly run that costs what changed: silver, district counts and gold are kept in parts.

A batch is merged into the parts of silver that its keys fall into. The rows that go and come there
change the counts of their districts; the parts of those districts are the only ones of the state
and of gold that are read or written. All four tables become visible together.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from peerscore.operators.merge import BATCH_WINS, check_keys, keys_of, merge
from peerscore.operators.quality import FAIL, GateFailed, gold_checks, silver_checks
from peerscore.operators.scoring import add_category, score_with
from peerscore.operators.upkeep import fold, moved, signed_changes, stats_of
from peerscore.schemas import GOLD_SCORED, GOLD_UNQUALIFIED, MIN_PLACES, MIN_REVIEWS, SILVER
from peerscore.session import fewer, scratch_scope, settle, stage
from peerscore.sources.parts import Draft, PartStore

SCORED, UNQUALIFIED = "scored_places", "unqualified_places"
KEYS = {"silver": "place_id", "state": "khet", SCORED: "khet", UNQUALIFIED: "khet"}
_COMMON = [c for c in GOLD_SCORED if c in GOLD_UNQUALIFIED]
_STATE = "khet string, rating double, places long"
# An upkeep run may touch no scored place at all.
_MAY_FAIL = {"row_count", "scored_row_count"}


def places_store(spark: SparkSession, root: str, parts: int = 64) -> PartStore:
    return PartStore(spark, root, KEYS, parts)


@dataclass
class UpkeepReport:
    """What a run touched: parts per table, and the districts that were scored again."""

    parts: dict[str, list[int]] = field(default_factory=dict)
    districts: int = 0
    version: str = ""


def _require(gate: str, checks: DataFrame) -> None:
    failed = [
        (r["check"], r["failed_rows"]) for r in checks.collect()
        if r["status"] == FAIL and r["check"] not in _MAY_FAIL
    ]
    if failed:
        raise GateFailed(gate, failed)


def apply_batch(
    store: PartStore,
    batch: DataFrame,
    policy: str = BATCH_WINS,
    min_reviews: int = MIN_REVIEWS,
    min_places: int = MIN_PLACES,
    gates: bool = True,
) -> UpkeepReport:
    """Merge a stored batch and bring the gold tables up to date; they equal those of a full run.

    The first batch makes the tables. A batch that repeats a key is refused, and an empty one
    changes nothing. Gates look at the parts that were written. Nothing is visible before the end.
    """
    with scratch_scope(store.spark):
        return _apply(store, batch, policy, min_reviews, min_places, gates)


def _before(draft: Draft, table: str, parts: list[int], schema: StructType | str) -> DataFrame:
    found = draft.before(table, parts)
    return draft.store.spark.createDataFrame([], schema) if found is None else found


def _apply(store, batch, policy, min_reviews, min_places, gates) -> UpkeepReport:
    small = check_keys(batch)
    keys = keys_of(batch, small)
    draft = store.draft()
    in_silver = store.touched("silver", batch)
    if not in_silver:
        return UpkeepReport()
    history = _before(draft, "silver", in_silver, SILVER)
    silver = draft.write("silver", merge(history, batch, policy=policy).select(*SILVER.names), in_silver)

    # The keys are unique, so the rows that go and those that come are at most as many as the batch.
    before = stage(history.join(keys, "place_id", "left_semi"), "before")
    after = stage(silver.join(keys, "place_id", "left_semi"), "after")
    districts = before.select("khet").unionByName(after.select("khet"))
    in_gold = store.touched("state", districts)
    changes, _ = settle(signed_changes(before, after, min_reviews))

    old_state = _before(draft, "state", in_gold, _STATE)
    state = draft.write("state", fold(old_state, changes), in_gold)
    stats, _ = settle(stats_of(state))
    again, counted = settle(moved(stats_of(old_state), stats, min_places))

    # Of the old gold rows of these parts, those of the batch go, and those of districts that moved
    # are scored again with the rows that come; the others are copied.
    again = F.broadcast(again) if fewer(counted) else again.hint("merge")
    rest = {
        name: rows.join(keys, "place_id", "left_anti")
        for name in (SCORED, UNQUALIFIED) if (rows := draft.before(name, in_gold)) is not None
    }
    to_score = add_category(after).select(*_COMMON)
    for rows in rest.values():
        to_score = to_score.unionByName(rows.join(again, "khet", "left_semi").select(*_COMMON))
    scored, unqualified = score_with(stage(to_score, "to-score"), stats, min_reviews, min_places)
    made = {SCORED: scored.select(*GOLD_SCORED), UNQUALIFIED: unqualified.select(*GOLD_UNQUALIFIED)}
    gold = {}
    for name, rows in made.items():
        if name in rest:
            rows = rows.unionByName(rest[name].join(again, "khet", "left_anti"))
        gold[name] = draft.write(name, rows, in_gold)
    if gates:
        _require("silver", silver_checks(silver))
        _require("gold", gold_checks(gold[SCORED], gold[UNQUALIFIED]))
    version = draft.commit()
    parts = {"silver": in_silver, "state": in_gold, SCORED: in_gold, UNQUALIFIED: in_gold}
    return UpkeepReport(parts, counted["rows"], version)
