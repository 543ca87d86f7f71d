"""Silver, district counts and gold kept in parts equal those of full runs."""

import datetime
import random
import shutil
from pathlib import Path

import pytest

from peerscore import session
from peerscore.operators import upkeep as up
from peerscore.operators.merge import NEWEST_WINS, DuplicateKeys, merge
from peerscore.operators.quality import GateFailed
from peerscore.operators.scoring import district_stats, score_places
from peerscore.operators.silver import first_version
from peerscore.plans import upkeep as run
from peerscore.schemas import SILVER
from tests.helpers import plan, silver_row, silver_table

START = datetime.date(2026, 8, 1)


def batch(spark, week, rows):
    day = START + datetime.timedelta(weeks=week)
    given = [silver_row(k, **{**v, "ingestion_date": v.get("ingestion_date", day)}) for k, v in rows.items()]
    return silver_table(spark, given).drop("first_seen_date")


def facts(df):
    return sorted((tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect()))


def random_rows(rng, ids):
    """Places that change their rating, their district and whether they have enough reviews."""
    return {
        f"p{i}": {
            "khet": rng.choice(["A", "B", "C", "D", "lone"][: 2 + i % 4]), "rating": rng.choice([3.9, 4.0, 4.4, 5.0]),
            "user_rating_count": rng.choice([2, 5, 40]), "place_types": rng.choice([None, ["cafe"], ["bakery"]]),
        }
        for i in ids
    }


@pytest.mark.parametrize("policy", ["batch_wins", NEWEST_WINS])
def test_three_batches_equal_a_full_run(spark, tmp_path, policy):
    rng = random.Random(9)
    store = run.places_store(spark, str(tmp_path / "store"), parts=4)
    history = None
    for week, ids in enumerate([range(60), range(50, 75), range(3, 90, 9)]):
        rows = random_rows(rng, ids)
        if week == 2:  # older than what the history has
            rows = {k: v | {"ingestion_date": START} for k, v in rows.items()}
        new = batch(spark, week, rows)
        history = first_version(new) if history is None else merge(history, new, policy=policy)
        run.apply_batch(store, new, policy)
        history = silver_table(spark, [r.asDict() for r in history.collect()])
    scored, unqualified = score_places(history)
    assert facts(store.read("silver").select(*SILVER.names)) == facts(history)
    assert facts(up.stats_of(store.read("state"))) == facts(district_stats(history))
    assert facts(store.read(run.SCORED)) == facts(scored)
    assert facts(store.read(run.UNQUALIFIED)) == facts(unqualified)


@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    """A store of 40 districts with six places each."""
    root = tmp_path_factory.mktemp("filled") / "store"
    store = run.places_store(spark, str(root), parts=8)
    rows = {f"{d}-{i}": {"khet": f"k{d}", "rating": 4.0 + i / 10} for d in range(40) for i in range(6)}
    run.apply_batch(store, batch(spark, 0, rows))
    return root


def copied(spark, filled, tmp_path):
    shutil.copytree(filled, tmp_path / "store")
    return run.places_store(spark, str(tmp_path / "store"), parts=8)


def test_untouched_parts_are_neither_read_nor_written(spark, filled, tmp_path):
    store = copied(spark, filled, tmp_path)
    before = store.current()
    new = batch(spark, 1, {"3-0": {"khet": "k3", "rating": 4.9}})
    touched = {"silver": store.touched("silver", new)} | {
        t: store.touched(t, new) for t in ("state", run.SCORED, run.UNQUALIFIED)
    }
    for table, of in before.paths.items():
        for part, path in of.items():
            if part not in touched[table]:  # whoever reads these now fails
                for file in Path(store.root, path).glob("*.parquet"):
                    file.write_bytes(b"unreadable")
    report = run.apply_batch(store, new)
    assert report.parts == touched and report.districts == 1
    after = store.current()
    changed = {
        (t, p) for t in before.paths for p in before.paths[t]
        if before.paths[t][p] != after.paths[t].get(p)
    }
    assert changed <= {(t, p) for t, of in touched.items() for p in of}
    size = {v.name: sum(f.stat().st_size for f in v.rglob("*.parquet")) for v in Path(store.root).iterdir()}
    written = [f for f in (Path(store.root) / "v00000002").rglob("part_no=*")]
    assert 0 < len(written) <= 4 < len([p for of in before.paths.values() for p in of])
    assert size["v00000002"] < size["v00000001"]
    part = store.touched(run.SCORED, new)
    medians = {r["khet"]: r["khet_median_rating"] for r in store.read(run.SCORED, part).collect()}
    assert medians["k3"] == 4.3 and set(medians.values()) <= {4.2, 4.3}


def test_a_run_that_dies_changes_nothing(spark, filled, tmp_path):
    store = copied(spark, filled, tmp_path)
    before = facts(store.read(run.SCORED)), store.current()
    with pytest.raises(GateFailed, match="rating_range"):
        run.apply_batch(store, batch(spark, 1, {"3-0": {"khet": "k3", "rating": 9.0}}))
    with pytest.raises(DuplicateKeys):
        run.apply_batch(store, batch(spark, 1, {"3-0": {}}).union(batch(spark, 1, {"3-0": {}})))
    assert (facts(store.read(run.SCORED)), store.current()) == before
    assert run.apply_batch(store, batch(spark, 1, {})).version == ""
    assert store.current() == before[1]
    report = run.apply_batch(store, batch(spark, 1, {"3-0": {"khet": "k3", "rating": 4.9}}))
    assert report.version.endswith("v00000003")


def test_old_parts_go_once_nobody_reads_them(spark, filled, tmp_path):
    store = copied(spark, filled, tmp_path)
    for week in (1, 2):
        run.apply_batch(store, batch(spark, week, {"3-0": {"khet": "k3", "rating": 4.0 + week / 10}}))
    before = facts(store.read("silver")), facts(store.read(run.SCORED))
    gone = store.prune(keep=1)
    assert gone and (facts(store.read("silver")), facts(store.read(run.SCORED))) == before
    assert not Path(store.root, "v00000002").exists() and Path(store.root, "v00000001").exists()
    assert store.prune(keep=1) == [] or store.read("silver").count() == 240


def test_the_number_of_parts_is_fixed(spark, filled):
    with pytest.raises(ValueError, match="8 parts"):
        run.places_store(spark, str(filled), parts=4).read("silver")


def test_changes_cancel_out(spark):
    rows = [silver_row("a"), silver_row("b", rating=float("nan")), silver_row("c", khet=None)]
    same = silver_table(spark, rows)
    assert up.signed_changes(same, same).count() == 0
    moved = silver_table(spark, [silver_row("a", rating=4.1), rows[1], rows[2]])
    got = {(r["rating"], r["places"]) for r in up.signed_changes(same, moved).collect()}
    assert got == {(3.9, -1), (4.1, 1)}
    state = up.district_counts(same)
    assert {tuple(r) for r in up.stats_of(state).collect()} == {tuple(r) for r in district_stats(same).collect()}


def test_large_batches_are_never_broadcast(spark, tmp_path, monkeypatch):
    """Keys that were measured not to be small stay where they are, whatever their files weigh."""
    seen = []
    real = run.Draft.write

    def write(draft, table, rows, parts):
        seen.append(plan(rows))
        return real(draft, table, rows, parts)

    monkeypatch.setattr(run.Draft, "write", write)
    monkeypatch.setattr(session, "REPEATED_BYTES", 10, raising=False)
    store = run.places_store(spark, str(tmp_path / "store"), parts=4)
    for week, ids in enumerate([range(60), range(50, 75)]):
        path = str(tmp_path / f"batch-{week}")
        batch(spark, week, random_rows(random.Random(week), ids)).write.parquet(path)
        run.apply_batch(store, spark.read.parquet(path), gates=False)
    assert len(seen) == 8 and store.read("silver").count() == 75
    for text in seen:
        joins = [x for x in text.splitlines() if "Join [place_id" in x or "Join [khet" in x and "LeftAnti" in x]
        assert all("SortMergeJoin" in x for x in joins)
    assert any("Join [place_id" in x for x in seen)
