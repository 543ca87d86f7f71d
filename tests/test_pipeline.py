import json
from datetime import date

import pytest

from peerscore.operators.merge import DuplicateKeys
from peerscore.operators.quality import GateFailed, silver_checks
from peerscore.plans import pipeline as p
from peerscore.plans.ingest import land_answers
from peerscore.sources import catalog
from peerscore.sources.bronze import snapshot_dates
from peerscore.sources.versions import VersionedTable
from tests.helpers import land, place, plan


def records(n, rating=4.0, district="Watthana"):
    address = f"9 Road, Khwaeng X, Khet {district}, Bangkok 10110, Thailand"
    return [
        place(id=f"{district}-{i}", rating=round(rating + i / 10, 1), formattedAddress=address)
        for i in range(n)
    ]


@pytest.fixture
def config(tmp_path):
    def build(name, rows, date="2026-08-27", **options):
        return p.PipelineConfig(
            land(tmp_path / "bronze" / name, rows), str(tmp_path / "silver"),
            str(tmp_path / "gold") + "/", date, **options,
        )
    return build


def read(spark, cfg, table):
    return VersionedTable(spark, cfg.gold_path).read_part(table)


def test_three_runs(spark, config, tmp_path):
    first = config("1", records(6) + records(3, district="Bang Rak") + [place(id="x", rating=...)],
                   "2026-08-01", database="peerscore_test", database_location=str(tmp_path / "db"))
    report = p.run_pipeline(spark, first)
    assert report.rows == {
        "bronze": 10, "batch": 9, "silver": 9, p.SCORED: 6, p.UNQUALIFIED: 3,
    }
    assert report.dropped == {
        "missing_id": 0, "missing_signal": 1, "thai_script": 0, "outside_region": 0,
        "neither_gold_table": 0,
    }
    assert spark.table(f"peerscore_test.{p.SCORED}").count() == 6

    second = config("2", records(2, rating=1.0), "2026-08-08", database="peerscore_test")
    assert p.run_pipeline(spark, second).rows["silver"] == 9
    silver = {r["place_id"]: r for r in VersionedTable(spark, second.silver_path).read().collect()}
    changed = silver["Watthana-0"]
    assert changed["rating"] == 1.0
    assert str(changed["ingestion_date"]) == "2026-08-08"
    assert str(changed["first_seen_date"]) == "2026-08-01"

    third = config("3", records(5, district="Bang Rak"), "2026-08-15", database="peerscore_test")
    report = p.run_pipeline(spark, third)
    assert report.rows[p.SCORED] == 11 and report.rows[p.UNQUALIFIED] == 0
    assert spark.table(f"peerscore_test.{p.SCORED}").count() == 11
    assert spark.table(f"peerscore_test.{p.UNQUALIFIED}").count() == 0
    # Only the versions that are kept remain.
    assert len(list((tmp_path / "silver").iterdir())) == 2
    spark.sql("DROP DATABASE peerscore_test CASCADE")


def test_buckets_change_no_result(spark, config):
    p.run_pipeline(spark, config("1", records(6), "2026-08-01", silver_buckets=4))
    second = config("2", records(3, rating=2.0), "2026-08-08", silver_buckets=4)
    report = p.run_pipeline(spark, second)
    assert report.rows == {"bronze": 3, "batch": 3, "silver": 6, p.SCORED: 6, p.UNQUALIFIED: 0}
    ratings = sorted(r["rating"] for r in read(spark, second, p.SCORED).collect())
    assert ratings == [2.0, 2.1, 2.2, 4.3, 4.4, 4.5]


def test_array_file(spark, config, tmp_path):
    cfg = config("a", [], multi_line=True)
    (tmp_path / "bronze" / "a" / "part-0.json").write_text(json.dumps(records(5)))
    assert p.run_pipeline(spark, cfg).rows[p.SCORED] == 5


def test_torn_input_merges_nothing(spark, config):
    with pytest.raises(p.CorruptInput, match="1 raw records"):
        p.run_pipeline(spark, cfg := config("t", [*records(5), '{"id": "torn']))
    assert VersionedTable(spark, cfg.silver_path).read() is None


def test_repeated_ids_merge_nothing(spark, config):
    p.run_pipeline(spark, good := config("1", records(5)))
    before = VersionedTable(spark, good.silver_path).current()
    with pytest.raises(DuplicateKeys):
        p.run_pipeline(spark, config("2", records(5) + records(1)))
    assert VersionedTable(spark, good.silver_path).current() == before


def test_answers_with_repeated_places_become_a_snapshot(spark, tmp_path):
    first, again = place(id="p", rating=3.0), place(id="p", rating=2.0)
    answers = [
        {"i": 1, "j": 0, "places": [again, *records(5)]}, {"i": 0, "j": 2, "places": [first]},
        {"i": 0, "j": 3}, {"i": 2, "j": 0, "places": [*records(2), place(id=""), place(id=...)]},
    ]
    path = land_answers(spark, land(tmp_path / "answers", answers), str(tmp_path), "2026-08-27")
    cfg = p.PipelineConfig(path, str(tmp_path / "silver"), str(tmp_path / "gold"), "2026-08-27")
    assert p.run_pipeline(spark, cfg).rows["silver"] == 6
    silver = {r["place_id"]: r["rating"] for r in VersionedTable(spark, cfg.silver_path).read().collect()}
    assert silver["p"] == 3.0
    with pytest.raises(Exception, match="(?i)malformed"):
        land_answers(spark, land(tmp_path / "torn", ['{"i": 1']), str(tmp_path), "2026-08-28")
    assert snapshot_dates(spark, str(tmp_path)) == ["2026-08-27"]


def test_stages_run_alone(spark, config):
    cfg = config("1", records(6), database="peerscore_stages")
    for stage in (p.build_gold, p.publish_current):
        with pytest.raises(p.MissingLayer):
            stage(spark, cfg)
    assert p.build_silver(spark, cfg).rows["silver"] == 6
    assert p.build_gold(spark, cfg).rows == {p.SCORED: 6, p.UNQUALIFIED: 0}
    assert p.publish_current(spark, cfg) == {p.SCORED: 6, p.UNQUALIFIED: 0}
    spark.sql("DROP DATABASE peerscore_stages CASCADE")


def test_failed_publish_leaves_both_names(spark, config, monkeypatch):
    cfg = config("1", records(6), database="peerscore_half")
    p.run_pipeline(spark, cfg)
    p.build_silver(spark, config("2", records(8)))
    p.build_gold(spark, cfg)
    write = catalog._write
    monkeypatch.setattr(catalog, "_write", lambda df, d, name: (
        write(df, d, name) if name.startswith(p.SCORED) else 1 / 0
    ))
    with pytest.raises(ZeroDivisionError):
        p.publish_current(spark, cfg)
    assert spark.table(f"peerscore_half.{p.SCORED}").count() == 6
    monkeypatch.undo()
    for _ in range(3):
        assert p.publish_current(spark, cfg)[p.SCORED] == 8
    assert spark.table(f"peerscore_half.{p.SCORED}").count() == 8
    names = [t.name for t in spark.catalog.listTables("peerscore_half")]
    assert len(names) == 6  # two names, two tables for each
    spark.sql("DROP DATABASE peerscore_half CASCADE")


def test_gate_of_bucketed_silver_shuffles_no_ids(spark, config):
    cfg = config("1", records(6), silver_buckets=4)
    p.build_silver(spark, cfg)
    silver = VersionedTable(spark, cfg.silver_path, 4).read()
    assert "hashpartitioning(place_id" not in plan(silver_checks(silver))


def test_failed_silver_gate_changes_nothing(spark, config):
    p.run_pipeline(spark, good := config("1", records(6)))
    before = VersionedTable(spark, good.silver_path).current()
    with pytest.raises(GateFailed, match="rating_range"):
        p.run_pipeline(spark, config("2", records(2, rating=7.0)))
    assert VersionedTable(spark, good.silver_path).current() == before
    assert read(spark, good, p.SCORED).count() == 6
    # The next run continues from the last good version.
    assert p.run_pipeline(spark, config("3", records(7))).rows["silver"] == 7


def test_failed_gold_gate_publishes_nothing(spark, config):
    cfg = config("1", records(4), database="peerscore_never")
    with pytest.raises(GateFailed, match="scored_row_count"):
        p.run_pipeline(spark, cfg)
    assert read(spark, cfg, p.SCORED) is None and read(spark, cfg, p.UNQUALIFIED) is None
    assert not spark.catalog.databaseExists("peerscore_never")


def test_gold_tables_become_visible_together(spark, config, monkeypatch):
    p.run_pipeline(spark, cfg := config("1", records(6)))
    monkeypatch.setattr(p, "gold_checks", lambda *tables: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        p.run_pipeline(spark, config("2", records(7)))
    assert read(spark, cfg, p.SCORED).count() == 6
    monkeypatch.undo()
    p.run_pipeline(spark, config("3", records(8)))
    assert read(spark, cfg, p.SCORED).count() == 8


def test_rerun_of_the_same_snapshot_changes_nothing(spark, config):
    cfg = config("1", records(6))
    p.run_pipeline(spark, cfg)
    before = sorted(map(str, read(spark, cfg, p.SCORED).collect()))
    p.run_pipeline(spark, cfg)
    assert sorted(map(str, read(spark, cfg, p.SCORED).collect())) == before


def test_run_date_defaults_to_today():
    assert p.PipelineConfig("/b", "/s", "/g").run_date == date.today().isoformat()


@pytest.mark.parametrize("change", [
    {"bronze_path": ""}, {"silver_path": "s3://None/silver"}, {"gold_path": None},
    {"run_date": "2026-99-01"},
])
def test_config_is_checked_up_front(change):
    good = {"bronze_path": "/b", "silver_path": "/s", "gold_path": "/g", "run_date": "2026-08-27"}
    with pytest.raises(ValueError):
        p.PipelineConfig(**{**good, **change})
