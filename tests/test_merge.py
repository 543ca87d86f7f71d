import datetime
import random
import re

import pytest

from peerscore.operators import merge as m
from peerscore.operators.silver import first_version
from peerscore.plans.pipeline import next_silver
from peerscore.sources.versions import VersionedTable
from tests.helpers import plan, silver_row, silver_table


def day(text):
    return datetime.date.fromisoformat(text)


def batch(spark, date, **ratings):
    rows = [silver_row(k, rating=v, ingestion_date=day(date)) for k, v in ratings.items()]
    return silver_table(spark, rows).drop("first_seen_date")


def history(spark, date, **ratings):
    return first_version(batch(spark, date, **ratings))


def facts(df):
    return {
        r["place_id"]: (r["rating"], str(r["ingestion_date"]), str(r["first_seen_date"]))
        for r in df.collect()
    }


@pytest.mark.parametrize("shuffle", [True, False])
def test_batch_wins_history_stays_first_date_is_kept(spark, shuffle):
    old = history(spark, "2026-08-01", a=4.5, b=3.0)
    merged = m.merge(old, batch(spark, "2026-08-27", a=4.7, c=2.0), full_outer=shuffle)
    assert merged.columns == old.columns
    assert facts(merged) == {
        "a": (4.7, "2026-08-27", "2026-08-01"),
        "b": (3.0, "2026-08-01", "2026-08-01"),
        "c": (2.0, "2026-08-27", "2026-08-27"),
    }


@pytest.mark.parametrize("shuffle", [True, False])
def test_a_backfill(spark, shuffle):
    old = history(spark, "2026-08-27", a=4.5)
    late = batch(spark, "2026-08-01", a=1.0, b=2.0)
    batch_wins = m.merge(old, late, full_outer=shuffle)
    assert facts(batch_wins)["a"] == (1.0, "2026-08-01", "2026-08-01")
    newest = m.merge(old, late, policy=m.NEWEST_WINS, full_outer=shuffle)
    assert facts(newest)["a"] == (4.5, "2026-08-27", "2026-08-01")
    assert facts(newest)["b"] == (2.0, "2026-08-01", "2026-08-01")


def test_null_values_of_the_batch_win_too(spark):
    old = history(spark, "2026-08-01", a=4.5)
    new = silver_table(spark, [silver_row("a", name=None, price_level=None)])
    [row] = m.merge(old, new.drop("first_seen_date")).collect()
    assert (row["name"], row["price_level"]) == (None, None)


def test_repeated_keys_are_refused(spark):
    twice = batch(spark, "2026-08-27", a=4.0).union(batch(spark, "2026-08-27", a=4.1))
    with pytest.raises(m.DuplicateKeys, match="'a' occurs 2 times"):
        m.merge(history(spark, "2026-08-01", a=4.5), twice)


def test_unknown_policy(spark):
    with pytest.raises(ValueError, match="policy"):
        m.merge(history(spark, "2026-08-01", a=1.0), batch(spark, "2026-08-02", a=1.0), policy="x")


def test_empty_sides(spark):
    none = batch(spark, "2026-08-27")
    old = history(spark, "2026-08-01", a=4.5)
    assert facts(m.merge(old, none)) == facts(old)
    assert facts(m.merge(first_version(none), batch(spark, "2026-08-27", a=1.0))) == {
        "a": (1.0, "2026-08-27", "2026-08-27")
    }


def test_parts_agree_with_the_merge(spark):
    old = history(spark, "2026-08-01", a=4.5, b=3.0)
    new = batch(spark, "2026-08-27", a=4.7, c=2.0)
    assert {r[0] for r in m.carried_over(old, new).select("place_id").collect()} == {"b"}
    seen = {r["place_id"]: str(r["first_seen_date"]) for r in m.first_seen(old, new).collect()}
    assert seen == {k: v[2] for k, v in facts(m.merge(old, new)).items()}


@pytest.mark.parametrize("buckets", [0, 4])
def test_consecutive_runs_on_one_table(spark, tmp_path, buckets):
    """Each run reads the version the run before wrote, and a repeated run changes nothing."""
    table = VersionedTable(spark, str(tmp_path / "silver"), buckets)
    rng = random.Random(7)
    expected = {}
    dates = ["2026-08-01", "2026-08-08", "2026-08-15", "2026-08-15", "2026-08-22"]
    ratings = {}
    for run, date in enumerate(dates):
        if run != 3:  # run 3 repeats run 2
            ratings = {f"p{i}": rng.randint(10, 50) / 10 for i in rng.sample(range(40), 20)}
        for k, v in ratings.items():
            expected[k] = (v, date, expected[k][2] if k in expected else date)
        table.replace(next_silver(table, batch(spark, date, **ratings)))
        assert facts(table.read()) == expected


def test_history_is_not_shuffled_for_a_small_batch(spark, tmp_path, monkeypatch):
    history(spark, "2026-08-01", a=4.5).write.parquet(str(tmp_path / "h"))
    batch(spark, "2026-08-27", a=4.7).write.parquet(str(tmp_path / "b"))
    old, new = spark.read.parquet(str(tmp_path / "h")), spark.read.parquet(str(tmp_path / "b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    monkeypatch.setattr("peerscore.session.BROADCAST_ROWS", 1)
    try:
        merged = plan(m.merge(old, new))
        for kind in ("LeftAnti", "LeftSemi"):
            [line] = [x for x in merged.splitlines() if kind in x]
            assert "BroadcastHashJoin" in line
        # Only the batch and its matches are shuffled, and of these only the dates are read.
        assert merged.count("Exchange hashpartitioning") == 2
        reads = re.findall(r"Location: [^\n]*/h\][^\n]*ReadSchema: (\S+)", merged)
        assert "struct<place_id:string,first_seen_date:date>" in reads
        # A batch beyond the bound is not broadcast.
        two = batch(spark, "2026-08-27", a=4.7, b=1.0)
        large = plan(m.merge(old, two))
        assert "FullOuter" in large and "Broadcast" not in large
        assert large.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_history_stays_in_place(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "silver"), buckets=8)
    ratings = {f"p{i}": 4.0 for i in range(200)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for date in ("2026-08-01", "2026-08-08"):
            merged = next_silver(table, batch(spark, date, **ratings))
            path = table.replace(merged)
            assert len(list((tmp_path / "silver" / path.rsplit("/", 1)[1]).glob("*.parquet"))) == 8
        # Only the batch is moved.
        text = plan(merged)
        assert "FullOuter" in text and text.count("Exchange hashpartitioning") == 1
        # Another session has no catalog entry, and makes one from the version.
        spark.sql(f"DROP TABLE {table._entry(path)}")
        again = VersionedTable(spark, str(tmp_path / "silver"), buckets=8)
        merged = next_silver(again, batch(spark, "2026-08-15", p1=1.0))
        assert plan(merged).count("Exchange hashpartitioning") == 1
        assert facts(merged)["p1"] == (1.0, "2026-08-15", "2026-08-01")
        assert merged.count() == 200
        again.replace(merged)
        assert len(again.prune(keep=1)) == 2
        # A plain table can turn into a bucketed one, and back.
        plain = VersionedTable(spark, str(tmp_path / "silver"))
        plain.replace(next_silver(plain, batch(spark, "2026-08-22", p2=2.0)))
        assert not again.is_aligned()
        again.replace(next_silver(again, batch(spark, "2026-08-29", p3=3.0)))
        assert again.is_aligned() and again.read().count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
