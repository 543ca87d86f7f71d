import json

import pytest

from peerscore.schemas import CORRUPT
from peerscore.sources import bronze, catalog, files
from peerscore.sources.versions import VersionedTable
from tests.helpers import PLACE, land, place


def test_json_array_file(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps([PLACE, place(id="a2")], indent=2))
    rows = bronze.read_bronze(spark, str(tmp_path / "one.json"), multi_line=True).collect()
    assert sorted(r["id"] for r in rows) == ["a1", "a2"]
    assert {r["rating"] for r in rows} == {"3.9"}


def test_empty_array_is_valid_and_empty(spark, tmp_path):
    (tmp_path / "none.json").write_text("[]")
    assert bronze.read_bronze(spark, str(tmp_path / "none.json"), multi_line=True).count() == 0


def test_torn_array_is_reported(spark, tmp_path):
    (tmp_path / "torn.json").write_text(json.dumps([PLACE])[:-20])
    rows = bronze.read_bronze(spark, str(tmp_path / "torn.json"), multi_line=True).collect()
    assert [r[CORRUPT] is not None for r in rows] == [True]


def test_torn_line_keeps_the_others(spark, tmp_path):
    path = land(tmp_path / "b", [PLACE, '{"id": "torn", "rat'])
    rows = bronze.read_bronze(spark, path).collect()
    assert sorted((r["id"] or "", r[CORRUPT] is not None) for r in rows) == [("", True), ("a1", False)]


def test_roundtrip_keeps_non_ascii(spark, tmp_path):
    thai = "9 Road, ตลาดริมน้ำ, Bangkok 10110, Thailand"
    source = bronze.read_bronze(spark, land(tmp_path / "in", [place(formattedAddress=thai)]))
    bronze.write_bronze(source, str(tmp_path / "out"))
    [row] = bronze.read_bronze(spark, str(tmp_path / "out")).collect()
    assert row["formattedAddress"] == thai
    assert row["types"] == ["bakery", "store"]
    text = "".join(p.read_text(encoding="utf8") for p in (tmp_path / "out").glob("part-*"))
    assert "ตลาดริมน้ำ" in text


def test_snapshots_are_immutable_and_selected_by_date(spark, tmp_path):
    root = str(tmp_path / "lake") + "/"
    old = bronze.read_bronze(spark, land(tmp_path / "x", [PLACE]))
    new = bronze.read_bronze(spark, land(tmp_path / "y", [PLACE, place(id="a2")]))
    bronze.land_snapshot(old, root, "2026-08-20")
    bronze.land_snapshot(new, root, "2026-08-27")
    with pytest.raises(Exception, match="already exists"):
        bronze.land_snapshot(old, root, "2026-08-27")
    # A snapshot that was never finished is not the latest.
    land(tmp_path / "lake" / "bronze" / "2026-09-03", [PLACE])
    assert bronze.snapshot_dates(spark, root) == ["2026-08-20", "2026-08-27"]
    assert bronze.read_snapshot(spark, root).count() == 2
    assert bronze.read_snapshot(spark, root, "2026-08-20").count() == 1


def test_responses_without_places_yield_nothing(spark):
    df = spark.createDataFrame(
        [(1, [("a",), ("b",)]), (2, None), (3, [])],
        "tile int, places array<struct<place_id: string>>",
    )
    rows = bronze.explode_responses(df).collect()
    assert sorted(map(tuple, rows)) == [(1, 1, "a"), (1, 2, "b")]


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t") + "/")
    assert table.current() is None and table.read() is None
    first = table.replace(spark.range(1))
    staged = table.stage(spark.range(2))
    assert table.current() == first and table.read().count() == 1
    # A new run does not reuse the number of a version that was never promoted.
    second = table.replace(spark.range(3))
    assert second > staged > first
    third = table.replace(table.read().union(table.read()))
    assert table.read().count() == 6
    assert table.prune(keep=2) == [first, staged]
    assert table.current() == third
    assert files.names(spark, table.root) == [p.rsplit("/", 1)[1] for p in (second, third)]
    with pytest.raises(ValueError, match="at least one"):
        table.prune(keep=0)


def test_foreign_files_are_not_a_first_run(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="something else"):
        VersionedTable(spark, str(tmp_path / "plain")).read()


def test_unreadable_version_raises(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    path = table.replace(spark.range(3).coalesce(1))
    for part in (tmp_path / "t" / path.rsplit("/", 1)[1]).glob("*.parquet"):
        part.write_bytes(b"broken")
    with pytest.raises(Exception):  # noqa: B017
        VersionedTable(spark, str(tmp_path / "t")).read().count()


def test_content_tells_what_counts_do_not(spark):
    one = spark.createDataFrame([("a", 1.0), ("b", None), ("c", 2.0)], "id string, v double")
    assert catalog.content(one) == catalog.content(one.orderBy("v").repartition(3))
    doubled = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("c", 2.0)], one.schema)
    swapped = spark.createDataFrame([("a", 2.0), ("b", None), ("c", 1.0)], one.schema)
    twice = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("y", 1.0), ("y", 1.0)], one.schema)
    pairs = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("z", 1.0), ("z", 1.0)], one.schema)
    for other in (doubled, swapped):
        assert catalog.content(other)["rows"] == 3 and catalog.content(other) != catalog.content(one)
    assert catalog.content(twice)["xor"] == catalog.content(pairs)["xor"]
    assert catalog.content(twice) != catalog.content(pairs)
    assert catalog.content(one.limit(0)) == {"rows": 0, "xor": 0, "sum": 0}


def test_rows_that_arrive_changed_are_not_published(spark, tmp_path, monkeypatch):
    catalog.ensure_database(spark, "peerscore_content", str(tmp_path / "db"))
    good = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "id string, v double")
    assert catalog.publish_all({"t": good}, "peerscore_content") == {"t": 2}
    bad = spark.createDataFrame([("a", 1.0), ("a", 1.0)], good.schema)
    honest = catalog.content
    monkeypatch.setattr(catalog, "content", lambda df: honest(bad))
    with pytest.raises(RuntimeError, match="not the same"):
        catalog.publish_all({"t": good}, "peerscore_content")
    monkeypatch.undo()
    assert catalog.content(spark.table("peerscore_content.t")) == catalog.content(good)
    assert len(spark.catalog.listTables("peerscore_content")) == 2
    spark.sql("DROP DATABASE peerscore_content CASCADE")


def test_arrays_are_read_once(spark, tmp_path):
    """Numbers are read as they are written, without going back to the file for each of them."""
    n = 2000
    records = ",\n".join(
        f'{{"id": "a{k}", "rating": 4.50, "userRatingCount": 1e2, "location": {{"latitude": 13.70, "longitude": -0}}}}'
        for k in range(n)
    )
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text(f"[{records}]")
    (tmp_path / "in" / "other.json").write_text(json.dumps(PLACE, indent=2))
    (tmp_path / "in" / "blank.json").write_text(" \n")
    rows = bronze.read_bronze(spark, str(tmp_path / "in"), multi_line=True)
    found = rows.collect()
    numbers = {(r["rating"], r["userRatingCount"], r["location"]["latitude"]) for r in found}
    assert len(found) == n + 1 and {r[CORRUPT] for r in found} == {None}
    assert numbers == {("4.50", "1e2", "13.70"), ("3.9", "17", "13.7781")}
    assert rows.count() == n + 1

    def bytes_read():
        return sum(x.getBytesRead() for x in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = bytes_read()
    rows.write.format("noop").mode("overwrite").save()
    size = sum(p.stat().st_size for p in (tmp_path / "in").iterdir())
    assert 0 < bytes_read() - before <= 3 * size


def test_arrays_in_another_encoding_are_reported(spark, tmp_path):
    (tmp_path / "wide.json").write_text(json.dumps([PLACE]), encoding="utf-16-le")
    rows = bronze.read_bronze(spark, str(tmp_path / "wide.json"), multi_line=True).collect()
    assert rows and all(r[CORRUPT] is not None and r["id"] is None for r in rows)
