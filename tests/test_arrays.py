"""One JSON array read in ranges equals the same file read by one task."""

import json
import random

import pytest
from pyspark.sql import functions as F

from peerscore.schemas import BRONZE, CORRUPT
from peerscore.sources import arrays, bronze
from tests.helpers import PLACE, place


def places(n):
    """Names with brackets, quotes, backslashes and characters of two to four bytes."""
    rng = random.Random(6)
    bits = ["}", "{", "[", "]", '"', "\\", '\\"', "},{", '"}', "ตลาด", "é", "😀", "\n", "\\u007d", ",", " x "]
    made = []
    for i in range(n):
        text = "".join(rng.choices(bits, k=rng.randint(0, 9)))
        made.append(place(
            id=f"p{i}", displayName={"text": text, "languageCode": None}, extra={"deep": [{"a": [text]}, {}]},
            types=[text, "bakery"] if i % 3 else ..., rating=rng.choice([3.9, "4", None, 4]),
            formattedAddress=text * 40 if i % 11 == 0 else text,
        ))
    return made


def keyed(df):
    rows = df.select(F.to_json(F.struct(*BRONZE.names)).alias("row"), CORRUPT).collect()
    return sorted((r["row"], r[CORRUPT]) for r in rows)


@pytest.fixture
def small_splits(spark):
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("style", [{}, {"indent": 1}, {"ensure_ascii": False, "separators": (",", ":")}])
@pytest.mark.parametrize("per_range", [1, 5, 1 << 16])
def test_equal_to_one_task(spark, tmp_path, style, per_range):
    (tmp_path / "a").mkdir()
    for k, n in enumerate([60, 1, 0, 7]):
        (tmp_path / "a" / f"{k}.json").write_text(json.dumps(places(n), **style), encoding="utf8")
    found = arrays.read_arrays(spark, str(tmp_path / "a"), per_range)
    expected = bronze.read_bronze(spark, str(tmp_path / "a"), multi_line=True)
    assert found.schema == expected.schema
    assert keyed(found) == keyed(expected)


def test_byte_ranges_torn_anywhere(spark, tmp_path, small_splits):
    """Splits of 701 bytes tear records, strings, escapes and characters; many tasks parse."""
    path = tmp_path / "one.json"
    path.write_text(json.dumps(places(80), ensure_ascii=False), encoding="utf8")
    rows = arrays.fragments(spark, str(path))
    splits = rows.select("_block", F.spark_partition_id().alias("task")).distinct().collect()
    assert len({r["_block"] for r in splits}) > 20 and len({r["task"] for r in splits}) > 1
    starts = arrays.ranges(rows).collect()
    assert {r["_inside"] for r in starts} == {True, False} and len({r["_depth"] for r in starts}) > 2
    found = arrays.read_arrays(spark, str(path))
    tasks = found.select(F.spark_partition_id().alias("task"), "id").filter("id IS NOT NULL")
    assert tasks.select("task").distinct().count() > 1
    assert keyed(found) == keyed(bronze.read_bronze(spark, str(path), multi_line=True))


@pytest.mark.parametrize("per_range", [1, 4])
def test_a_record_longer_than_many_ranges(spark, tmp_path, per_range):
    path = tmp_path / "one.json"
    long = place(id="long", displayName={"text": "}" * 500 + '{"' * 50}, extra=[{"x": {}}] * 60)
    path.write_text(json.dumps([PLACE, long, place(id="z")]))
    found = arrays.read_arrays(spark, str(path), per_range)
    assert keyed(found) == keyed(bronze.read_bronze(spark, str(path), multi_line=True))


WHOLE = json.dumps([PLACE, place(id="a2")])


@pytest.mark.parametrize("text", [
    WHOLE[:-1], WHOLE[:-2], WHOLE[:-20], WHOLE[:40], WHOLE + "]", WHOLE.replace("}, {", "} {"), WHOLE[1:],
    WHOLE + " x", '[{"a": 1},, {"id": "b"}]', '[1, {"id": "b"}]', '["}"]', "[", '{"id": "alone"}', "[}]", '[{"a" 1}]',
    WHOLE[:-1] + ", null]",
])
def test_what_is_no_array_is_reported(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    found = arrays.read_arrays(spark, str(tmp_path / "bad.json"), 2).collect()
    assert any(r[CORRUPT] is not None for r in found)


@pytest.mark.parametrize("text", ["[]", " [ ]\n", "[\n\t]"])
def test_an_empty_array_has_no_rows(spark, tmp_path, text):
    (tmp_path / "none.json").write_text(text)
    assert arrays.read_arrays(spark, str(tmp_path / "none.json")).count() == 0


def test_a_compressed_array(spark, tmp_path):
    import gzip

    (tmp_path / "a.json.gz").write_bytes(gzip.compress(json.dumps(places(30)).encode()))
    path = str(tmp_path / "a.json.gz")
    found = arrays.read_arrays(spark, path, 3)
    assert keyed(found) == keyed(bronze.read_bronze(spark, path, multi_line=True))
