"""States of places over snapshots, and stored quantile sketches."""

import datetime
import random

import pytest

from peerscore.operators import history, sketches
from peerscore.operators.medians import exact_medians
from peerscore.operators.merge import DuplicateKeys

START = datetime.date(2026, 8, 1)
SCHEMA = "place_id string, rating double, types array<string>, vanished string, ingestion_date date"


def day(n):
    return None if n is None else START + datetime.timedelta(weeks=n)


def brute(rows, weeks):
    by_place = {}
    for place, rating, types, _, date in rows:
        if place is not None and date is not None:
            by_place.setdefault(place, {})[weeks.index(date)] = (str(rating), types)
    found = []
    for place, seen in by_place.items():
        past = None
        for n in sorted(seen):
            if n - 1 in seen and seen[n - 1] == seen[n]:
                continue
            end = n
            while end + 1 in seen and seen[end + 1] == seen[n]:
                end += 1
            changed = None if past is None else [
                f for f, a, b in zip(("rating", "types"), past, seen[n], strict=True) if a != b
            ]
            over = end + 1 < len(weeks)
            found.append((
                place, seen[n][0], seen[n][1], weeks[n], weeks[end + 1] if over else None,
                over and end + 1 not in seen, changed,
            ))
            past = seen[n]
    return sorted(found, key=repr)


def test_states_equal_a_plain_scan(spark):
    rng = random.Random(7)
    weeks = [day(n) for n in (0, 1, 2, 5, 6)]  # snapshots need not be equally far apart
    rows = []
    for place in ("a", "b", "c", "d", "e", "f", "g"):
        for week in weeks:
            if rng.random() < 0.7:
                rows.append((place, rng.choice([4.0, 4.5, None, float("nan")]), rng.choice([None, ["x"]]), "own", week))
    rows += [("still", 4.0, ["x"], "own", week) for week in weeks]
    rows += [("back", r, None, "own", w) for r, w in zip((1.0, 2.0, 1.0), weeks, strict=False)]
    rows += [("gone", 3.0, None, "own", weeks[0]), ("gone", 3.0, None, "own", weeks[2])]
    rows += [(None, 1.0, None, "own", weeks[0]), ("undated", 1.0, None, "own", None)]
    found = history.states(spark.createDataFrame(rows, SCHEMA).repartition(3), ["rating", "types"])
    assert found.columns == ["place_id", "rating", "types", "valid_from", "valid_to", "vanished", "changed"]
    got = [(r[0], str(r[1]), *r[2:]) for r in found.collect()]
    assert sorted(got, key=repr) == brute(rows, weeks)
    assert [r[3:] for r in sorted(got, key=lambda r: r[3]) if r[0] == "gone"] == [
        (weeks[0], weeks[1], True, None), (weeks[2], weeks[3], True, []),
    ]
    assert sum(r[0] == "back" for r in got) == 3 and sum(r[0] == "still" for r in got) == 1
    on = history.changes_on(found, weeks[1].isoformat()).collect()
    assert {weeks[1]} <= {d for r in on for d in (r["valid_from"], r["valid_to"])}


def test_a_snapshot_that_repeats_a_place_is_refused(spark):
    rows = [("a", 1.0, None, "own", START)] * 2
    with pytest.raises(DuplicateKeys, match="2 times"):
        history.states(spark.createDataFrame(rows, SCHEMA), ["rating"])
    assert history.states(spark.createDataFrame([], SCHEMA), ["rating"]).count() == 0


def test_sketches_merge_over_dates(spark):
    """Skewed, tiny, equal and empty groups; all values of a group are in sketches of several dates."""
    values = {
        "skewed": "pow(rand(3), 9)", "wide": "randn(5) * 1e6", "equal": "7.0D", "none": "CAST('NaN' AS DOUBLE)",
    }
    rows = None
    for name, value in values.items():
        part = spark.range(40_000).selectExpr(f"'{name}' AS g", "id % 5 AS d", f"{value} AS v")
        rows = part if rows is None else rows.unionByName(part)
    tiny = spark.createDataFrame([("tiny", 0, 3.0), ("tiny", 1, 1.0), ("tiny", 2, 2.0), ("tiny", 2, None)], rows.schema)
    rows = rows.unionByName(tiny).checkpoint()
    stored = sketches.sketch(rows, ["g", "d"], "v").checkpoint()
    found = sketches.merge(stored, ["g"]).withColumn("estimate", sketches.quantile())
    ranks = {r["g"]: r for r in sketches.rank_range(rows.filter("NOT isnan(v)"), ["g"], "v", found).collect()}
    assert set(ranks) == {"skewed", "wide", "equal", "tiny"}
    exact = {r["g"]: r["group_median"] for r in exact_medians(rows, ["g"], "v").collect()}
    assert ranks["tiny"]["estimate"] == exact["tiny"] == 2.0 and ranks["equal"]["estimate"] == 7.0
    for r in ranks.values():
        error = 3 * sketches.rank_error()
        assert r["below"] <= (0.5 + error) * r["n"] and r["up_to"] >= (0.5 - error) * r["n"]
    one_day = sketches.merge(stored.filter("d = 1"), ["g"]).filter("g = 'tiny'")
    assert one_day.select(sketches.quantile().alias("q")).first()["q"] == 1.0
    assert max(len(r["sketch"]) for r in stored.collect()) < 40_000
