"""The same queries as plain SQL over the given tables, for an independent engine."""

from __future__ import annotations

from peerscore.plans.tables import (
    ADDRESS,
    BATCH_DATES,
    BATCH_STARTS,
    FAR,
    LATITUDE,
    LONGITUDE,
    PLACE_ID,
    PRICE,
    RADIUS,
    RATING,
    REVIEWS,
    RUN_DATE,
    TYPE_NAMES,
)

ORACLE: dict[str, str] = {}


# -- shared tables ---------------------------------------------------------------------------

RAW = f"""reviews AS (
    SELECT l_partkey, {REVIEWS} AS cnt FROM lineitem GROUP BY l_partkey
), raw AS (
    SELECT {PLACE_ID} AS place_id, p_name AS name, {RATING} AS rating, {PRICE} AS price,
        {ADDRESS} AS address, {LATITUDE} AS latitude, {LONGITUDE} AS longitude,
        string_split({TYPE_NAMES}, ' ') AS types,
        CAST(coalesce(cnt, 0) AS INTEGER) AS user_rating_count
    FROM part LEFT JOIN reviews ON p_partkey = l_partkey
)"""

PRICE_LEVEL = """CASE price WHEN 'PRICE_LEVEL_FREE' THEN 0 WHEN 'PRICE_LEVEL_INEXPENSIVE' THEN 1
    WHEN 'PRICE_LEVEL_MODERATE' THEN 2 WHEN 'PRICE_LEVEL_EXPENSIVE' THEN 3
    WHEN 'PRICE_LEVEL_VERY_EXPENSIVE' THEN 4 END"""

CATEGORY = """CASE WHEN list_contains(types, 'cafe') AND list_contains(types, 'bakery')
        THEN 'cafe and bakery'
    WHEN list_contains(types, 'cafe') THEN 'cafe'
    WHEN list_contains(types, 'bakery') THEN 'bakery' ELSE 'other' END"""

FLAT = RAW + f""", split AS (
    SELECT *, string_split_regex(address, ',\\s*') AS parts FROM raw
), flat AS (
    SELECT place_id, name, types, rating, user_rating_count,
        CAST({PRICE_LEVEL} AS INTEGER) AS price_level, latitude, longitude,
        len(parts) AS part_count,
        trim(regexp_replace(trim(parts[-3]), '^khet\\s+', '', 'i')) AS khet,
        trim(regexp_replace(trim(parts[-2]), '\\d+', '', 'g')) AS province
    FROM split
)"""

THAI = "'[\\x{0E00}-\\x{0E7F}]'"
IN_REGION = "lower(province) IN ('bangkok', 'krung thep maha nakhon')"

TAGGED = FLAT + f""", tagged AS (
    SELECT *, CASE
        WHEN place_id IS NULL OR place_id = '' THEN 'missing_id'
        WHEN rating IS NULL OR user_rating_count IS NULL OR user_rating_count <= 0
            OR latitude IS NULL OR longitude IS NULL OR khet IS NULL OR province IS NULL
            THEN 'missing_signal'
        WHEN regexp_matches(khet, {THAI}) OR regexp_matches(province, {THAI}) THEN 'thai_script'
        WHEN NOT ({IN_REGION}) THEN 'outside_region'
        ELSE 'kept' END AS outcome
    FROM flat
)"""

SILVER = TAGGED + f""", silver AS (
    SELECT *, {CATEGORY} AS category FROM tagged WHERE outcome = 'kept'
)"""


def _gold(min_reviews: int = 5, suffix: str = "") -> str:
    return f""", stats{suffix} AS (
    SELECT khet, count(*) AS khet_candidate_count,
        quantile_disc(rating, 0.5) AS khet_median_rating
    FROM silver WHERE user_rating_count >= {min_reviews} GROUP BY khet
), scored{suffix} AS (
    SELECT place_id, name, category, s.khet, province, latitude, longitude, rating,
        user_rating_count, price_level, khet_median_rating,
        round(rating - khet_median_rating, 2) AS gem_score
    FROM silver s JOIN stats{suffix} t ON s.khet = t.khet
    WHERE user_rating_count >= {min_reviews} AND khet_candidate_count >= 5
), unqualified{suffix} AS (
    SELECT place_id, name, category, s.khet, province, latitude, longitude, rating,
        user_rating_count, price_level,
        CASE WHEN user_rating_count < {min_reviews} THEN 'low_review_count'
            ELSE 'khet_sample_too_small' END AS reason
    FROM silver s LEFT JOIN stats{suffix} t ON s.khet = t.khet
    WHERE user_rating_count < {min_reviews} OR khet_candidate_count < 5
)"""


GOLD = SILVER + _gold()


def _with(tables: str, select: str) -> str:
    return f"WITH {tables}\n{select}"


# -- raw snapshots ---------------------------------------------------------------------------

ORACLE["bronze_scan"] = _with(RAW, """SELECT place_id AS id, name, latitude, longitude, rating,
    price AS "priceLevel", user_rating_count AS "userRatingCount", false AS corrupt FROM raw""")
ORACLE["bronze_roundtrip"] = _with(RAW, """SELECT place_id AS id, address AS "formattedAddress",
    array_to_string(types, '|') AS types FROM raw""")
ORACLE["bronze_arrays"] = _with(RAW, """SELECT place_id AS id, address AS "formattedAddress",
    rating, array_to_string(types, '|') AS types, false AS corrupt FROM raw""")
ORACLE["bronze_large_arrays"] = _with(RAW, """SELECT place_id AS id, address AS "formattedAddress",
    rating, name, array_to_string(types, '|') AS types, false AS corrupt FROM raw""")
ORACLE["bronze_snapshot"] =_with(RAW, """
SELECT '2026-08-20' AS snapshot, count(*) AS places, count(rating) AS rated
FROM raw WHERE rating IS NOT NULL
UNION ALL SELECT 'latest', count(*), count(rating) FROM raw""")


# -- tile sweep ------------------------------------------------------------------------------

LOCATED = f"""located AS (
    SELECT {PLACE_ID} AS place_id, string_split({TYPE_NAMES}, ' ') AS types,
        {LATITUDE} AS latitude, {LONGITUDE} AS longitude
    FROM part
)"""


def _tiles(box: str) -> str:
    return f""", box AS ({box}
), tile_rows AS (
    SELECT *, unnest(generate_series(0, CAST(floor((max_lat - min_lat) / step) AS BIGINT))) AS i
    FROM (SELECT *, CAST(1050.0 AS DOUBLE) / CAST(111320.0 AS DOUBLE) AS step FROM box)
), tile_lats AS (
    SELECT *, min_lat + i * step AS lat, step / cos(radians(min_lat + i * step)) AS lon_step
    FROM tile_rows
), tiles AS (
    SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, lat, min_lon + j * lon_step AS lon
    FROM (
        SELECT *, unnest(generate_series(0,
            CAST(floor((max_lon - min_lon) / lon_step) AS BIGINT))) AS j
        FROM tile_lats
    )
)"""


CITY = """
    SELECT CAST(13.65 AS DOUBLE) AS min_lat, CAST(13.85 AS DOUBLE) AS max_lat,
        CAST(100.45 AS DOUBLE) AS min_lon, CAST(100.65 AS DOUBLE) AS max_lon"""
BOUNDS = """
    SELECT min(latitude) AS min_lat, max(latitude) AS max_lat,
        min(longitude) AS min_lon, max(longitude) AS max_lon
    FROM located"""

# Every place against every tile: a brute-force check of the arithmetic in the Spark query.
MEMBERS = LOCATED + _tiles(CITY) + """, members AS (
    SELECT place_id, types, i, j, round(2 * 6371008.8 * asin(sqrt(
        power(sin(radians(lat - latitude) / 2), 2)
        + cos(radians(latitude)) * cos(radians(lat)) * power(sin(radians(lon - longitude) / 2), 2)
    )), 3) AS distance_m
    FROM located, tiles
), near AS (
    SELECT * FROM members WHERE distance_m <= 700
), ranked AS (
    SELECT *, CAST(row_number() OVER (
        PARTITION BY i, j ORDER BY distance_m, place_id) AS INTEGER) AS rank
    FROM near
), results AS (
    SELECT * FROM ranked WHERE rank <= 15
), found AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY i, j, distance_m) AS nth
        FROM near
    ) WHERE nth = 1
), per_tile AS (
    SELECT t.i, t.j, count(r.place_id) AS returned, count(f.place_id) AS new
    FROM tiles t
    LEFT JOIN near r ON r.i = t.i AND r.j = t.j
    LEFT JOIN found f ON f.i = r.i AND f.j = r.j AND f.place_id = r.place_id
    GROUP BY t.i, t.j
)"""

ORACLE["tile_grid"] = _with(LOCATED + _tiles(BOUNDS),
    "SELECT i, j, round(lat, 9) AS lat, round(lon, 9) AS lon FROM tiles")
ORACLE["tile_members"] = _with(MEMBERS, "SELECT place_id, i, j, distance_m FROM near")
ORACLE["tile_type_filter"] = _with(MEMBERS, """
SELECT place_id, array_to_string(types, '|') AS place_types, i, j FROM near
WHERE list_contains(types, 'cafe') OR list_contains(types, 'bakery')""")
ORACLE["tile_topk"] = _with(MEMBERS, "SELECT i, j, rank, place_id, distance_m FROM results")
ORACLE["tile_uncovered"] = _with(MEMBERS, """
SELECT place_id FROM located WHERE place_id NOT IN (SELECT place_id FROM near)""")
ANSWERS = """answers AS (
    SELECT l_orderkey AS i, concat('place_', l_partkey) AS place_id, l_quantity AS rating,
        l_returnflag AS types, CAST(row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, concat('place_', l_partkey), l_quantity, l_returnflag) AS INTEGER)
        AS rank
    FROM lineitem
)"""
ORACLE["response_explode"] = _with(ANSWERS,
    "SELECT i, rank, place_id, CAST(rating AS DOUBLE) AS rating, types FROM answers")
ORACLE["ingest_answers"] = _with(ANSWERS, """
SELECT place_id, CAST(rating AS DOUBLE) AS rating, types FROM (
    SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY i, rank) AS nth FROM answers
) WHERE nth = 1""")
ORACLE["sweep_dedup"] = _with(MEMBERS, "SELECT place_id, i, j, distance_m FROM found")
ORACLE["sweep_stats"] = _with(MEMBERS, """
SELECT i, j, returned, new, CAST(sum(new) OVER (ORDER BY i, j) AS BIGINT) AS total FROM per_tile""")
ORACLE["sweep_gaps"] = _with(MEMBERS, """
SELECT i, j, returned, CASE WHEN returned = 0 THEN 'empty' ELSE 'crowded' END AS status
FROM per_tile WHERE returned = 0 OR returned > 15""")


def _strip(value: str, low: str, high: str) -> str:
    low, high = f"CAST({low} AS DOUBLE)", f"CAST({high} AS DOUBLE)"
    return f"""least(CAST(floor(({value} - {low}) / ({high} - {low}) * CAST(4096 AS DOUBLE)) AS BIGINT), 4095)"""


_BITS = "list_sum(list_transform(range(12), lambda i: (({y} >> i) & 1) * (2 << (2 * i)) + (({x} >> i) & 1) * (1 << (2 * i))))"
# The box is split from the top: a cell with more than 15 places gives its four quarters.
CELLS = "RECURSIVE " + LOCATED + f""", coded AS (
    SELECT place_id, {_strip("latitude", "13.65", "13.85")} AS y,
        {_strip("longitude", "100.45", "100.65")} AS x
    FROM located
    WHERE latitude BETWEEN 13.65::DOUBLE AND 13.85::DOUBLE
        AND longitude BETWEEN 100.45::DOUBLE AND 100.65::DOUBLE
), placed AS (
    SELECT place_id, CAST({_BITS.format(x="x", y="y")} AS BIGINT) AS deepest FROM coded
), cells AS (
    SELECT 0 AS level, CAST(0 AS BIGINT) AS cell, count(*) AS members FROM placed
    UNION ALL
    SELECT level + 1, deepest >> (2 * (11 - level)), count(*)
    FROM cells JOIN placed ON (deepest >> (2 * (12 - level))) = cell
    WHERE members > 15 AND level < 12 GROUP BY ALL
), leaves AS (SELECT * FROM cells WHERE members > 0 AND (members <= 15 OR level = 12))"""
_EVEN = "list_sum(list_transform(range(12), lambda i: ((cell >> (2 * i + {odd})) & 1) * (1 << i)))"
ORACLE["tile_leaves"] = _with(CELLS, f"""
SELECT level, cell, members,
    round(13.65::DOUBLE + (13.85::DOUBLE - 13.65::DOUBLE) * {_EVEN.format(odd=1)} / (1 << level), 9) AS south,
    round(100.45::DOUBLE + (100.65::DOUBLE - 100.45::DOUBLE) * {_EVEN.format(odd=0)} / (1 << level), 9) AS west
FROM leaves""")
ORACLE["tile_leaf_members"] = _with(CELLS, """
SELECT place_id, level, cell FROM placed JOIN leaves ON (deepest >> (2 * (12 - level))) = cell""")


ORACLE["circles_of_radii"] = f"""WITH p AS (
    SELECT {PLACE_ID} AS place_id, {FAR.format(key="p_partkey", step=7919, range=18001, low=90)} AS lat,
        {FAR.format(key="p_partkey", step=104729, range=36000, low=180)} AS lon FROM part
), c AS (
    SELECT c_custkey AS circle_id, {FAR.format(key="c_custkey", step=6007, range=18001, low=90)} AS lat,
        {FAR.format(key="c_custkey", step=50023, range=36000, low=180)} AS lon, {RADIUS} AS radius_m FROM customer
)
SELECT place_id, circle_id FROM p, c
WHERE round(2 * 6371008.8 * asin(least(sqrt(power(sin(radians(c.lat - p.lat) / 2), 2)
    + cos(radians(p.lat)) * cos(radians(c.lat)) * power(sin(radians(c.lon - p.lon) / 2), 2)), 1)), 3) <= radius_m"""


# -- silver ----------------------------------------------------------------------------------

ORACLE["silver_flatten"] = _with(SILVER, f"""
SELECT place_id, name, array_to_string(types, '|') AS place_types, rating, user_rating_count,
    price_level, latitude, longitude, khet, province, '{RUN_DATE}' AS ingestion_date
FROM silver""")
ORACLE["silver_missing_types"] = _with(SILVER,
    "SELECT place_id, 'other' AS category, true AS types_missing FROM silver")
ORACLE["price_level_map"] = _with(FLAT, "SELECT place_id, price_level FROM flat")
ORACLE["address_parts"] = _with(FLAT,
    "SELECT place_id, CAST(part_count AS INTEGER) AS parts, khet, province FROM flat")
ORACLE["script_filter"] = _with(FLAT, f"""SELECT place_id, khet, province FROM flat
WHERE NOT regexp_matches(khet, {THAI}) AND NOT regexp_matches(province, {THAI})""")
ORACLE["region_filter"] = _with(FLAT,
    f"SELECT place_id, province FROM flat WHERE {IN_REGION}")
ORACLE["drop_funnel"] = _with(TAGGED,
    "SELECT outcome, count(*) AS rows FROM tagged GROUP BY outcome")


# -- merge -----------------------------------------------------------------------------------

def _sightings(name: str, date: str, condition: str) -> str:
    return f"""{name} AS (
    SELECT {PLACE_ID} AS place_id, max(l_quantity) / CAST(10 AS DOUBLE) AS rating,
        CAST(count(*) AS INTEGER) AS user_rating_count, '{date}' AS ingestion_date
    FROM part JOIN lineitem ON p_partkey = l_partkey
    WHERE {condition}
    GROUP BY p_partkey
)"""


DAY = "CAST(l_shipdate AS DATE)"


def _batches(count: int) -> str:
    """All reviews as so many batches: the last one has all that are left."""
    edges = ["DATE '0001-01-01'", *(f"DATE '{x}'" for x in BATCH_STARTS[:count - 1])]
    ends = [*edges[1:], "DATE '9999-12-31'"]
    spans = [
        _sightings(f"b{k + 1}", BATCH_DATES[k], f"{DAY} >= {edges[k]} AND {DAY} < {ends[k]}")
        for k in range(count)
    ]
    every = " UNION ALL ".join(f"SELECT {k + 1} AS run, * FROM b{k + 1}" for k in range(count))
    return ",\n".join(spans) + f", every AS ({every})"



def _latest(runs: int) -> str:
    """The last sighting of each place wins; its first date is kept."""
    return _with(_batches(runs), """
SELECT place_id, rating, user_rating_count, ingestion_date, first_seen_date FROM (
    SELECT *, min(ingestion_date) OVER (PARTITION BY place_id) AS first_seen_date,
        row_number() OVER (PARTITION BY place_id ORDER BY run DESC) AS nth
    FROM every
) WHERE nth = 1""")


ORACLE["merge_first_run"] = _latest(1)
ORACLE["merge_carryover"] = _with(_batches(2), """
SELECT place_id, rating, user_rating_count FROM b1
WHERE place_id NOT IN (SELECT place_id FROM b2)""")
ORACLE["first_seen"] = _with(_batches(2), """
SELECT place_id, min(ingestion_date) AS first_seen_date FROM every
GROUP BY place_id""")
ORACLE["silver_merge"] = _latest(2)
ORACLE["silver_merge_shuffled"] = ORACLE["silver_merge"]
ORACLE["silver_table"] = _latest(3)
ORACLE["silver_table_bucketed"] = ORACLE["silver_table"]
ORACLE["silver_parts"] = ORACLE["silver_table"]

ORACLE["place_states"] = _with(_batches(3), f"""
, named AS (
    SELECT e.*, p_name AS name, {" ".join(f"CASE WHEN run = {k + 1} THEN '{d}' ELSE" for k, d in enumerate(BATCH_DATES[1:]))} NULL
        {"END " * (len(BATCH_DATES) - 1)} AS next_date
    FROM every e JOIN part ON place_id = {PLACE_ID}
), steps AS (
    SELECT *, lag(run) OVER o AS old_run, lag(rating) OVER o AS old_rating
    FROM named WINDOW o AS (PARTITION BY place_id ORDER BY run)
), runs AS (
    SELECT *, sum(CASE WHEN old_run = run - 1 AND old_rating = rating THEN 0 ELSE 1 END)
        OVER (PARTITION BY place_id ORDER BY run) AS nth
    FROM steps
), held AS (
    SELECT place_id, nth, min(name) AS name, min(rating) AS rating, min(ingestion_date) AS valid_from,
        arg_max(coalesce(next_date, '-'), run) AS until, min(run) AS first_run, max(run) AS last_run,
        arg_min(CASE WHEN old_run IS NULL THEN '-' WHEN old_rating <> rating THEN 'rating' ELSE '' END, run) AS how
    FROM runs GROUP BY place_id, nth
)
SELECT place_id, name, rating, valid_from, nullif(until, '-') AS valid_to, nullif(how, '-') AS changed,
    last_run < 3 AND coalesce(lead(first_run) OVER (PARTITION BY place_id ORDER BY nth), 0) <> last_run + 1 AS vanished
FROM held""")

LATEST = _batches(3) + f""", latest AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY place_id ORDER BY run DESC) AS nth FROM every
    ) WHERE nth = 1
), described AS (
    SELECT {PLACE_ID} AS place_id, p_name AS name, string_split({TYPE_NAMES}, ' ') AS types,
        {LATITUDE} AS latitude, {LONGITUDE} AS longitude, concat_ws(' ', p_brand, p_type) AS khet
    FROM part
), silver AS (
    SELECT d.*, {CATEGORY} AS category, rating, user_rating_count, CAST(NULL AS INTEGER) AS price_level,
        'Bangkok' AS province
    FROM latest JOIN described d USING (place_id)
)""" + _gold()

ORACLE["upkeep_counts"] = _with(LATEST, """SELECT khet, rating, count(*) AS places
FROM silver WHERE user_rating_count >= 5 GROUP BY khet, rating""")
ORACLE["upkeep_scored"] = _with(LATEST, "SELECT * FROM scored")
ORACLE["upkeep_unqualified"] = _with(LATEST, "SELECT * FROM unqualified")


# -- gold ------------------------------------------------------------------------------------

ORACLE["category"] = _with(SILVER, "SELECT place_id, category FROM silver")
ORACLE["category_counts"] = _with(SILVER,
    "SELECT category, count(*) AS places FROM silver GROUP BY category")
ORACLE["district_stats"] = _with(GOLD, "SELECT * FROM stats")
ORACLE["district_stats_exact"] = ORACLE["district_stats"]
ORACLE["district_stats_approx"] = ORACLE["district_stats"]
ORACLE["small_groups"] = _with(GOLD, """
SELECT place_id, s.khet, khet_candidate_count FROM silver s JOIN stats t ON s.khet = t.khet
WHERE user_rating_count >= 5 AND khet_candidate_count < 5""")
ORACLE["gold_scored"] = _with(GOLD, "SELECT * FROM scored")
ORACLE["gold_unqualified"] = _with(GOLD, "SELECT * FROM unqualified")
ORACLE["gold_partition"] = _with(GOLD, """
SELECT outcome, count(*) AS places, count(DISTINCT place_id) AS ids FROM (
    SELECT place_id, 'scored' AS outcome FROM scored
    UNION ALL SELECT place_id, reason FROM unqualified
) GROUP BY outcome""")
ORACLE["top_gems"] = _with(GOLD, """
SELECT place_id, khet, rating, gem_score FROM scored
ORDER BY gem_score DESC, place_id LIMIT 20""")


def _gap(table: str, key: str, group: str, measure: str, enough: str = "true") -> str:
    return f"""
WITH stats AS (
    SELECT {group}, count(*) AS group_size, quantile_disc({measure}, 0.5) AS median
    FROM {table} WHERE {enough} GROUP BY {group}
), judged AS (
    SELECT t.{key}, t.{group}, t.{measure}, group_size, median,
        CASE WHEN NOT ({enough}) THEN 'low_support' WHEN group_size >= 5 THEN 'scored'
            WHEN group_size < 5 THEN 'small_group' END AS outcome
    FROM {table} t LEFT JOIN stats s ON t.{group} = s.{group}
)
SELECT {key}, {group}, {measure},
    CASE WHEN outcome <> 'low_support' THEN group_size END AS group_size,
    CASE WHEN outcome = 'scored' THEN median END AS group_median,
    CASE WHEN outcome = 'scored' THEN round({measure} - median, 2) END AS gap, outcome
FROM judged"""


ORACLE["gap_customer_nation"] = _gap("customer", "c_custkey", "c_nationkey", "c_acctbal")
ORACLE["gap_part_brand"] = _gap("part", "p_partkey", "p_brand", "p_retailprice", "p_size >= 5")
ORACLE["gap_event_type"] = _gap("events", "event_id", "event_type", "value")
ORACLE["gap_line_price"] = _gap(
    "(SELECT *, concat(l_orderkey, '-', l_linenumber) AS line FROM lineitem)",
    "line", "l_returnflag", "l_extendedprice", "l_quantity >= 5")


# -- gates -----------------------------------------------------------------------------------

def _checks(counts: dict[str, str], source: str) -> str:
    """One row per check from a query that yields its failed rows."""
    rows = "\nUNION ALL ".join(
        f"SELECT '{name}' AS \"check\", CAST({failed} AS BIGINT) AS failed_rows FROM {source}"
        for name, failed in counts.items()
    )
    return f"""SELECT "check", failed_rows,
    CASE WHEN failed_rows > 0 THEN 'fail' ELSE 'pass' END AS status FROM ({rows})"""


SILVER_COUNTS = {
    "row_count": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
    "required_columns": "count(*) FILTER (WHERE false)",
    "no_null_place_ids": "count(*) FILTER (WHERE place_id IS NULL)",
    "no_duplicate_place_ids": "count(*) - count(DISTINCT place_id)",
    "rating_range": "count(*) FILTER (WHERE rating < 1 OR rating > 5)",
    "user_rating_count": "count(*) FILTER (WHERE user_rating_count < 1)",
    "province_in_region": f"count(*) FILTER (WHERE NOT ({IN_REGION}))",
}
NULL_COUNTS = {
    f"no_null_{c}": f"count(*) FILTER (WHERE {c} IS NULL)"
    for c in ("rating", "user_rating_count", "khet", "province")
}
ORACLE["gate_silver"] = _with(SILVER, _checks(SILVER_COUNTS, "silver"))
ORACLE["gate_silver_unfiltered"] = _with(FLAT, _checks(SILVER_COUNTS | NULL_COUNTS, "flat"))


def _gold_gate(unqualified: str) -> str:
    """Null scores never occur in these tables, so the score formula is always checked."""
    scored = _checks({
        "scored_row_count": "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END",
        "no_null_gem_score": "count(*) FILTER (WHERE gem_score IS NULL)",
        "no_null_khet_median": "count(*) FILTER (WHERE khet_median_rating IS NULL)",
        "gem_score_math": "count(*) FILTER (WHERE "
                          "abs(gem_score - round(rating - khet_median_rating, 2)) > 0.001)",
    }, "scored")
    reasons = _checks({
        "valid_reasons": "count(*) FILTER (WHERE "
                         "reason NOT IN ('low_review_count', 'khet_sample_too_small'))",
        "no_null_reasons": "count(*) FILTER (WHERE reason IS NULL)",
    }, unqualified)
    both = _checks({"no_place_id_overlap": "count(*)"}, f"""(
        SELECT place_id FROM scored INTERSECT SELECT place_id FROM {unqualified})""")
    return f"{scored}\nUNION ALL {reasons}\nUNION ALL {both}"


MISMATCHED = GOLD + _gold(8, "8")
ORACLE["gate_gold"] = _with(GOLD, _gold_gate("unqualified"))
ORACLE["gate_gold_mismatched"] = _with(MISMATCHED, _gold_gate("unqualified8"))
ORACLE["gold_overlap"] = _with(MISMATCHED,
    "SELECT place_id FROM scored INTERSECT SELECT place_id FROM unqualified8")


# -- publishing and whole runs ---------------------------------------------------------------

ORACLE["publish_scored"] = ORACLE["gold_scored"]
ORACLE["full_run"] = ORACLE["gold_scored"]
ORACLE["publish_counts"] = _with(GOLD, """
SELECT 'scored_places' AS table_name, count(*) AS rows FROM scored
UNION ALL SELECT 'unqualified_places', count(*) FROM unqualified""")
ORACLE["layer_counts"] = _with(GOLD, """
SELECT 'bronze' AS layer, count(*) AS rows FROM raw
UNION ALL SELECT 'batch', count(*) FROM silver
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'scored_places', count(*) FROM scored
UNION ALL SELECT 'unqualified_places', count(*) FROM unqualified
UNION ALL SELECT concat('dropped:', r.rule), count(t.outcome)
FROM (VALUES ('missing_id'), ('missing_signal'), ('thai_script'), ('outside_region')) r(rule)
LEFT JOIN tagged t ON t.outcome = r.rule GROUP BY r.rule
UNION ALL SELECT 'dropped:neither_gold_table',
    (SELECT count(*) FROM silver) - (SELECT count(*) FROM scored)
    - (SELECT count(*) FROM unqualified)""")

ORACLE["publish_reconciled"] = _with(GOLD, """
SELECT 'scored_places' AS table_name, count(*) AS rows, true AS same_content FROM scored
UNION ALL SELECT 'unqualified_places', count(*), true FROM unqualified""")
# An estimate is no value that another engine finds; what is compared is that its rank is near.
ORACLE["district_sketches"] = """SELECT l_returnflag AS district, count(l_extendedprice) AS n, true AS near
FROM lineitem GROUP BY l_returnflag"""
