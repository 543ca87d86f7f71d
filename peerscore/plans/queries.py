"""The registered queries: each reads the given tables whole and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.functions import address_parts, district, has_thai, in_region, price_level, province
from peerscore.operators import cells, circles, history, quality, scoring, silver, sketches, tiles
from peerscore.operators import merge as merging
from peerscore.plans import tables
from peerscore.plans.ingest import land_answers
from peerscore.plans.pipeline import (
    SCORED,
    UNQUALIFIED,
    PipelineConfig,
    next_silver,
    run_pipeline,
)
from peerscore.plans.tables import RUN_DATE, batches, raw_places, silver_places, silver_rows
from peerscore.plans.upkeep import apply_batch, places_store
from peerscore.session import scratch_path, stage
from peerscore.sources import arrays, bronze, catalog
from peerscore.sources.versions import VersionedTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def joined(types: str = "place_types"):
    return F.array_join(types, "|").alias(types)


# -- raw snapshots ---------------------------------------------------------------------------

@query
def bronze_scan(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    bronze.write_bronze(raw_places(spark, sf_dir), path)
    return bronze.read_bronze(spark, path).select(
        "id",
        F.col("displayName.text").alias("name"),
        F.col("location.latitude").try_cast("double").alias("latitude"),
        F.col("location.longitude").try_cast("double").alias("longitude"),
        F.col("rating").try_cast("double").alias("rating"),
        "priceLevel",
        F.col("userRatingCount").try_cast("int").alias("userRatingCount"),
        F.col(bronze.CORRUPT).isNotNull().alias("corrupt"),
    )


@query
def bronze_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "bronze")
    bronze.write_bronze(raw_places(spark, sf_dir), path)
    return bronze.read_bronze(spark, path).select("id", "formattedAddress", joined("types"))


@query
def bronze_arrays(spark, sf_dir):
    """The snapshot as files of one array each, of at most 5,000 places."""
    path = scratch_path(spark, "bronze")
    number = F.expr("CAST(substring(id, 7) AS BIGINT) DIV 5000")
    bronze.write_arrays(raw_places(spark, sf_dir), path, number)
    return bronze.read_bronze(spark, path, multi_line=True).select(
        "id", "formattedAddress", F.col("rating").try_cast("double").alias("rating"),
        joined("types"), F.col(bronze.CORRUPT).isNotNull().alias("corrupt"),
    )


@query
def bronze_large_arrays(spark, sf_dir):
    """The snapshot as arrays of at most 5,000 places, each cut into records by several tasks."""
    path = scratch_path(spark, "bronze")
    number = F.expr("CAST(substring(id, 7) AS BIGINT) DIV 5000")
    bronze.write_arrays(raw_places(spark, sf_dir), path, number)
    return arrays.read_arrays(spark, path, per_range=1 << 11).select(
        "id", "formattedAddress", F.col("rating").try_cast("double").alias("rating"),
        F.col("displayName.text").alias("name"), joined("types"),
        F.col(bronze.CORRUPT).isNotNull().alias("corrupt"),
    )


@query
def bronze_snapshot(spark, sf_dir):
    root = scratch_path(spark, "lake")
    raw = raw_places(spark, sf_dir)
    bronze.land_snapshot(raw.filter("rating IS NOT NULL"), root, "2026-08-20")
    bronze.land_snapshot(raw, root, RUN_DATE)
    days = {"2026-08-20": "2026-08-20", "latest": None}
    counts = [
        bronze.read_snapshot(spark, root, day).groupBy(F.lit(label).alias("snapshot"))
        .agg(F.count("id").alias("places"), F.count("rating").alias("rated"))
        for label, day in days.items()
    ]
    return counts[0].unionByName(counts[1])


# -- tile sweep ------------------------------------------------------------------------------

def _members(spark, sf_dir):
    members = tiles.tile_members(tables.located_places(spark, sf_dir), tiles.Grid())
    return stage(members.select("place_id", "i", "j", "distance_m"), "members")


@query
def tile_grid(spark, sf_dir):
    grid = tiles.bounding_grid(tables.located_places(spark, sf_dir))
    return tiles.tiles(spark, grid).select(
        "i", "j", F.round("lat", 9).alias("lat"), F.round("lon", 9).alias("lon")
    )


@query
def tile_members(spark, sf_dir):
    members = tiles.tile_members(tables.located_places(spark, sf_dir), tiles.Grid())
    return members.select("place_id", "i", "j", "distance_m")


@query
def tile_type_filter(spark, sf_dir):
    members = tiles.tile_members(tables.located_places(spark, sf_dir), tiles.Grid())
    return tiles.of_types(members).select("place_id", joined(), "i", "j")


@query
def tile_topk(spark, sf_dir):
    members = tiles.tile_members(tables.located_places(spark, sf_dir), tiles.Grid())
    return tiles.search_results(members).select("i", "j", "rank", "place_id", "distance_m")


@query
def tile_uncovered(spark, sf_dir):
    return tiles.uncovered(tables.located_places(spark, sf_dir), tiles.Grid()).select("place_id")


def _landed_answers(spark, sf_dir):
    path = scratch_path(spark, "answers")
    tables.order_answers(spark, sf_dir).write.json(path)
    return path


@query
def response_explode(spark, sf_dir):
    answers = bronze.read_answers(spark, _landed_answers(spark, sf_dir))
    return bronze.explode_responses(answers).select(
        "i", "rank", F.col("id").alias("place_id"),
        F.col("rating").try_cast("double").alias("rating"), joined("types"),
    )


@query
def ingest_answers(spark, sf_dir):
    root = scratch_path(spark, "lake")
    land_answers(spark, _landed_answers(spark, sf_dir), root, RUN_DATE)
    return bronze.read_snapshot(spark, root).select(
        F.col("id").alias("place_id"), F.col("rating").try_cast("double").alias("rating"),
        joined("types"),
    )


@query
def sweep_dedup(spark, sf_dir):
    members = tiles.tile_members(tables.located_places(spark, sf_dir), tiles.Grid())
    return tiles.first_found(members).select("place_id", "i", "j", "distance_m")


@query
def sweep_stats(spark, sf_dir):
    return tiles.sweep_stats(spark, tiles.Grid(), _members(spark, sf_dir)).select(
        "i", "j", "returned", "new", "total"
    )


@query
def sweep_gaps(spark, sf_dir):
    members = tiles.tile_members(tables.located_places(spark, sf_dir), tiles.Grid())
    return tiles.sweep_gaps(spark, tiles.Grid(), members)


@query
def tile_leaves(spark, sf_dir):
    """Cells that a search returns whole, instead of crowded tiles that it cuts."""
    found = cells.leaves(tables.located_places(spark, sf_dir), tiles.Grid())
    return cells.with_box(found, tiles.Grid()).select(
        "level", "cell", "members", F.round("south", 9).alias("south"), F.round("west", 9).alias("west")
    )


@query
def tile_leaf_members(spark, sf_dir):
    places = tables.located_places(spark, sf_dir)
    found = cells.leaves(places, tiles.Grid())
    return cells.leaf_of_each(places, tiles.Grid(), found).select("place_id", "level", "cell")


@query
def circles_of_radii(spark, sf_dir):
    """Places all over the sphere in circles of 1 to 512 km, one per customer."""
    found = circles.circle_members(tables.far_places(spark, sf_dir), tables.far_circles(spark, sf_dir))
    return found.select("place_id", "circle_id")


# -- silver ----------------------------------------------------------------------------------

def _dated(df, *names):
    return df.withColumns({n: F.col(n).cast("string") for n in names})


@query
def silver_flatten(spark, sf_dir):
    rows = silver.clean(raw_places(spark, sf_dir), RUN_DATE)
    return _dated(rows, "ingestion_date").withColumn("place_types", joined())


@query
def silver_missing_types(spark, sf_dir):
    rows = silver.clean(raw_places(spark, sf_dir).drop("types"), RUN_DATE)
    return scoring.add_category(rows).select(
        "place_id", "category", F.col("place_types").isNull().alias("types_missing")
    )


@query
def price_level_map(spark, sf_dir):
    return raw_places(spark, sf_dir).select(
        F.col("id").alias("place_id"), price_level(F.col("priceLevel")).alias("price_level")
    )


@query
def address_parts_of(spark, sf_dir):
    parts = F.col("parts")
    return (
        raw_places(spark, sf_dir)
        .select(F.col("id").alias("place_id"), address_parts(F.col("formattedAddress")).alias("parts"))
        .select(
            "place_id", F.size(parts).alias("parts"),
            district(parts).alias("khet"), province(parts).alias("province"),
        )
    )


QUERIES["address_parts"] = QUERIES.pop("address_parts_of")


@query
def script_filter(spark, sf_dir):
    return silver.flatten(raw_places(spark, sf_dir), RUN_DATE).filter(
        ~has_thai(F.col("khet")) & ~has_thai(F.col("province"))
    ).select("place_id", "khet", "province")


@query
def region_filter(spark, sf_dir):
    return silver.flatten(raw_places(spark, sf_dir), RUN_DATE).filter(
        in_region(F.col("province"))
    ).select("place_id", "province")


@query
def drop_funnel(spark, sf_dir):
    return silver.drop_funnel(raw_places(spark, sf_dir), RUN_DATE)


# -- merge -----------------------------------------------------------------------------------

MERGED = ["place_id", "rating", "user_rating_count", "ingestion_date", "first_seen_date"]


def _merged(df):
    return _dated(df.select(*MERGED), "ingestion_date", "first_seen_date")


@query
def merge_first_run(spark, sf_dir):
    table = VersionedTable(spark, scratch_path(spark, "silver-table"))
    table.replace(next_silver(table, batches(spark, sf_dir, 1)[0]))
    return _merged(table.read())


@query
def merge_carryover(spark, sf_dir):
    first, second = batches(spark, sf_dir, 2)
    kept = merging.carried_over(silver.first_version(first), second)
    return kept.select("place_id", "rating", "user_rating_count")


@query
def first_seen(spark, sf_dir):
    first, second = batches(spark, sf_dir, 2)
    return _dated(merging.first_seen(silver.first_version(first), second), "first_seen_date")


@query
def silver_merge(spark, sf_dir):
    first, second = batches(spark, sf_dir, 2)
    return _merged(merging.merge(silver.first_version(first), second))


@query
def silver_merge_shuffled(spark, sf_dir):
    first, second = batches(spark, sf_dir, 2)
    return _merged(merging.merge(silver.first_version(first), second, full_outer=True))


@query
def silver_table(spark, sf_dir):
    table = VersionedTable(spark, scratch_path(spark, "silver-table"))
    for batch in batches(spark, sf_dir, 3):
        table.replace(next_silver(table, batch))
    return _merged(table.read())


@query
def silver_table_bucketed(spark, sf_dir):
    table = VersionedTable(spark, scratch_path(spark, "silver-table"), buckets=16)
    for batch in batches(spark, sf_dir, 3):
        table.replace(next_silver(table, batch))
    return _merged(table.read())


@query
def place_states(spark, sf_dir):
    """The batches as snapshots: from when to when every place had which best rating."""
    first, *others = batches(spark, sf_dir, 3)
    rows = first
    for more in others:
        rows = rows.unionByName(more)
    found = history.states(rows, ["name", "rating"])
    return _dated(found, "valid_from", "valid_to").withColumn("changed", joined("changed"))


def _kept_up(spark, sf_dir):
    """A store after three batches, each of which rewrote only the parts that it touched."""
    store = places_store(spark, scratch_path(spark, "parts"), parts=16)
    for batch in batches(spark, sf_dir, 3):
        apply_batch(store, batch, gates=False)
    return store


@query
def silver_parts(spark, sf_dir):
    return _merged(_kept_up(spark, sf_dir).read("silver"))


# -- gold ------------------------------------------------------------------------------------

@query
def upkeep_counts(spark, sf_dir):
    return _kept_up(spark, sf_dir).read("state")


@query
def upkeep_scored(spark, sf_dir):
    return _kept_up(spark, sf_dir).read(SCORED)


@query
def upkeep_unqualified(spark, sf_dir):
    return _kept_up(spark, sf_dir).read(UNQUALIFIED)


@query
def category(spark, sf_dir):
    return scoring.add_category(silver_rows(spark, sf_dir)).select("place_id", "category")


@query
def category_counts(spark, sf_dir):
    return scoring.category_counts(silver_rows(spark, sf_dir))


@query
def district_stats(spark, sf_dir):
    return scoring.district_stats(silver_rows(spark, sf_dir))


@query
def district_stats_exact(spark, sf_dir):
    return scoring.district_stats(silver_places(spark, sf_dir), method="exact")


@query
def district_stats_approx(spark, sf_dir):
    return scoring.district_stats(silver_rows(spark, sf_dir), method="approx")


@query
def small_groups(spark, sf_dir):
    return scoring.small_groups(silver_places(spark, sf_dir))


@query
def gold_scored(spark, sf_dir):
    return scoring.score_places(silver_places(spark, sf_dir))[0]


@query
def gold_unqualified(spark, sf_dir):
    return scoring.score_places(silver_places(spark, sf_dir))[1]


@query
def gold_partition(spark, sf_dir):
    places = silver_places(spark, sf_dir)
    scored, unqualified = scoring.score_places(places)
    landed = scored.select("place_id", F.lit("scored").alias("outcome")).unionByName(
        unqualified.select("place_id", F.col("reason").alias("outcome"))
    )
    return landed.groupBy("outcome").agg(
        F.count("*").alias("places"), F.count_distinct("place_id").alias("ids")
    )


@query
def top_gems(spark, sf_dir):
    scored, _ = scoring.score_places(silver_places(spark, sf_dir))
    return scoring.top_gems(scored).select("place_id", "khet", "rating", "gem_score")


@query
def gap_customer_nation(spark, sf_dir):
    customer = tables.table(spark, sf_dir, "customer")
    return scoring.gap_to_group_median(customer, "c_custkey", "c_nationkey", "c_acctbal")


@query
def gap_part_brand(spark, sf_dir):
    part = tables.table(spark, sf_dir, "part")
    return scoring.gap_to_group_median(
        part, "p_partkey", "p_brand", "p_retailprice", support="p_size"
    )


@query
def gap_line_price(spark, sf_dir):
    """Nearly every price differs, and a return flag has a third of all lines or more."""
    lines = tables.table(spark, sf_dir, "lineitem").withColumn(
        "line", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    return scoring.gap_to_group_median(
        lines, "line", "l_returnflag", "l_extendedprice", support="l_quantity"
    )


@query
def gap_event_type(spark, sf_dir):
    events = tables.table(spark, sf_dir, "events")
    return scoring.gap_to_group_median(events, "event_id", "event_type", "value")


@query
def district_sketches(spark, sf_dir):
    """Medians from sketches of each district and month, merged, against the ranks of all values."""
    lines = tables.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("district"), F.month("l_shipdate").alias("month"), "l_extendedprice"
    )
    stored = stage(sketches.sketch(lines, ["district", "month"], "l_extendedprice"), "sketches")
    merged = sketches.merge(stored, ["district"]).withColumn("estimate", sketches.quantile())
    ranks = sketches.rank_range(lines, ["district"], "l_extendedprice", merged)
    error = 3 * sketches.rank_error()
    near = (F.col("below") <= (0.5 + error) * F.col("n")) & (F.col("up_to") >= (0.5 - error) * F.col("n"))
    return ranks.select("district", "n", near.alias("near"))


# -- gates -----------------------------------------------------------------------------------

@query
def gate_silver(spark, sf_dir):
    return quality.silver_checks(silver_rows(spark, sf_dir))


@query
def gate_silver_unfiltered(spark, sf_dir):
    rows = silver.first_version(silver.flatten(raw_places(spark, sf_dir), RUN_DATE))
    return quality.silver_checks(rows).unionByName(quality.null_checks(rows))


def _gold(spark, sf_dir):
    scored, unqualified = scoring.score_places(silver_places(spark, sf_dir))
    return stage(scored, "scored"), stage(unqualified, "unqualified")


@query
def gate_gold(spark, sf_dir):
    return quality.gold_checks(*_gold(spark, sf_dir))


@query
def gate_gold_mismatched(spark, sf_dir):
    """Tables of two different thresholds overlap, and the gate must say so."""
    places = silver_places(spark, sf_dir)
    scored, _ = scoring.score_places(places)
    _, unqualified = scoring.score_places(places, min_reviews=8)
    return quality.gold_checks(stage(scored, "scored"), stage(unqualified, "unqualified"))


@query
def gold_overlap(spark, sf_dir):
    places = silver_places(spark, sf_dir)
    scored, _ = scoring.score_places(places)
    _, unqualified = scoring.score_places(places, min_reviews=8)
    return quality.overlap(scored, unqualified)


# -- publishing and whole runs ---------------------------------------------------------------

def _published(spark, sf_dir, database):
    catalog.ensure_database(spark, database, scratch_path(spark, database))
    scored, unqualified = _gold(spark, sf_dir)
    return catalog.publish_all({SCORED: scored, UNQUALIFIED: unqualified}, database)


@query
def publish_scored(spark, sf_dir):
    _published(spark, sf_dir, "peerscore_scored")
    return spark.table(f"peerscore_scored.{SCORED}")


@query
def publish_counts(spark, sf_dir):
    counts = _published(spark, sf_dir, "peerscore_counts")
    return spark.createDataFrame(list(counts.items()), "table_name string, rows long")


@query
def publish_reconciled(spark, sf_dir):
    """Published tables against what was scored, by content and not by number alone."""
    catalog.ensure_database(spark, "peerscore_reconciled", scratch_path(spark, "peerscore_reconciled"))
    sent = dict(zip((SCORED, UNQUALIFIED), _gold(spark, sf_dir), strict=True))
    catalog.publish_all(sent, "peerscore_reconciled")
    rows = []
    for name, df in sent.items():
        arrived = catalog.content(spark.table(f"peerscore_reconciled.{name}"))
        rows.append((name, arrived["rows"], arrived == catalog.content(df)))
    return spark.createDataFrame(rows, "table_name string, rows long, same_content boolean")


def _run(spark, sf_dir):
    root = scratch_path(spark, "lake")
    path = bronze.land_snapshot(raw_places(spark, sf_dir), root, RUN_DATE)
    cfg = PipelineConfig(path, f"{root}/silver", f"{root}/gold", RUN_DATE)
    return cfg, run_pipeline(spark, cfg)


@query
def full_run(spark, sf_dir):
    cfg, _ = _run(spark, sf_dir)
    return VersionedTable(spark, cfg.gold_path).read_part(SCORED)


@query
def layer_counts(spark, sf_dir):
    _, report = _run(spark, sf_dir)
    rows = list(report.rows.items()) + [(f"dropped:{k}", n) for k, n in report.dropped.items()]
    return spark.createDataFrame(rows, "layer string, rows long")
