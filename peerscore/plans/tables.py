"""Places and batches derived from the given tables.

Places come from ``part``; review counts come from all of its ``lineitem`` rows; districts,
coordinates and dirty values are arithmetic on the key. The SQL fragments are the input
definition, shared with the oracle SQL because they mean the same in both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peerscore.operators.silver import clean, first_version
from peerscore.session import stage

RUN_DATE = "2026-08-27"
# Every line counts; the remainder makes places with few and with enough reviews.
REVIEWS = "count(*) % 11"

PLACE_ID = "concat('place_', p_partkey)"
RATING = """CASE WHEN p_partkey % 23 = 0 THEN NULL
    ELSE CAST(10 + (p_partkey * 37) % 41 AS DOUBLE) / CAST(10 AS DOUBLE) END"""
PRICE = """CASE p_partkey % 7 WHEN 0 THEN 'PRICE_LEVEL_FREE' WHEN 1 THEN 'PRICE_LEVEL_INEXPENSIVE'
    WHEN 2 THEN 'PRICE_LEVEL_MODERATE' WHEN 3 THEN 'PRICE_LEVEL_EXPENSIVE'
    WHEN 4 THEN 'PRICE_LEVEL_VERY_EXPENSIVE' WHEN 5 THEN 'PRICE_LEVEL_UNSPECIFIED' END"""
ADDRESS = """CASE WHEN p_partkey % 31 = 0 THEN concat(p_partkey, ' Road, Thailand')
    WHEN p_partkey % 29 = 0 THEN concat(p_partkey, ' Road, ตลาดริมน้ำ, Bangkok 10110, Thailand')
    WHEN p_partkey % 19 = 0
        THEN concat(p_partkey, ' Road, Tambon X, Mueang, Chiang Mai 50200, Thailand')
    ELSE concat(p_partkey, ' Road, Khwaeng ', p_type, ', ',
        CASE WHEN p_partkey % 2 = 0 THEN 'Khet ' ELSE '' END, p_brand, ' ', p_type, ', ',
        CASE WHEN p_partkey % 3 = 0 THEN 'Bangkok' ELSE 'Krung Thep Maha Nakhon' END,
        ' 10110, Thailand') END"""
LATITUDE = """CAST(13.65 AS DOUBLE)
    + CAST((p_partkey * 7919) % 2000 AS DOUBLE) / CAST(10000 AS DOUBLE)"""
LONGITUDE = """CAST(100.45 AS DOUBLE)
    + CAST((p_partkey * 104729) % 2003 AS DOUBLE) / CAST(10000 AS DOUBLE)"""
# Coordinates in hundredths of a degree, from -low up.
FAR = "CAST(({key} * {step}) % {range} AS DOUBLE) / CAST(100 AS DOUBLE) - CAST({low} AS DOUBLE)"
RADIUS = "CAST(1000.5 AS DOUBLE) * power(CAST(2 AS DOUBLE), c_custkey % 10)"
TYPE_NAMES = "replace(replace(p_name, 'small', 'cafe'), 'widget', 'bakery')"

# Sightings for the merge: the first batch has the reviews before the first date, the last batch
# all that are left. The later batches are short, so that not every place is in each.
BATCH_STARTS = ("2001-07-01", "2001-10-01")
BATCH_DATES = ("2001-07-01", "2001-10-01", "2001-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw place objects, one per part."""
    reviews = (
        table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.expr(REVIEWS).alias("cnt"))
    )
    part = table(spark, sf_dir, "part")
    return part.join(reviews, part.p_partkey == reviews.l_partkey, "left").select(
        F.expr(PLACE_ID).alias("id"),
        F.struct(F.col("p_name").alias("text"), F.lit("en").alias("languageCode"))
        .alias("displayName"),
        F.expr(ADDRESS).alias("formattedAddress"),
        F.struct(F.expr(LATITUDE).alias("latitude"), F.expr(LONGITUDE).alias("longitude"))
        .alias("location"),
        F.expr(RATING).alias("rating"),
        F.expr(PRICE).alias("priceLevel"),
        F.coalesce("cnt", F.lit(0)).cast("int").alias("userRatingCount"),
        F.split(F.expr(TYPE_NAMES), " ").alias("types"),
    )


def order_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search answers (i, j, places), one per order: the parts of its lines in line order.

    The part numbers of a line repeat across orders as places repeat across overlapping circles.
    An order has a handful of lines.
    """
    place = F.struct(
        F.concat(F.lit("place_"), "l_partkey").alias("id"),
        F.col("l_quantity").alias("rating"),
        F.array("l_returnflag").alias("types"),
    )
    line = F.struct("l_linenumber", place.alias("place"))
    return (
        table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("i"))
        .agg(F.sort_array(F.collect_list(line)).alias("lines"))
        .select("i", F.lit(0).alias("j"), F.col("lines.place").alias("places"))
    )


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows of a first run, for queries that read them once."""
    return first_version(clean(raw_places(spark, sf_dir), RUN_DATE))


def silver_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as a stored table, for queries that read it more than once."""
    return stage(silver_rows(spark, sf_dir), "silver")


def located_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places as the search service sees them: id, types, coordinates."""
    return table(spark, sf_dir, "part").select(
        F.expr(PLACE_ID).alias("place_id"),
        F.split(F.expr(TYPE_NAMES), " ").alias("place_types"),
        F.expr(LATITUDE).alias("latitude"),
        F.expr(LONGITUDE).alias("longitude"),
    )


def far_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places all over the sphere, the poles and both sides of 180 degrees included."""
    return table(spark, sf_dir, "part").select(
        F.expr(PLACE_ID).alias("place_id"),
        F.expr(FAR.format(key="p_partkey", step=7919, range=18001, low=90)).alias("latitude"),
        F.expr(FAR.format(key="p_partkey", step=104729, range=36000, low=180)).alias("longitude"),
    )


def far_circles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A circle per customer, of 1 to 512 km."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("circle_id"),
        F.expr(FAR.format(key="c_custkey", step=6007, range=18001, low=90)).alias("latitude"),
        F.expr(FAR.format(key="c_custkey", step=50023, range=36000, low=180)).alias("longitude"),
        F.expr(RADIUS).alias("radius_m"),
    )


def sightings(
    spark: SparkSession, sf_dir: str, date: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Batch rows of the parts reviewed in [start, end), stamped with an ingestion date.

    The rating is the largest reviewed quantity in tens, so it changes from batch to batch.
    """
    day = F.col("l_shipdate").cast("date")
    lines = table(spark, sf_dir, "lineitem")
    if start:
        lines = lines.filter(day >= F.lit(start).cast("date"))
    if end:
        lines = lines.filter(day < F.lit(end).cast("date"))
    seen = lines.groupBy("l_partkey").agg(
        (F.max("l_quantity") / 10).alias("rating"), F.count("*").cast("int").alias("cnt")
    )
    # Parts grow with the lines; Spark would broadcast them if their file were well compressed.
    part = table(spark, sf_dir, "part").hint("merge")
    return part.join(seen, part.p_partkey == seen.l_partkey).select(
        F.expr(PLACE_ID).alias("place_id"),
        F.col("p_name").alias("name"),
        F.split(F.expr(TYPE_NAMES), " ").alias("place_types"),
        "rating",
        F.col("cnt").alias("user_rating_count"),
        F.lit(None).cast("int").alias("price_level"),
        F.expr(LATITUDE).alias("latitude"),
        F.expr(LONGITUDE).alias("longitude"),
        F.concat_ws(" ", "p_brand", "p_type").alias("khet"),
        F.lit("Bangkok").alias("province"),
        F.lit(date).cast("date").alias("ingestion_date"),
    )


def batches(spark: SparkSession, sf_dir: str, count: int) -> list[DataFrame]:
    """All reviews as so many stored batches in date order; most places appear in several."""
    edges = [None, *BATCH_STARTS[: count - 1], None]
    return [
        stage(sightings(spark, sf_dir, BATCH_DATES[k], edges[k], edges[k + 1]), "batch")
        for k in range(count)
    ]
