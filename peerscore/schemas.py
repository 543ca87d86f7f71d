"""Explicit table schemas, and the fixed values the layers agree on."""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

CORRUPT = "_corrupt_record"

# The eight raw fields that are kept. Numbers are read as text and converted with
# try_cast, so "12", 12 and 12.0 all count, and "x" becomes NULL instead of an error.
BRONZE = StructType([
    StructField("id", StringType()),
    StructField("displayName", StructType([
        StructField("text", StringType()),
        StructField("languageCode", StringType()),
    ])),
    StructField("formattedAddress", StringType()),
    StructField("location", StructType([
        StructField("latitude", StringType()),
        StructField("longitude", StringType()),
    ])),
    StructField("rating", StringType()),
    StructField("priceLevel", StringType()),
    StructField("userRatingCount", StringType()),
    StructField("types", ArrayType(StringType())),
])

SILVER = StructType([
    StructField("place_id", StringType()),
    StructField("name", StringType()),
    StructField("place_types", ArrayType(StringType())),
    StructField("rating", DoubleType()),
    StructField("user_rating_count", IntegerType()),
    StructField("price_level", IntegerType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
    StructField("khet", StringType()),
    StructField("province", StringType()),
    StructField("ingestion_date", DateType()),
    StructField("first_seen_date", DateType()),
])

_GOLD_COMMON = [
    "place_id", "name", "category", "khet", "province",
    "latitude", "longitude", "rating", "user_rating_count", "price_level",
]
GOLD_SCORED = [*_GOLD_COMMON, "khet_median_rating", "gem_score"]
GOLD_UNQUALIFIED = [*_GOLD_COMMON, "reason"]

# Fixed values.
MIN_REVIEWS = 5
MIN_PLACES = 5
LOW_REVIEWS = "low_review_count"
SMALL_DISTRICT = "khet_sample_too_small"
PROVINCES = ("bangkok", "krung thep maha nakhon")
RATING_RANGE = (1.0, 5.0)

# Fixed value: the types that a search asks for; a place's category is made of them.
SEARCH_TYPES = ("cafe", "bakery")

# A place without one of these gives no signal: the filter, the funnel and the gate share the list.
REQUIRED_SIGNALS = ("rating", "user_rating_count", "latitude", "longitude", "khet", "province")
