"""Distance on the sphere."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_008.8
METRES_PER_DEGREE_LAT = 111_320.0


def metres_between(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance, rounded to the millimetre so that ties order the same everywhere."""
    chord = F.pow(F.sin(F.radians(lat2 - lat1) / 2.0), 2.0) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2.0), 2.0)
    return F.round(F.lit(2.0 * EARTH_RADIUS_M) * F.asin(F.sqrt(chord)), 3)
