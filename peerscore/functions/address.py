"""Column functions that read a district and a province out of a postal address."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from peerscore.schemas import PROVINCES

# Address separator, district prefix, postal digits, Thai block.
SEPARATOR = r",\s*"
DISTRICT_PREFIX = r"(?i)^khet\s+"
DIGITS = r"\d+"
THAI = r"[\u0E00-\u0E7F]"


def address_parts(address: Column) -> Column:
    """Comma-separated parts; trailing empty parts are kept."""
    return F.split(address, SEPARATOR)


def district(parts: Column) -> Column:
    """Third part from the end without its "Khet " prefix; NULL for short addresses."""
    part = F.trim(F.try_element_at(parts, F.lit(-3)))
    return F.trim(F.regexp_replace(part, DISTRICT_PREFIX, ""))


def province(parts: Column) -> Column:
    """Second part from the end with every digit removed; NULL for short addresses."""
    part = F.trim(F.try_element_at(parts, F.lit(-2)))
    return F.trim(F.regexp_replace(part, DIGITS, ""))


def has_thai(text: Column) -> Column:
    return text.rlike(THAI)


def in_region(name: Column, allowed: tuple[str, ...] = PROVINCES) -> Column:
    """Case-insensitive allow-list test; NULL for a NULL name."""
    return F.lower(name).isin(*allowed)
