from peerscore.functions.address import address_parts, district, has_thai, in_region, province
from peerscore.functions.geo import metres_between
from peerscore.functions.labels import category, price_level

__all__ = [
    "address_parts", "category", "district", "has_thai", "in_region",
    "metres_between", "price_level", "province",
]
