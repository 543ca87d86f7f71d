"""Small fixtures of our own, and a look at physical plans."""

import datetime
import json

from peerscore.schemas import SILVER

DAY = datetime.date(2026, 8, 27)

PLACE = {
    "id": "a1",
    "displayName": {"text": "Lantern House", "languageCode": "th"},
    "formattedAddress": "27/4 Canal Lane, Khwaeng North, Khet Phaya Thai, "
                        "Krung Thep Maha Nakhon 10400, Thailand",
    "location": {"latitude": 13.7781, "longitude": 100.5432},
    "rating": 3.9,
    "priceLevel": "PRICE_LEVEL_EXPENSIVE",
    "userRatingCount": 17,
    "types": ["bakery", "store"],
}


def place(**changes):
    record = {**PLACE, **changes}
    return {k: v for k, v in record.items() if v is not ...}


def land(path, records):
    """Write records as one JSON Lines file in a new folder; returns the folder."""
    path.mkdir(parents=True)
    lines = [r if isinstance(r, str) else json.dumps(r, ensure_ascii=False) for r in records]
    (path / "part-0.json").write_text("\n".join(lines), encoding="utf8")
    return str(path)


def silver_row(place_id="a1", **changes):
    row = {
        "place_id": place_id, "name": "Lantern House", "place_types": ["bakery"], "rating": 3.9,
        "user_rating_count": 17, "price_level": 3, "latitude": 13.7781, "longitude": 100.5432,
        "khet": "Phaya Thai", "province": "Bangkok", "ingestion_date": DAY, "first_seen_date": DAY,
    }
    row.update(changes)
    return row


def silver_table(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in SILVER.names) for r in rows], SILVER)


def district(name, ratings, reviews=10):
    return [
        silver_row(f"{name}-{i}", khet=name, rating=r, user_rating_count=reviews)
        for i, r in enumerate(ratings)
    ]


def steps(n):
    return [round(4.0 + 0.1 * i, 1) for i in range(n)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()
