"""Hand-written archive rows: defaults, overridden per case."""

import datetime as dt

from snapstar import contracts as C

DAY1, DAY2, DAY3 = dt.date(2025, 6, 24), dt.date(2025, 9, 26), dt.date(2026, 6, 28)

_LISTING = {
    "id": 1, "host_id": 7, "latitude": 37.97, "longitude": 23.72, "name": "Flat",
    "neighbourhood_cleansed": "Plaka", "property_type": "Entire rental unit",
    "room_type": "Entire home/apt", "accommodates": 2, "minimum_nights": 1, "price": "$50.00",
    "snapshot_date": DAY1, "host_name": "Ann",
}


def listings(spark, *changes):
    schema = C.archive_schema("listings")
    rows = [{**_LISTING, **change} for change in changes]
    return spark.createDataFrame(
        [tuple(row.get(name) for name in schema.names) for row in rows], schema
    )


def reviews(spark, *ids_and_days, listing_id=1):
    schema = C.archive_schema("reviews")
    return spark.createDataFrame([
        (listing, review, dt.date(2024, 1, 1), 5, "Guest", "nice", day)
        for review, day, listing in [(*r, listing_id)[:3] for r in ids_and_days]
    ], schema)
