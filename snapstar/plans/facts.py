"""The two fact tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from snapstar.functions import cleaning as clean
from snapstar.operators.matching import keep_known_keys, look_up

_COPIED = (
    "accommodates", "bathrooms", "bedrooms", "beds", "minimum_nights", "maximum_nights",
    "availability_365", "number_of_reviews", "number_of_reviews_ltm", "number_of_reviews_ly",
    "reviews_per_month",
    "price_quote_checkin_date", "price_quote_checkout_date", "price_quote_total_price",
    "price_quote_price_per_night",
    "review_scores_rating", "review_scores_accuracy", "review_scores_cleanliness",
    "review_scores_checkin", "review_scores_communication", "review_scores_location",
    "review_scores_value",
)
_HOST_COUNTS = {
    "calculated_host_listings_count": "calculated_host_listings_count",
    "calc_listings_entire_homes": "calculated_host_listings_count_entire_homes",
    "calc_listings_private_rooms": "calculated_host_listings_count_private_rooms",
    "calc_listings_shared_rooms": "calculated_host_listings_count_shared_rooms",
    "host_listings_count": "host_listings_count",
    "host_total_listings_count": "host_total_listings_count",
}


NATURAL_KEYS = ("host_id", "property_type", "room_type", "neighbourhood_cleansed")
#: Columns of the archive that the listing fact is made of; its keys alone.
KEY_COLUMNS = ("id", "snapshot_date", *NATURAL_KEYS)
SOURCE_COLUMNS = (
    *KEY_COLUMNS, "price", *_COPIED, "estimated_occupancy_l365d", "estimated_revenue_l365d", "license",
    "instant_bookable", "host_is_superhost", *_HOST_COUNTS.values(),
)


def listing_measures() -> dict[str, Column]:
    """Everything that can change between snapshots, cleaned; nulls of measures stay null."""
    measures = {"price": clean.money(F.col("price"))}
    measures |= {name: F.col(name) for name in _COPIED}
    measures |= {
        "estimated_occupancy_l365d": clean.whole_number(F.col("estimated_occupancy_l365d")),
        "estimated_revenue_l365d": F.col("estimated_revenue_l365d").try_cast("double"),
        "has_license": clean.has_license(F.col("license")),
        "license_status": clean.license_status(F.col("license")),
        "instant_bookable": clean.flag(F.col("instant_bookable")),
        "host_is_superhost": clean.flag(F.col("host_is_superhost")),
    }
    measures |= {name: clean.count_or_zero(F.col(raw)) for name, raw in _HOST_COUNTS.items()}
    return measures


def listing_facts(listings: DataFrame) -> DataFrame:
    """One row per listing and snapshot: natural keys and measures, no join."""
    return listings.select(
        F.col("id").alias("listing_id"), "snapshot_date", *NATURAL_KEYS,
        *[column.alias(name) for name, column in listing_measures().items()],
    )


def with_property_key(rows: DataFrame, property_types: DataFrame) -> DataFrame:
    return look_up(rows, property_types, {"property_type": "property_type"}, "property_id")


def with_room_key(rows: DataFrame, room_types: DataFrame) -> DataFrame:
    return look_up(rows, room_types, {"room_type": "room_type"}, "room_id")


def with_location_key(rows: DataFrame, locations: DataFrame) -> DataFrame:
    natural = {"neighbourhood_cleansed": "neighbourhood_cleansed"}
    return look_up(rows, locations, natural, "location_id")


def with_host_key(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    return keep_known_keys(rows, hosts, "host_id")


def fact_listings(
    listings: DataFrame, property_types: DataFrame, room_types: DataFrame,
    locations: DataFrame, hosts: DataFrame,
) -> DataFrame:
    """One row per listing and snapshot, with a key into every dimension (0 = Unknown).

    The host key is checked against ``hosts`` without moving the facts. No shuffle carries fact rows
    as long as the stored dimensions are below Spark's broadcast threshold.
    """
    facts = listing_facts(listings)
    measures = [c for c in facts.columns[2:] if c not in NATURAL_KEYS]
    keyed = with_host_key(facts, hosts)
    keyed = with_property_key(keyed, property_types)
    keyed = with_room_key(keyed, room_types)
    keyed = with_location_key(keyed, locations)
    keys = ("listing_id", "snapshot_date", "host_id", "property_id", "room_id", "location_id")
    return keyed.select(*keys, *measures)


def newest_reviews(reviews: DataFrame) -> DataFrame:
    """(id, newest, first): of each review its newest narrow attributes and its first snapshot.

    Only the narrow columns enter the shuffle; review texts stay in the archive. Each task keeps
    one row per review of its input, whatever share of the rows one review holds.
    """
    newest = F.max(F.struct(
        "snapshot_date", (-F.col("listing_id")).alias("listing"), "date", "reviewer_id"
    ))
    return reviews.groupBy("id").agg(newest.alias("newest"), F.min("snapshot_date").alias("first"))


def review_members(seen: DataFrame, newest_snapshot) -> DataFrame:
    """The review fact over ``newest_reviews``, given the newest snapshot of all."""
    return seen.select(
        F.col("id").alias("review_id"), (-F.col("newest.listing")).alias("listing_id"),
        "newest.date", "newest.reviewer_id", F.col("first").alias("first_snapshot_date"),
        (F.col("newest.snapshot_date") == newest_snapshot).cast("int").alias("is_active"),
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    """One row per review: newest attributes, first snapshot seen, still in the newest one."""
    newest_snapshot = reviews.agg(F.max("snapshot_date")).scalar()
    return review_members(newest_reviews(reviews), newest_snapshot)
