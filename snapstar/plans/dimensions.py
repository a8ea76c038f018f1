"""The six dimensions. Five of them start with an Unknown member under key 0."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapstar import contracts as C
from snapstar.functions import cleaning as clean
from snapstar.functions.calendar import calendar_columns
from snapstar.functions.comparison import exact, like, one_spelling
from snapstar.operators.keys import numbered, numbered_names
from snapstar.operators.latest import latest_per_key
from snapstar.operators.matching import not_listed
from snapstar.session import settled


#: Raw attribute -> cleaning rule of the two dimensions that take the newest snapshot's values.
HOST_ATTRIBUTES = {
    "host_name": clean.or_unknown, "host_url": clean.or_unknown,
    "host_picture_url": clean.or_unknown, "host_about": clean.or_unknown,
    "host_location": clean.or_unknown_whole, "host_since": lambda day: day,
    "host_response_time": clean.or_unknown_whole,
    "host_response_rate": clean.rate, "host_acceptance_rate": clean.rate,
    "host_has_profile_pic": clean.flag, "host_identity_verified": clean.flag,
    "host_verifications": clean.verifications,
}
LISTING_ATTRIBUTES = {
    "listing_url": clean.or_unknown, "picture_url": clean.or_unknown,
    "name": clean.or_unknown, "description": clean.or_unknown,
    "bathrooms_text": clean.or_unknown_whole,
    "latitude": lambda degrees: degrees, "longitude": lambda degrees: degrees,
}


def _with_unknown(members: DataFrame, **values) -> DataFrame:
    """``members`` and one literal row, typed and ordered like them."""
    spark = members.sparkSession
    literal = spark.range(1).select(
        *[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in members.schema.fields]
    )
    return members.unionByName(literal)


def _numbered_names(names: DataFrame, name: str, key: str) -> DataFrame:
    """Distinct cleaned names under keys 1..n. ``Unknown`` is left to the key-0 member."""
    cleaned = names.select(clean.or_unknown(F.col(name)).alias(name))
    distinct = one_spelling(cleaned.where(F.col(name) != C.UNKNOWN), name)
    return numbered_names(distinct, name, key).select(key, name)


def dim_location(neighbourhoods: DataFrame) -> DataFrame:
    """From the reference list of neighbourhoods, never from the listings."""
    listed = neighbourhoods.select(F.col("neighbourhood").alias("neighbourhood_cleansed"))
    members = _numbered_names(listed, "neighbourhood_cleansed", "location_id")
    return _with_unknown(members, location_id=0, neighbourhood_cleansed=C.UNKNOWN)


def listed_names(neighbourhoods: DataFrame) -> DataFrame:
    """Cleaned names of the neighbourhood archive and the first snapshot that lists each."""
    return (
        neighbourhoods.select(
            clean.or_unknown(F.col("neighbourhood")).alias("neighbourhood_cleansed"),
            "snapshot_date",
        )
        .where(F.col("neighbourhood_cleansed") != C.UNKNOWN)
        .groupBy("neighbourhood_cleansed").agg(F.min("snapshot_date").alias("_since"))
    )


def location_members(keys: DataFrame) -> DataFrame:
    """The location dimension over stored keys."""
    return _with_unknown(keys, location_id=0, neighbourhood_cleansed=C.UNKNOWN)


def next_location_keys(keys: DataFrame, names: DataFrame) -> DataFrame:
    """Keys for listed names that have none, behind the highest, in order of appearance."""
    fresh = names.join(keys.select("neighbourhood_cleansed"), "neighbourhood_cleansed", "left_anti")
    highest = keys.agg(F.coalesce(F.max("location_id"), F.lit(0))).scalar()
    return numbered(fresh, ["_since", "neighbourhood_cleansed"], "_number").select(
        (F.col("_number") + highest).cast("int").alias("location_id"), "neighbourhood_cleansed")


def new_neighbourhoods(neighbourhoods: DataFrame, location: DataFrame) -> DataFrame:
    """Listed names the dimension lacks, for a person to review."""
    return not_listed(neighbourhoods, "neighbourhood", location, "neighbourhood_cleansed")


def extend_location(location: DataFrame, approved: DataFrame) -> DataFrame:
    """``location`` plus the approved names under the next free keys; old keys stay."""
    fresh = approved.select(F.col("neighbourhood").alias("neighbourhood_cleansed")).distinct()
    fresh = not_listed(fresh, "neighbourhood_cleansed", location, "neighbourhood_cleansed")
    highest = location.agg(F.max("location_id")).scalar()
    added = numbered(fresh, ["neighbourhood_cleansed"], "_position").select(
        (F.col("_position") + highest).cast("int").alias("location_id"), "neighbourhood_cleansed"
    )
    return location.unionByName(added)


def observed_names(listings: DataFrame) -> dict[str, DataFrame]:
    """The distinct room and property types of the history, found in one pass over it."""
    columns = ["room_type", "property_type"]
    # Every spelling is kept here; which of them are one name is settled by the dimension.
    found = settled(
        listings.select(*[exact(F.col(c)).alias(c) for c in columns])
        .unpivot([], columns, "_of", "_name").distinct()
    )
    return {
        c: found.where(F.col("_of") == c).select(like(F.col("_name"), listings, c).alias(c))
        for c in columns}


def dim_room_type(listings: DataFrame) -> DataFrame:
    members = _numbered_names(listings.select("room_type"), "room_type", "room_id")
    return _with_unknown(members, room_id=0, room_type=C.UNKNOWN)


def dim_property_type(listings: DataFrame) -> DataFrame:
    """One row per property type: the category follows from the type alone."""
    kinds = one_spelling(listings.where(F.col("property_type") != C.UNKNOWN), "property_type")
    kind = like(F.col("property_type"), listings, "property_type")
    members = numbered_names(kinds, "property_type", "property_id").select(
        "property_id", "property_type", clean.property_category(kind).alias("property_category"))
    return _with_unknown(
        members, property_id=0, property_type=C.UNKNOWN, property_category=C.UNKNOWN
    )


def newest_hosts(listings: DataFrame) -> DataFrame:
    """The raw attributes of each host in its newest snapshot (lowest listing id on a tie)."""
    return latest_per_key(listings, "host_id", "snapshot_date", "id", list(HOST_ATTRIBUTES))


def dim_host(listings: DataFrame) -> DataFrame:
    """One row per host, attributes of its newest snapshot."""
    return host_members(newest_hosts(listings))


def host_members(newest: DataFrame) -> DataFrame:
    """The host dimension over the newest raw attributes of each host."""
    attributes = HOST_ATTRIBUTES
    hosts = newest.select(
        "host_id", *[rule(F.col(name)).alias(name) for name, rule in attributes.items()]
    )
    unknown = dict.fromkeys(attributes, C.UNKNOWN) | {
        "host_id": C.UNKNOWN_KEY, "host_since": C.UNKNOWN_HOST_SINCE,
        "host_response_rate": C.NO_RATE, "host_acceptance_rate": C.NO_RATE,
        "host_has_profile_pic": 0, "host_identity_verified": 0,
    }
    return _with_unknown(hosts, **unknown)


def newest_listings(listings: DataFrame) -> DataFrame:
    """The raw descriptive attributes of each listing in its newest snapshot."""
    return latest_per_key(listings, "id", "snapshot_date", "id", list(LISTING_ATTRIBUTES))


def dim_listings(listings: DataFrame) -> DataFrame:
    """One row per listing, descriptive attributes of its newest snapshot."""
    return listing_members(newest_listings(listings))


def listing_members(newest: DataFrame) -> DataFrame:
    """The listing dimension over the newest raw attributes of each listing."""
    attributes = LISTING_ATTRIBUTES
    places = newest.select(
        F.col("id").alias("listing_id"),
        *[rule(F.col(name)).alias(name) for name, rule in attributes.items()],
    )
    unknown = dict.fromkeys(attributes, C.UNKNOWN) | {
        "listing_id": C.UNKNOWN_KEY, "latitude": 0, "longitude": 0,
    }
    return _with_unknown(places, **unknown)


def dim_date(
    spark: SparkSession, start: str = C.CALENDAR_START, end: str = C.CALENDAR_END
) -> DataFrame:
    """One row per day of the calendar; it has no Unknown member."""
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("_day")
    )
    attributes = calendar_columns(F.col("_day"))
    return days.select(*[column.alias(name) for name, column in attributes.items()])
