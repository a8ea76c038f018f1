"""Profiles of the raw history, read before any table is built."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from snapstar import contracts as C
from snapstar.functions import cleaning as clean
from snapstar.operators.latest import first_per_group
from snapstar.operators.tallies import null_rows, stacked, value_counts

CATEGORICAL = [
    "room_type", "property_type", "instant_bookable", "host_is_superhost",
    "host_has_profile_pic", "host_identity_verified", "host_response_rate",
    "host_acceptance_rate", "host_response_time", "host_name", "host_location",
    "host_verifications", "name", "listing_url", "picture_url", "bathrooms_text",
]


def categorical_values(listings: DataFrame) -> DataFrame:
    """Every distinct value of the text columns with its rows: column_name, value, row_count."""
    return value_counts(listings, CATEGORICAL)


def neighbourhood_pairs(listings: DataFrame) -> DataFrame:
    return listings.select("neighbourhood", "neighbourhood_cleansed").distinct()


def property_types_per_category(listings: DataFrame) -> DataFrame:
    """Category, its types as one ordered text, and their number."""
    kinds = listings.select("property_type").distinct().select(
        clean.property_category(F.col("property_type")).alias("property_category"),
        "property_type",
    )
    return (
        kinds.groupBy("property_category")
        .agg(
            F.array_join(F.array_sort(F.collect_list("property_type")), ", ")
            .alias("property_types_included"),
            F.count("property_type").alias("type_count"),
        )
        .orderBy(F.col("property_category") == "Other", "property_category")
    )


def ranges(listings: DataFrame) -> DataFrame:
    """Bounds and gaps of the host date and the coordinates, one row."""
    no_place = F.col("latitude").isNull() | F.col("longitude").isNull()
    return listings.agg(
        F.min("host_since").alias("earliest_host"), F.max("host_since").alias("latest_host"),
        null_rows("host_since").alias("null_host_since"),
        F.min("latitude").alias("min_lat"), F.max("latitude").alias("max_lat"),
        F.min("longitude").alias("min_long"), F.max("longitude").alias("max_long"),
        F.count_if(no_place).alias("null_coordinates"),
    )


NULL_CHECKED = [
    "host_listings_count", "host_total_listings_count", "calculated_host_listings_count",
    "calculated_host_listings_count_entire_homes",
    "calculated_host_listings_count_private_rooms",
    "calculated_host_listings_count_shared_rooms", "name", "listing_url", "picture_url",
    "description", "latitude", "longitude", "bathrooms", "bedrooms", "beds",
    "review_scores_rating", "estimated_revenue_l365d", "license", "reviews_per_month",
]


def null_counts(listings: DataFrame) -> DataFrame:
    """Null rows of each checked column, one column each, in one pass."""
    return listings.agg(*[null_rows(c).alias(f"null_{c}") for c in NULL_CHECKED])


def null_price(listings: DataFrame) -> DataFrame:
    """Rows without a price per snapshot, and their share in percent."""
    missing = F.coalesce(F.rtrim("price"), F.lit("")) == ""
    counted = listings.groupBy("snapshot_date").agg(
        F.count("*").alias("total_listings"), F.count_if(missing).alias("null_price_listings")
    )
    share = clean.percentage(F.col("null_price_listings"), F.col("total_listings"))
    return counted.withColumn("null_price_pct", share)


def price_by_snapshot(listings: DataFrame) -> DataFrame:
    """Lowest, highest and mean price per snapshot, priced straight from the raw text."""
    price = clean.money(F.col("price"))
    return listings.groupBy("snapshot_date").agg(
        F.min(price).alias("min_price"), F.max(price).alias("max_price"),
        clean.mean(F.sum(price), F.count(price)).alias("avg_price"),
    )


def price_format(listings: DataFrame, rows: int = 10) -> DataFrame:
    """The first distinct price texts, to see how prices are written."""
    return listings.select("price").distinct().orderBy("price").limit(rows)


def review_scores(listings: DataFrame) -> DataFrame:
    rating = F.col("review_scores_rating")
    return listings.agg(
        F.min(rating).alias("min_rating"), F.max(rating).alias("max_rating"),
        clean.mean(F.sum(rating), F.count(rating)).alias("avg_rating"),
        F.count(rating).alias("rated_listings"),
        (F.count("*") - F.count(rating)).alias("unrated_listings"),
    )


def text_lengths(listings: DataFrame) -> DataFrame:
    length = clean.trimmed_length(F.col("description"))
    return listings.agg(
        F.min(length).alias("description_min_len"), F.max(length).alias("description_max_len"),
        null_rows("description").alias("description_null_count"),
    )


def hosts_superhost_changed(listings: DataFrame) -> DataFrame:
    """Hosts seen with more than one superhost value (null is no value)."""
    return (
        listings.groupBy("host_id")
        .agg(F.count_distinct("host_is_superhost").alias("superhost_values"))
        .where(F.col("superhost_values") > 1)
    )


def listings_name_changed(listings: DataFrame) -> DataFrame:
    """Listings seen under more than one name."""
    return (
        listings.groupBy("id").agg(F.count_distinct("name").alias("names"))
        .where(F.col("names") > 1)
    )


def superhost_profile(listings: DataFrame) -> DataFrame:
    """Hosts in all, ever superhost, ever not, and changed, with their shares; one row.

    One aggregation per host settles all four questions: two values differ exactly when the
    lowest and the highest do.
    """
    value = F.col("host_is_superhost")
    per_host = listings.where(F.col("host_id").isNotNull()).groupBy("host_id").agg(
        F.max(value == "t").alias("held"), F.max(value == "f").alias("lacked"),
        (F.min(value) != F.max(value)).alias("changed"),
    )
    counts = per_host.agg(
        F.count("*").alias("total_unique_hosts"),
        F.count_if("held").alias("superhost_hosts"),
        F.count_if("lacked").alias("non_superhost_hosts"),
        F.count_if("changed").alias("hosts_superhost_changed"),
    )
    share = lambda part: clean.percentage(F.col(part), F.col("total_unique_hosts"))
    return counts.select(
        "*", share("superhost_hosts").alias("superhost_pct"),
        share("non_superhost_hosts").alias("non_superhost_pct"),
        share("hosts_superhost_changed").alias("superhost_changed_pct"),
    )


def name_changes(listings: DataFrame) -> DataFrame:
    """Listings in all and those renamed, with their share; one row."""
    per_listing = listings.where(F.col("id").isNotNull()).groupBy("id").agg(
        (F.min("name") != F.max("name")).alias("changed")
    )
    counts = per_listing.agg(
        F.count("*").alias("total_unique_listings"),
        F.count_if("changed").alias("listings_name_changed"),
    )
    share = clean.percentage(F.col("listings_name_changed"), F.col("total_unique_listings"))
    return counts.withColumn("name_changed_pct", share)


def sample_price_quotes(listings: DataFrame, size: int = 5) -> DataFrame:
    """The first listings of each snapshot with their quote fields, by listing id."""
    quotes = listings.select(
        "snapshot_date", F.col("id").alias("listing_id"), *C.LISTING_QUOTE_COLUMNS
    )
    return first_per_group(quotes, "snapshot_date", ["listing_id"], size)


def required_nulls(tables: dict[str, DataFrame]) -> DataFrame:
    """Null rows of every column that must not be null: table_name, column_name, null_rows."""
    def counted(kind: str, rows: DataFrame) -> DataFrame:
        columns = list(C.REQUIRED[kind])
        wide = rows.agg(*[null_rows(c).alias(c) for c in columns])
        long = wide.unpivot([], columns, "column_name", "null_rows")
        return long.select(F.lit(kind).alias("table_name"), "column_name", "null_rows")

    return stacked([counted(kind, rows) for kind, rows in tables.items()])
