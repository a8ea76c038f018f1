"""The agreed shape of the data: columns, types, required columns, label values."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values. They describe the published snapshot files and the labels of
# the star schema, and must stay as they are for results to be right.
# ---------------------------------------------------------------------------

# Declared staging types. "text(n)" carries an expected length, plain "text" none.
LISTING_TYPES = {
    "id": "bigint",
    "host_id": "bigint",
    "host_name": "text(100)",
    "host_is_superhost": "text(1)",
    "host_has_profile_pic": "text(1)",
    "host_identity_verified": "text(1)",
    "price": "text(20)",
    "amenities": "text",
    "number_of_reviews_ltm": "smallint",
    "number_of_reviews_ly": "smallint",
    "review_scores_rating": "decimal(4,2)",
    "review_scores_accuracy": "decimal(4,2)",
    "review_scores_cleanliness": "decimal(4,2)",
    "review_scores_checkin": "decimal(4,2)",
    "review_scores_communication": "decimal(4,2)",
    "review_scores_location": "decimal(4,2)",
    "review_scores_value": "decimal(4,2)",
    "reviews_per_month": "decimal(5,2)",
    "instant_bookable": "text(1)",
}
REVIEW_TYPES = {
    "listing_id": "bigint",
    "id": "bigint",
    "reviewer_id": "bigint",
    "reviewer_name": "text(100)",
    "comments": "text",
}
NEIGHBOURHOOD_TYPES = {
    "neighbourhood_group": "text(50)",
    "neighbourhood": "text(100)",
}

# Types of undeclared columns by name, beginning or ending; everything else is text.
UNDECLARED_TYPES = (
    {"type": "bigint", "names": ("id",), "beginnings": (), "endings": ("_id",)},
    {"type": "double", "names": ("latitude", "longitude", "bathrooms"), "beginnings": (),
     "endings": ()},
    {"type": "text(20)", "names": (
        "date", "host_since", "last_scraped", "first_review", "last_review", "calendar_updated",
        "calendar_last_scraped"), "beginnings": (), "endings": ("_date",)},
    {"type": "int", "names": (
        "accommodates", "bedrooms", "beds", "host_listings_count", "host_total_listings_count",
        "number_of_reviews"),
     "beginnings": ("availability_", "minimum_", "maximum_", "calculated_host_listings_count"),
     "endings": ()},
)

# Columns that must never be null.
LISTING_REQUIRED = (
    "id", "host_id", "latitude", "longitude", "neighbourhood_cleansed",
    "property_type", "room_type", "accommodates", "minimum_nights",
)
REVIEW_REQUIRED = ("listing_id", "id", "date", "reviewer_id")
NEIGHBOURHOOD_REQUIRED = ("neighbourhood",)

# Raw listing columns that never reach the archive: 22 from the first layout,
# 6 more from the wider layout of 2026-06-28.
LISTING_DROPPED = (
    "scrape_id", "last_scraped", "source", "neighborhood_overview", "host_thumbnail_url",
    "neighbourhood_group_cleansed", "minimum_minimum_nights", "maximum_minimum_nights",
    "minimum_maximum_nights", "maximum_maximum_nights", "minimum_nights_avg_ntm",
    "maximum_nights_avg_ntm", "calendar_updated", "has_availability", "availability_30",
    "availability_60", "availability_90", "calendar_last_scraped", "number_of_reviews_l30d",
    "availability_eoy", "first_review", "last_review",
    "host_profile_id", "host_profile_url", "hosts_time_as_user_years",
    "hosts_time_as_user_months", "hosts_time_as_host_years", "hosts_time_as_host_months",
)
# Columns a later layout added; earlier snapshots read null.
LISTING_QUOTE_COLUMNS = (
    "price_quote_checkin_date", "price_quote_checkout_date", "price_quote_total_price",
    "price_quote_price_per_night", "price_quote_raw",
)

# Archive layouts (column, Spark type), in file order; snapshot_date partitions both.
LISTING_ARCHIVE = (
    ("id", "bigint"), ("listing_url", "string"), ("name", "string"), ("description", "string"),
    ("picture_url", "string"), ("host_id", "bigint"), ("host_url", "string"),
    ("host_name", "string"), ("host_since", "date"), ("host_location", "string"),
    ("host_about", "string"), ("host_response_time", "string"),
    ("host_response_rate", "string"), ("host_acceptance_rate", "string"),
    ("host_is_superhost", "string"), ("host_picture_url", "string"),
    ("host_neighbourhood", "string"), ("host_listings_count", "int"),
    ("host_total_listings_count", "int"), ("host_verifications", "string"),
    ("host_has_profile_pic", "string"), ("host_identity_verified", "string"),
    ("neighbourhood", "string"), ("neighbourhood_cleansed", "string"),
    ("latitude", "double"), ("longitude", "double"), ("property_type", "string"),
    ("room_type", "string"), ("accommodates", "int"), ("bathrooms", "double"),
    ("bathrooms_text", "string"), ("bedrooms", "int"), ("beds", "int"),
    ("amenities", "string"), ("price", "string"), ("minimum_nights", "int"),
    ("maximum_nights", "int"), ("availability_365", "int"), ("number_of_reviews", "int"),
    ("number_of_reviews_ltm", "smallint"), ("number_of_reviews_ly", "smallint"),
    ("estimated_occupancy_l365d", "string"), ("estimated_revenue_l365d", "string"),
    ("price_quote_checkin_date", "string"), ("price_quote_checkout_date", "string"),
    ("price_quote_total_price", "string"), ("price_quote_price_per_night", "string"),
    ("price_quote_raw", "string"), ("review_scores_rating", "decimal(4,2)"),
    ("review_scores_accuracy", "decimal(4,2)"), ("review_scores_cleanliness", "decimal(4,2)"),
    ("review_scores_checkin", "decimal(4,2)"), ("review_scores_communication", "decimal(4,2)"),
    ("review_scores_location", "decimal(4,2)"), ("review_scores_value", "decimal(4,2)"),
    ("license", "string"), ("instant_bookable", "string"),
    ("calculated_host_listings_count", "int"),
    ("calculated_host_listings_count_entire_homes", "int"),
    ("calculated_host_listings_count_private_rooms", "int"),
    ("calculated_host_listings_count_shared_rooms", "int"),
    ("reviews_per_month", "decimal(5,2)"), ("property_category", "string"),
    ("snapshot_date", "date"),
)
REVIEW_ARCHIVE = (
    ("listing_id", "bigint"), ("id", "bigint"), ("date", "date"), ("reviewer_id", "bigint"),
    ("reviewer_name", "string"), ("comments", "string"), ("snapshot_date", "date"),
)
NEIGHBOURHOOD_ARCHIVE = (
    ("neighbourhood_group", "string"), ("neighbourhood", "string"), ("snapshot_date", "date"),
)

# Property categories, tried top to bottom; the first that applies wins.
PROPERTY_CATEGORY_RULES = (
    {"label": "Entire Property", "prefixes": ("Entire",), "values": ("Cycladic home",)},
    {"label": "Private Room", "prefixes": ("Private room",), "values": ("Casa particular",)},
    {"label": "Shared Room", "prefixes": ("Shared room",)},
    {"label": "Hotel / Serviced", "fragments": ("hotel", "aparthotel", "serviced")},
    {"label": "Unique / Other", "values": (
        "Boat", "Barn", "Camper/RV", "Tent", "Cave", "Earthen home", "Tiny home", "Floor",
        "Castle")},
)
OTHER_CATEGORY = "Unique / Other"

UNKNOWN = "Unknown"            # text of every missing dimension value
UNKNOWN_KEY = 0                # key of the Unknown member
NO_RATE = -1                   # a host rate that was not published
UNKNOWN_HOST_SINCE = "1900-01-01"
CALENDAR_START, CALENDAR_END = "2000-01-01", "2030-12-31"
QUOTE_DATE_FORMATS = ("yyyy-MM-dd", "dd/MM/yyyy")
# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

STAGING_TYPES = {
    "listings": LISTING_TYPES, "reviews": REVIEW_TYPES, "neighbourhoods": NEIGHBOURHOOD_TYPES,
}
REQUIRED = {
    "listings": LISTING_REQUIRED, "reviews": REVIEW_REQUIRED,
    "neighbourhoods": NEIGHBOURHOOD_REQUIRED,
}
ARCHIVE = {
    "listings": LISTING_ARCHIVE, "reviews": REVIEW_ARCHIVE,
    "neighbourhoods": NEIGHBOURHOOD_ARCHIVE,
}
# Columns of an archive that the snapshot file itself does not carry.
DERIVED_COLUMNS = ("property_category", "snapshot_date")


class ContractError(ValueError):
    """The data in hand breaks an agreed rule; nothing has been written."""


def archive_schema(kind: str) -> T.StructType:
    """Explicit read schema: no footer is opened to learn it, absent columns read null."""
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind_}" for name, kind_ in ARCHIVE[kind]))


def expected_file_columns(kind: str) -> tuple[str, ...]:
    return tuple(name for name, _ in ARCHIVE[kind] if name not in DERIVED_COLUMNS)


def fallback_type(column: str) -> str:
    """Type of a raw column that is not declared: the first row of the table that names it."""
    name = column.lower()
    return next((
        row["type"] for row in UNDECLARED_TYPES
        if name in row["names"] or name.startswith(row["beginnings"]) or name.endswith(row["endings"])
    ), "text")


def staging_type(kind: str, column: str) -> str:
    return STAGING_TYPES[kind].get(column) or fallback_type(column)
