"""Profiles of the inputs."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import inputs
from catalogue.registry import query
from catalogue.sql_views import category, half_up, money
from catalogue.star_queries import Star
from snapstar import contracts as C
from snapstar.plans import history, profiles
from snapstar.sources import fit


def _percent(part: str, whole: str) -> str:
    return half_up(f"1000 * ({part})", whole, 1)


def _union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


@query("listings", _union(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS row_count FROM listings GROUP BY {c}"
    for c in profiles.CATEGORICAL))
def profile_categorical_values(spark, sf_dir):
    return profiles.categorical_values(inputs.listings(spark, sf_dir))


@query("listings", "SELECT DISTINCT neighbourhood, neighbourhood_cleansed FROM listings")
def profile_neighbourhood_pairs(spark, sf_dir):
    return profiles.neighbourhood_pairs(inputs.listings(spark, sf_dir))


@query("listings", f"""
    SELECT property_category, string_agg(property_type, ', ' ORDER BY property_type)
             AS property_types_included, count(*) AS type_count
    FROM (SELECT DISTINCT property_type, {category('property_type')} AS property_category
          FROM listings)
    GROUP BY property_category""")
def property_types_per_category(spark, sf_dir):
    return profiles.property_types_per_category(inputs.listings(spark, sf_dir))


@query("listings", """
    SELECT min(host_since) AS earliest_host, max(host_since) AS latest_host,
           count(*) - count(host_since) AS null_host_since,
           min(latitude) AS min_lat, max(latitude) AS max_lat,
           min(longitude) AS min_long, max(longitude) AS max_long,
           count(*) FILTER (latitude IS NULL OR longitude IS NULL) AS null_coordinates
    FROM listings""")
def profile_ranges(spark, sf_dir):
    return profiles.ranges(inputs.listings(spark, sf_dir))


@query("listings", "SELECT " + ", ".join(
    f"count(*) - count({c}) AS null_{c}" for c in profiles.NULL_CHECKED) + " FROM listings")
def profile_null_counts(spark, sf_dir):
    return profiles.null_counts(inputs.listings(spark, sf_dir))


@query("listings", f"""
    SELECT *, {_percent('null_price_listings', 'total_listings')} AS null_price_pct
    FROM (SELECT snapshot_date, count(*) AS total_listings,
                 count(*) FILTER (coalesce(price, '') = '') AS null_price_listings
          FROM listings GROUP BY snapshot_date)""")
def profile_null_price(spark, sf_dir):
    return profiles.null_price(inputs.listings(spark, sf_dir))


@query("listings", f"""
    SELECT snapshot_date, CAST(min(p) AS DOUBLE) AS min_price, CAST(max(p) AS DOUBLE) AS max_price,
           CAST(sum(p) AS DOUBLE) / count(p) AS avg_price
    FROM (SELECT snapshot_date, {money('price')} AS p FROM listings) GROUP BY snapshot_date""")
def profile_price_by_snapshot(spark, sf_dir):
    return profiles.price_by_snapshot(inputs.listings(spark, sf_dir))


@query("listings",
       "SELECT DISTINCT price FROM listings ORDER BY price ASC NULLS FIRST LIMIT 10")
def profile_price_format(spark, sf_dir):
    return profiles.price_format(inputs.listings(spark, sf_dir))


@query("listings", """
    SELECT CAST(min(r) AS DOUBLE) AS min_rating, CAST(max(r) AS DOUBLE) AS max_rating,
           CAST(sum(r) AS DOUBLE) / count(r) AS avg_rating, count(r) AS rated_listings,
           count(*) - count(r) AS unrated_listings
    FROM (SELECT review_scores_rating AS r FROM listings)""")
def profile_review_scores(spark, sf_dir):
    return profiles.review_scores(inputs.listings(spark, sf_dir))


@query("listings", """
    SELECT CAST(min(length(rtrim(description))) AS INT) AS description_min_len,
           CAST(max(length(rtrim(description))) AS INT) AS description_max_len,
           count(*) - count(description) AS description_null_count
    FROM listings""")
def profile_text_lengths(spark, sf_dir):
    return profiles.text_lengths(inputs.listings(spark, sf_dir))


@query("listings", """
    SELECT host_id, count(DISTINCT host_is_superhost) AS superhost_values
    FROM listings GROUP BY host_id HAVING count(DISTINCT host_is_superhost) > 1""")
def hosts_superhost_changed(spark, sf_dir):
    return profiles.hosts_superhost_changed(inputs.listings(spark, sf_dir))


@query("listings", """
    SELECT id, count(DISTINCT name) AS names FROM listings
    GROUP BY id HAVING count(DISTINCT name) > 1""")
def listings_name_changed(spark, sf_dir):
    return profiles.listings_name_changed(inputs.listings(spark, sf_dir))


@query("listings", f"""
    SELECT *, {_percent('superhost_hosts', 'total_unique_hosts')} AS superhost_pct,
           {_percent('non_superhost_hosts', 'total_unique_hosts')} AS non_superhost_pct,
           {_percent('hosts_superhost_changed', 'total_unique_hosts')} AS superhost_changed_pct
    FROM (
      SELECT count(DISTINCT host_id) AS total_unique_hosts,
             count(DISTINCT host_id) FILTER (host_is_superhost = 't') AS superhost_hosts,
             count(DISTINCT host_id) FILTER (host_is_superhost = 'f') AS non_superhost_hosts,
             (SELECT count(*) FROM (SELECT host_id FROM listings GROUP BY host_id
                HAVING count(DISTINCT host_is_superhost) = 2)) AS hosts_superhost_changed
      FROM listings)""")
def profile_superhost(spark, sf_dir):
    return profiles.superhost_profile(inputs.listings(spark, sf_dir))


@query("listings", f"""
    SELECT *, {_percent('listings_name_changed', 'total_unique_listings')} AS name_changed_pct
    FROM (SELECT count(*) AS total_unique_listings,
                 count(*) FILTER (names > 1) AS listings_name_changed
          FROM (SELECT count(DISTINCT name) AS names FROM listings GROUP BY id))""")
def profile_name_changes(spark, sf_dir):
    return profiles.name_changes(inputs.listings(spark, sf_dir))


@query("listings", f"""
    SELECT snapshot_date, id AS listing_id, {", ".join(C.LISTING_QUOTE_COLUMNS)},
           CAST(row_number() OVER (PARTITION BY snapshot_date ORDER BY id) AS INT) AS rn
    FROM listings QUALIFY rn <= 5""")
def sample_price_quotes(spark, sf_dir):
    return profiles.sample_price_quotes(inputs.listings(spark, sf_dir))


_TABLES = ("listings", "reviews", "neighbourhoods")


@query("listings reviews neighbourhoods", _union(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM {t}"
    for t in _TABLES for c in C.REQUIRED[t]))
def dq_required_nulls(spark, sf_dir):
    star = Star(spark, sf_dir)
    return profiles.required_nulls({t: getattr(star, t) for t in _TABLES})


# --- how well raw text fits the declared types --------------------------------------------

_RAW_EXTRA = {
    "scrape_id": "'20250624'",
    "minimum_nights_avg_ntm": "(number_of_reviews % 30) || '.5'",
    "availability_30": "CASE WHEN number_of_reviews % 97 = 0 THEN 'unknown' "
                       "ELSE CAST(number_of_reviews % 31 AS VARCHAR) END",
    "calendar_updated": "CAST(NULL AS VARCHAR)",
    "host_profile_id": "host_id || '.0'",
}
_RAW_COLUMNS = [name for name, _ in C.LISTING_ARCHIVE if name != "property_category"]
_RAW_SQL = "SELECT " + ", ".join(
    [f"CAST({c} AS VARCHAR) AS {c}" for c in _RAW_COLUMNS]
    + [f"{rule} AS {c}" for c, rule in _RAW_EXTRA.items()]
) + " FROM listings"
_NUMERIC = r"'^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$'"


def _whole_columns() -> dict[str, str]:
    kinds = {c: C.staging_type("listings", c) for c in [*_RAW_COLUMNS, *_RAW_EXTRA]}
    return {c: kind for c, kind in kinds.items() if kind in ("bigint", "int", "smallint")}


def _bounded_columns() -> dict[str, int]:
    kinds = {c: C.staging_type("listings", c) for c in [*_RAW_COLUMNS, *_RAW_EXTRA]}
    return {c: int(k[5:-1]) for c, k in kinds.items() if k.startswith("text(")}


@query("listings", f"WITH raw AS ({_RAW_SQL}) SELECT *, CASE WHEN not_numeric > 0 THEN 'text' "
       "WHEN fractional > 0 THEN 'float' ELSE 'int' END AS fit FROM (" + _union(
           f"""SELECT '{c}' AS column_name, '{kind}' AS declared,
               count(*) FILTER ({c} IS NOT NULL AND NOT regexp_matches({c}, {_NUMERIC}))
                 AS not_numeric,
               count(*) FILTER (regexp_matches({c}, {_NUMERIC})
                 AND TRY_CAST({c} AS DOUBLE) % 1 <> 0) AS fractional FROM raw"""
           for c, kind in _whole_columns().items()) + ")")
def profile_numeric_fit(spark, sf_dir):
    return fit.numeric_fit(inputs.raw_listings(spark, sf_dir), "listings")


@query("listings", f"WITH raw AS ({_RAW_SQL}) SELECT *, longest <= declared_length AS fits FROM ("
       + _union(
           f"""SELECT '{c}' AS column_name, {n} AS declared_length,
               CAST(coalesce(max(length({c})), 0) AS INT) AS longest FROM raw"""
           for c, n in _bounded_columns().items()) + ")")
def profile_text_fit(spark, sf_dir):
    return fit.text_fit(inputs.raw_listings(spark, sf_dir), "listings")


# --- history maintenance as expressions ----------------------------------------------------

@query("listings", """
    SELECT snapshot_date, count(*) AS row_count, min(id) AS first_id, max(id) AS last_id
    FROM listings GROUP BY snapshot_date""")
def snapshot_tag(spark, sf_dir):
    """Snapshot dates read back from the file names the rows would have come from."""
    named = inputs.listings(spark, sf_dir).select(
        "id", F.format_string("/feed/%1$s/%1$s_listings.csv", F.col("snapshot_date").cast("string"))
        .alias("file"),
    )
    tagged = named.withColumn("snapshot_date", history.snapshot_date_of(F.col("file")))
    return tagged.groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )


@query("listings", f"""
    SELECT snapshot_date, property_category, count(*) AS row_count
    FROM (SELECT snapshot_date, CASE WHEN year(snapshot_date) < 2000 AND room_type = 'BUILDING'
                                     THEN 'Kept from before' ELSE {category('property_type')} END
                                AS property_category FROM listings)
    GROUP BY snapshot_date, property_category""")
def property_category_backfill(spark, sf_dir):
    """Rows tagged in earlier loads keep their tag; the others get today's rules."""
    earlier = F.when((F.year("snapshot_date") < 2000) & (F.col("room_type") == "BUILDING"),
                     F.lit("Kept from before"))
    partly = inputs.listings(spark, sf_dir).withColumn("property_category", earlier)
    return history.with_category(partly).groupBy("snapshot_date", "property_category").agg(
        F.count("*").alias("row_count")
    )
