"""Inputs, cleaning rules, dimensions and facts."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue import inputs
from catalogue.registry import query
from catalogue.sql_views import category, licence, money, rate
from snapstar import contracts as C
from snapstar.functions import cleaning as clean
from snapstar.plans import dimensions as dims, facts
from snapstar.session import new_folder


class Star:
    """The star schema over one set of driver tables, each table planned once when asked for.

    With ``stored``, those columns of the listings and the dimensions of their names are written
    first, as a load does: what follows reads files of known size instead of deriving its input again.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stored: tuple[str, ...] = ()):
        self.spark, self.sf_dir, self.stored = spark, sf_dir, stored

    def _kept(self, rows: DataFrame, name: str) -> DataFrame:
        if not self.stored:
            return rows
        folder = new_folder(self.spark, name)
        rows.write.parquet(folder)
        return self.spark.read.schema(rows.schema).parquet(folder)

    @cached_property
    def listings(self) -> DataFrame:
        return inputs.listings(self.spark, self.sf_dir)

    @cached_property
    def fact_source(self) -> DataFrame:
        """The listings as far as facts and names need them."""
        if not self.stored:
            return self.listings
        return self._kept(self.listings.select(*self.stored), "listings")

    @cached_property
    def reviews(self) -> DataFrame:
        return inputs.reviews(self.spark, self.sf_dir)

    @cached_property
    def neighbourhoods(self) -> DataFrame:
        return inputs.neighbourhoods(self.spark, self.sf_dir)

    @cached_property
    def dim_location(self) -> DataFrame:
        return self._kept(dims.dim_location(self.neighbourhoods), "dim-location")

    @cached_property
    def _names(self) -> dict[str, DataFrame]:
        return dims.observed_names(self.fact_source)

    @cached_property
    def dim_room_type(self) -> DataFrame:
        return self._kept(
            dims.dim_room_type(self._names["room_type"]), "dim-room-type")

    @cached_property
    def dim_property_type(self) -> DataFrame:
        return self._kept(
            dims.dim_property_type(self._names["property_type"]), "dim-property-type")

    @cached_property
    def dim_host(self) -> DataFrame:
        return dims.dim_host(self.listings)

    @cached_property
    def dim_listings(self) -> DataFrame:
        return dims.dim_listings(self.listings)

    @cached_property
    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark)

    @cached_property
    def listing_facts(self) -> DataFrame:
        """The listing fact for questions that need no dimension key."""
        return facts.listing_facts(self._with_all(self.fact_source))

    def _with_all(self, rows: DataFrame) -> DataFrame:
        """Source columns that were not stored, as nothing will ask for their values, are null."""
        return rows.selectExpr(*[
            name if name in rows.columns else f"cast(null as {kind}) as {name}"
            for name, kind in C.LISTING_ARCHIVE if name in facts.SOURCE_COLUMNS])

    @cached_property
    def fact_listings(self) -> DataFrame:
        return facts.fact_listings(
            self._with_all(self.fact_source), self.dim_property_type, self.dim_room_type, self.dim_location,
            self.dim_host,
        )

    @cached_property
    def fact_reviews(self) -> DataFrame:
        return facts.fact_reviews(self.reviews)

    def tables(self, keyed: bool = True) -> dict[str, DataFrame]:
        """All tables; the listing fact without dimension keys unless ``keyed``."""
        return {
            "FactListings": self.fact_listings if keyed else self.listing_facts, "FactReviews": self.fact_reviews,
            "DimHost": self.dim_host, "DimListings": self.dim_listings,
            "DimRoomType": self.dim_room_type, "DimPropertyType": self.dim_property_type,
            "DimLocation": self.dim_location, "DimDate": self.dim_date,
        }


# --- the tables themselves -------------------------------------------------------------

def _as_doubles(view: str, columns: str) -> str:
    swaps = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({swaps}) FROM {view}" if swaps else f"SELECT * FROM {view}"


_HOST_SQL = _as_doubles("dim_host", "host_response_rate host_acceptance_rate")
_FACT_SQL = _as_doubles(
    "fact_listings",
    "price reviews_per_month review_scores_rating review_scores_accuracy "
    "review_scores_cleanliness review_scores_checkin review_scores_communication "
    "review_scores_location review_scores_value",
)


@query("dim_location", "SELECT * FROM dim_location")
def dim_location(spark, sf_dir):
    return Star(spark, sf_dir).dim_location


@query("dim_room_type", "SELECT * FROM dim_room_type")
def dim_room_type(spark, sf_dir):
    return Star(spark, sf_dir).dim_room_type


@query("dim_property_type", "SELECT * FROM dim_property_type")
def dim_property_type(spark, sf_dir):
    return Star(spark, sf_dir).dim_property_type


@query("dim_host", _HOST_SQL)
def dim_host(spark, sf_dir):
    return Star(spark, sf_dir).dim_host


@query("dim_listings", "SELECT * FROM dim_listings")
def dim_listings(spark, sf_dir):
    return Star(spark, sf_dir).dim_listings


@query("dim_date fact_reviews", """
    SELECT r.review_id, d.* FROM fact_reviews r LEFT JOIN dim_date d ON d.date = r.date""")
def dim_date(spark, sf_dir):
    """The calendar's attributes of every review's day."""
    star = Star(spark, sf_dir)
    days = star.dim_date.withColumnRenamed("date", "_day")
    joined = star.fact_reviews.select("review_id", "date").join(
        days, F.col("date") == F.col("_day"), "left")
    return joined.select("review_id", F.col("_day").alias("date"), *[
        c for c in days.columns if c != "_day"])


@query("fact_listings", _FACT_SQL)
def fact_listings(spark, sf_dir):
    return Star(spark, sf_dir, facts.SOURCE_COLUMNS).fact_listings


@query("fact_reviews", "SELECT * FROM fact_reviews")
def fact_reviews(spark, sf_dir):
    return Star(spark, sf_dir).fact_reviews


@query("dim_location neighbourhoods listings", """
    SELECT location_id, neighbourhood_cleansed FROM dim_location
    UNION ALL
    SELECT CAST((SELECT max(location_id) FROM dim_location)
                + row_number() OVER (ORDER BY place) AS INT), place
    FROM (SELECT DISTINCT neighbourhood_cleansed AS place FROM listings
          WHERE neighbourhood_cleansed NOT IN (SELECT neighbourhood_cleansed FROM dim_location))
    """)
def dim_location_extend(spark, sf_dir):
    """Names seen in the listings, taken as approved, join the dimension under new keys."""
    star = Star(spark, sf_dir)
    approved = star.listings.select(F.col("neighbourhood_cleansed").alias("neighbourhood"))
    return dims.extend_location(star.dim_location, approved)


@query("dim_location listings", """
    SELECT DISTINCT neighbourhood_cleansed AS neighbourhood FROM listings
    WHERE neighbourhood_cleansed IS NOT NULL
      AND neighbourhood_cleansed NOT IN (SELECT neighbourhood_cleansed FROM dim_location)""")
def new_neighbourhoods(spark, sf_dir):
    star = Star(spark, sf_dir)
    seen = star.listings.select(F.col("neighbourhood_cleansed").alias("neighbourhood"))
    return dims.new_neighbourhoods(seen, star.dim_location)


# --- first rows of every table -----------------------------------------------------------

def _top(view: str, order: list[str], sql: str, views: str | None = None):
    ordering = ", ".join(order)

    @query(views or view, f"{sql} ORDER BY {ordering} LIMIT 5", key=f"top5_{view}")
    def run(spark, sf_dir):
        star = Star(spark, sf_dir, facts.SOURCE_COLUMNS if view == "fact_listings" else ())
        return getattr(star, view).orderBy(*order).limit(5)
    return run


_top("dim_host", ["host_id"], _HOST_SQL)
_top("dim_listings", ["listing_id"], "SELECT * FROM dim_listings")
_top("dim_location", ["location_id"], "SELECT * FROM dim_location")
_top("dim_property_type", ["property_id"], "SELECT * FROM dim_property_type")
_top("dim_room_type", ["room_id"], "SELECT * FROM dim_room_type")
_top("fact_listings", ["listing_id", "snapshot_date"], _FACT_SQL)
_top("fact_reviews", ["review_id"], "SELECT * FROM fact_reviews")


# --- cleaning rules, row by row ------------------------------------------------------------

@query("listings", f"""
    SELECT id, snapshot_date, price, CAST({money('price')} AS DOUBLE) AS clean_price
    FROM listings""")
def clean_price(spark, sf_dir):
    return inputs.listings(spark, sf_dir).select(
        "id", "snapshot_date", "price", clean.money(F.col("price")).alias("clean_price")
    )


@query("listings", f"""
    SELECT id, snapshot_date, CAST({rate('host_response_rate')} AS DOUBLE) AS response_rate,
           CAST({rate('host_acceptance_rate')} AS DOUBLE) AS acceptance_rate
    FROM listings""")
def clean_rates(spark, sf_dir):
    return inputs.listings(spark, sf_dir).select(
        "id", "snapshot_date", clean.rate(F.col("host_response_rate")).alias("response_rate"),
        clean.rate(F.col("host_acceptance_rate")).alias("acceptance_rate"),
    )


_FLAGS = ("host_is_superhost", "host_has_profile_pic", "host_identity_verified",
          "instant_bookable")


@query("listings", "SELECT id, snapshot_date, " + ", ".join(
    f"CASE WHEN {c} = 't' THEN 1 ELSE 0 END AS {c}" for c in _FLAGS) + " FROM listings")
def clean_flags(spark, sf_dir):
    return inputs.listings(spark, sf_dir).select(
        "id", "snapshot_date", *[clean.flag(F.col(c)).alias(c) for c in _FLAGS]
    )


@query("listings", f"""
    SELECT id, snapshot_date, license, {licence('license')} AS license_status,
           CASE WHEN {licence('license')} = 'Licensed' THEN 1 ELSE 0 END AS has_license
    FROM listings""")
def license_status(spark, sf_dir):
    text = F.col("license")
    return inputs.listings(spark, sf_dir).select(
        "id", "snapshot_date", "license", clean.license_status(text).alias("license_status"),
        clean.has_license(text).alias("has_license"),
    )


@query("listings", f"""
    SELECT id, snapshot_date, property_type, {category('property_type')} AS property_category
    FROM listings""")
def property_category(spark, sf_dir):
    return inputs.listings(spark, sf_dir).select(
        "id", "snapshot_date", "property_type",
        clean.property_category(F.col("property_type")).alias("property_category"),
    )


_PARSED_DAY = ("coalesce(CAST(try_strptime({0}, '%Y-%m-%d') AS DATE), "
               "CAST(try_strptime({0}, '%d/%m/%Y') AS DATE))")


@query("listings", f"""
    SELECT *, CAST(checkout_date - checkin_date AS INT) AS nights FROM (
      SELECT id, snapshot_date,
             {_PARSED_DAY.format('price_quote_checkin_date')} AS checkin_date,
             {_PARSED_DAY.format('price_quote_checkout_date')} AS checkout_date,
             CAST({money('price_quote_total_price')} AS DOUBLE) AS total_price,
             CAST({money('price_quote_price_per_night')} AS DOUBLE) AS price_per_night
      FROM listings)""")
def parse_quote_fields(spark, sf_dir):
    parsed = inputs.listings(spark, sf_dir).select(
        "id", "snapshot_date",
        clean.quote_date(F.col("price_quote_checkin_date")).alias("checkin_date"),
        clean.quote_date(F.col("price_quote_checkout_date")).alias("checkout_date"),
        clean.money(F.col("price_quote_total_price")).alias("total_price"),
        clean.money(F.col("price_quote_price_per_night")).alias("price_per_night"),
    )
    return parsed.withColumn("nights", F.date_diff("checkout_date", "checkin_date"))
