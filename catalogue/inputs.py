"""Snapshot inputs derived from the driver's tables (rules: FIXTURES.md section 2).

``listings`` comes from orders x customer x nation x supplier, ``reviews`` from events and
``neighbourhoods`` from nation. Every row of those tables takes part; the modulo terms below
spread nulls, labels and formats over the rows, they select none away. All orders are read, of
which the latest of a customer and year is that year's sighting of the listing. A review that the
last snapshot lacks was in the one before, so every event is a review; every nation is a listed
neighbourhood, and some listings name one that the reference list lacks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

# Column -> rule over a sighting: id, host_id, k (order key), y (year), amount, kind (first
# character of the priority), c_name, c_mktsegment, n_name; n_all, n_1, n_2, n_3 are counts of
# the host's sightings in the year, in all and per kind.
_TOTAL = "'$' || format_number(amount, 2)"
_CENTS = "cast(amount * 100 as bigint)"


def _quote_day(shift: int) -> str:
    day = f"lpad(cast(k % 9 + {1 + shift} as string), 2, '0')"
    return (f"case when y >= 2000 then case when k % 2 = 0 then (y + 1) || '-07-' || {day} "
            f"else {day} || '/07/' || (y + 1) end end")


def _score(shift: int) -> str:
    return (f"case when id % 9 <> 0 then cast(cast((k + {shift}) % 200 + 300 as decimal(10,0)) "
            "/ 100 as decimal(4,2)) end")


_LISTING_RULES = {
    "id": "id",
    "listing_url": "'https://example.org/rooms/' || id",
    "name": "c_name || if(y % 2 = 0, ' - Summer', '')",
    "description": """case id % 13 when 0 then null when 1 then 'N/A' else 'About ' || c_name
        || if(id % 13 = 2, ' N/A ', '') || if(y % 2 = 0, ' (renewed)', '') end""",
    "picture_url": "'https://example.org/pic/' || id",
    "host_id": "host_id",
    "host_url": "'https://example.org/h/' || host_id",
    "host_name": "if(host_id % 10 <> 3, 'Host ' || host_id, null)",
    "host_since": "make_date(cast(2008 + host_id % 10 as int), cast(1 + host_id % 12 as int), 1)",
    "host_location": "case host_id % 6 when 0 then null when 1 then 'N/A' else 'City A' end",
    "host_about": """case host_id % 5 when 0 then null when 1 then 'see N/A here'
        else 'bio ' || host_id end""",
    "host_response_time": """case host_id % 4 when 1 then 'N/A' when 2 then 'within an hour'
        when 3 then 'a few days or more' end""",
    # Listings of one host disagree on these two, as feeds do.
    "host_response_rate": """case host_id % 4 when 0 then null when 1 then 'N/A'
        else (50 + (host_id * 3 + y + id % 3) % 50) || '%' end""",
    "host_acceptance_rate": """case (host_id + y) % 5 when 0 then null when 1 then 'N/A'
        else ((host_id * 7 + y) % 101) || '%' end""",
    "host_is_superhost": """case (host_id * 7 + y + id % 2) % 5 when 0 then null when 1 then 't'
        when 2 then 't' else 'f' end""",
    "host_picture_url": "if(host_id % 10 <> 4, 'https://example.org/hp/' || host_id, null)",
    "host_neighbourhood": "if(host_id % 3 <> 0, n_name, null)",
    "host_listings_count": "if(host_id % 11 <> 0, cast(host_id % 40 as int), null)",
    "host_total_listings_count": "if(host_id % 11 <> 0, cast(host_id % 50 as int), null)",
    "host_verifications": """case host_id % 4 when 1 then 'None' when 2 then 'N/A'
        when 3 then '[email, phone]' end""",
    "host_has_profile_pic": "case host_id % 3 when 0 then 'f' when 1 then 't' end",
    "host_identity_verified": "case (host_id + 1) % 3 when 0 then 'f' when 1 then 't' end",
    "neighbourhood": "if(id % 5 <> 0, 'Neighborhood highlights', null)",
    "neighbourhood_cleansed": "n_name || if(id % 23 = 0, ' (new)', '')",
    "latitude": "cast(379000 + id % 1000 as double) / 10000",
    "longitude": "cast(237000 + id % 777 as double) / 10000",
    "property_type": """case kind when '1' then 'Entire rental unit'
        when '2' then 'Private room in casa particular' when '3' then 'Shared room in hostel'
        when '4' then 'Room in aparthotel' when '5' then 'Cave' end""",
    "room_type": "c_mktsegment",
    "accommodates": "cast(1 + k % 8 as int)",
    "bathrooms": "if(k % 10 <> 0, cast(1 + k % 5 as double) / 2, null)",
    "bathrooms_text": """case id % 4 when 1 then 'N/A' when 2 then '1 bath'
        when 3 then '1.5 shared baths' end""",
    "bedrooms": "if(k % 11 <> 0, cast(1 + k % 4 as int), null)",
    "beds": "if(k % 12 <> 0, cast(1 + k % 6 as int), null)",
    "amenities": """if(k % 2 = 0, '["Wifi", "Kitchen"]', '["Wifi"]')""",
    "price": f"if(k % 17 <> 0, {_TOTAL}, null)",
    "minimum_nights": "cast(1 + k % 30 as int)",
    "maximum_nights": "cast(30 + k % 336 as int)",
    "availability_365": "cast(k % 366 as int)",
    "number_of_reviews": "cast(k % 400 as int)",
    "number_of_reviews_ltm": "cast(k % 60 as smallint)",
    "number_of_reviews_ly": "cast(k % 50 as smallint)",
    "estimated_occupancy_l365d": "cast(k % 256 as string)",
    "estimated_revenue_l365d": "if(k % 17 <> 0, cast(k % 256 * 100 as string), null)",
    "price_quote_checkin_date": _quote_day(0),
    "price_quote_checkout_date": _quote_day(3),
    "price_quote_total_price": f"if(y >= 2000, {_TOTAL}, null)",
    "price_quote_price_per_night": f"""if(y >= 2000, '$' || ({_CENTS} div 3 div 100) || '.'
        || lpad(cast({_CENTS} div 3 % 100 as string), 2, '0'), null)""",
    "price_quote_raw": f"if(y >= 2000, {_TOTAL} || ' for 3 nights', null)",
    "review_scores_rating": _score(0),
    "review_scores_accuracy": _score(13),
    "review_scores_cleanliness": _score(26),
    "review_scores_checkin": _score(39),
    "review_scores_communication": _score(52),
    "review_scores_location": _score(65),
    "review_scores_value": _score(78),
    "license": """case (id + y) % 6 when 0 then null when 1 then '' when 2 then 'Exempt'
        else '0000' || id end""",
    "instant_bookable": "case k % 3 when 1 then 't' when 2 then 'f' end",
    "calculated_host_listings_count": "n_all",
    "calculated_host_listings_count_entire_homes": "n_1",
    "calculated_host_listings_count_private_rooms": "n_2",
    "calculated_host_listings_count_shared_rooms": "n_3",
    "reviews_per_month": """if(id % 9 <> 0, cast(cast(k % 500 as decimal(10,0)) / 100
        as decimal(5,2)), null)""",
    "snapshot_date": "make_date(y, 12, 31)",
}


# Stored columns of the tables used, so that no footer is read to learn them.
_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a sighting of its customer's listing in a year (not unique on it)."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.year("o_orderdate").alias("y"),
        (F.col("o_custkey") + 1).alias("id"),
        F.make_date(F.year("o_orderdate"), F.lit(12), F.lit(31)).alias("snapshot_date"),
    )


def _sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest order of each customer and year, with its customer, nation and host."""
    suppliers = table(spark, sf_dir, "supplier").agg(F.count("*")).scalar()
    newest = F.max(F.struct("o_orderdate", "o_orderkey", "amount", "o_orderpriority"))
    latest = (
        order_feed(spark, sf_dir).groupBy("o_custkey", "y").agg(newest.alias("_o"))
        .select("o_custkey", "y", "_o.*")
    )
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_mktsegment", "c_nationkey"
    )
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (
        latest.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            (F.col("o_custkey") + 1).alias("id"), "y", F.col("o_orderkey").alias("k"), "amount",
            F.substring("o_orderpriority", 1, 1).alias("kind"), "c_name", "c_mktsegment", "n_name",
            (F.col("o_custkey") % suppliers + 1).alias("host_id"),
        )
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listings archive: one row per listing and yearly snapshot, 1995 to 2001."""
    # A window over a host's sightings in a year, so that the sightings are made once.
    per_host = Window.partitionBy("host_id", "y")
    counts = {"n_all": F.count("*"), **{
        f"n_{d}": F.count_if(F.col("kind") == d) for d in "123"}}
    # A sighting without a year belongs to no year's count.
    rows = _sightings(spark, sf_dir).withColumns({
        name: F.when(F.col("y").isNotNull(), count.over(per_host).cast("int"))
        for name, count in counts.items()})
    return rows.selectExpr(*[f"{rule} as {name}" for name, rule in _LISTING_RULES.items()])


def neighbourhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference list: every nation."""
    return table(spark, sf_dir, "nation").select(
        F.lit(None).cast("string").alias("neighbourhood_group"),
        F.col("n_name").alias("neighbourhood"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reviews archive: each snapshot repeats all earlier reviews, the last drops some.

    Snapshots lie at a third, two thirds and the end of the days that the events span.
    """
    events = table(spark, sf_dir, "events")
    day = F.to_date("ts")
    low, high = events.agg(F.min(day)).scalar(), events.agg(F.max(day)).scalar()
    span = F.date_diff(high, low)
    before = F.date_add(low, F.floor(span * 2 / 3).cast("int"))
    dates = F.array(F.date_add(low, F.floor(span / 3).cast("int")), before, high)
    dropped = (F.col("snapshot_date") == high) & (day <= before) & (F.col("event_id") % 30 == 0)
    orphan = (F.col("event_type") == "error") & (F.col("event_id") % 7 == 0)
    return (
        events.select("*", F.explode(dates).alias("snapshot_date"))
        .where(day <= F.col("snapshot_date"))
        .where(~dropped)
        .select(
            (F.col("user_id") + F.when(orphan, 1_000_001).otherwise(1)).alias("listing_id"),
            (F.col("event_id") + 1).alias("id"),
            day.alias("date"),
            (F.col("user_id") + 1).alias("reviewer_id"),
            F.concat(F.lit("Guest "), F.col("user_id").cast("string")).alias("reviewer_name"),
            F.col("props").alias("comments"),
            "snapshot_date",
        )
    )


def raw_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as a file would carry them: all text, a few columns that are dropped later."""
    typed = listings(spark, sf_dir)
    extra = {
        "scrape_id": "'20250624'",
        "minimum_nights_avg_ntm": "(number_of_reviews % 30) || '.5'",
        "availability_30": "if(number_of_reviews % 97 = 0, 'unknown', '' || number_of_reviews % 31)",
        "calendar_updated": "cast(null as string)",
        "host_profile_id": "host_id || '.0'",
    }
    return typed.selectExpr(
        *[f"cast({c} as string) as {c}" for c in typed.columns],
        *[f"{rule} as {name}" for name, rule in extra.items()],
    )
