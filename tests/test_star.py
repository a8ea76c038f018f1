"""Dimensions, facts and analyses on hand-written rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from rows import DAY1, DAY2, DAY3, listings, reviews
from snapstar import contracts as C
from snapstar.plans import dimensions as dims, facts, investor, profiles, quality
from snapstar.session import new_folder


def names(spark, *values):
    return spark.createDataFrame([(None, v) for v in values],
                                 "neighbourhood_group string, neighbourhood string")


def stored(rows):
    folder = new_folder(rows.sparkSession, "dim")
    rows.write.parquet(folder)
    return rows.sparkSession.read.parquet(folder)


def star(spark, rows, places=("Plaka",)):
    property_types, rooms = dims.dim_property_type(rows), dims.dim_room_type(rows)
    location, hosts = dims.dim_location(names(spark, *places)), dims.dim_host(rows)
    property_types, rooms, location = map(stored, (property_types, rooms, location))
    return facts.fact_listings(rows, property_types, rooms, location, hosts), {
        "property": property_types, "room": rooms, "location": location, "host": hosts}


def test_host_that_lost_superhost_is_one_row(spark):
    rows = listings(
        spark, {"host_is_superhost": "t", "host_response_rate": "90%"},
        {"host_is_superhost": "f", "snapshot_date": DAY2, "host_response_rate": "N/A"},
        {"id": 2, "host_is_superhost": "f", "snapshot_date": DAY2, "host_name": "other"},
    )
    hosts = {r.host_id: r for r in dims.dim_host(rows).collect()}
    assert set(hosts) == {0, 7}
    assert hosts[7].host_name == "Ann" and hosts[7].host_response_rate == -1
    assert hosts[0].host_name == "Unknown" and hosts[0].host_since == dt.date(1900, 1, 1)
    steps = investor.superhost_transitions(rows).collect()
    assert [(r.host_id, r.transition) for r in steps] == [(7, "Lost")]


def test_renamed_listing_is_one_row_under_its_newest_name(spark):
    rows = listings(spark, {"name": "Summer"}, {"name": "View", "snapshot_date": DAY2})
    got = {r.listing_id: r.name for r in dims.dim_listings(rows).collect()}
    assert got == {0: "Unknown", 1: "View"}
    assert profiles.name_changes(rows).first().listings_name_changed == 1


def test_dimensions_do_not_depend_on_load_order(spark):
    changes = [{"id": i, "host_id": i % 2, "name": f"n{i}{d}", "snapshot_date": d}
               for i in range(1, 6) for d in (DAY1, DAY2, DAY3)]
    one = dims.dim_host(listings(spark, *changes)).collect()
    two = dims.dim_host(listings(spark, *reversed(changes)).repartition(5)).collect()
    assert sorted(one) == sorted(two)


def test_names_unmatched_null_or_unknown_resolve_to_key_zero(spark):
    rows = listings(
        spark, {"id": 1}, {"id": 2, "neighbourhood_cleansed": "Nowhere"},
        {"id": 3, "room_type": "N/A"}, {"id": 4, "room_type": None},
        {"id": 5, "property_type": None}, {"id": 6, "room_type": "Unknown"},
    )
    fact, tables = star(spark, rows)
    got = {r.listing_id: (r.property_id, r.room_id, r.location_id) for r in fact.collect()}
    assert got == {1: (1, 1, 1), 2: (1, 1, 0), 3: (1, 0, 1), 4: (1, 0, 1), 5: (0, 1, 1),
                   6: (1, 0, 1)}
    assert {r.room_type for r in tables["room"].collect()} == {"Unknown", "Entire home/apt"}


def test_fact_keeps_nulls_of_measures_and_zeroes_counts(spark):
    fact, _ = star(spark, listings(spark, {"price": None, "host_listings_count": None,
                                           "estimated_occupancy_l365d": "12",
                                           "estimated_revenue_l365d": "340.5"}))
    row = fact.first()
    assert row.price is None and row.review_scores_rating is None
    assert row.host_listings_count == 0 and row.host_is_superhost == 0
    assert row.estimated_occupancy_l365d == 12 and row.estimated_revenue_l365d == 340.5
    assert "price_quote_raw" not in fact.columns and "amenities" not in fact.columns


def test_fact_rows_are_history_rows_and_move_in_no_shuffle(spark):
    rows = listings(spark, *[{"id": i, "snapshot_date": d} for i in range(9) for d in (DAY1, DAY2)])
    fact, _ = star(spark, rows)
    assert fact.count() == rows.count()
    assert quality.duplicate_listing_snapshots(rows).isEmpty()
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_reviews_dropped_new_with_a_gap_and_orphaned(spark):
    rows = reviews(spark, (1, DAY1), (2, DAY2), (3, DAY1), (3, DAY3), (4, DAY3, 99), (5, DAY1),
                   (5, DAY2))
    got = {r.review_id: (str(r.first_snapshot_date), r.is_active)
           for r in facts.fact_reviews(rows).collect()}
    assert got == {
        1: ("2025-06-24", 0), 2: ("2025-09-26", 0), 3: ("2025-06-24", 1),
        4: ("2026-06-28", 1), 5: ("2025-06-24", 0)}
    orphans = quality.orphan_reviews(facts.fact_reviews(rows),
                                     dims.dim_listings(listings(spark, {"id": 1})))
    assert orphans.first()[0] == 1


def test_calendar(spark):
    days = dims.dim_date(spark)
    assert days.count() == 11323
    row = days.where("date = date'2000-01-01'").first()
    assert (row.date_id, row.week, row.quarter_name, row.day_name, row.month_short,
            row.is_weekend) == (20000101, 52, "Q1 2000", "Saturday", "Jan", 1)
    assert days.where("date = date'2025-06-29'").first().is_weekend == 1  # a Sunday
    assert days.where("date_id = 0").isEmpty()


def test_location_keys_stay_when_names_are_added(spark):
    first = spark.createDataFrame([("B", DAY1), ("C", DAY1), ("N/A", DAY1)],
                                  "neighbourhood string, snapshot_date date")
    later = first.union(spark.createDataFrame([("A", DAY2), ("B", DAY2)], first.schema))
    keys = lambda t: {r.neighbourhood_cleansed: r.location_id for r in t.collect()}
    none = spark.createDataFrame([], "location_id int, neighbourhood_cleansed string")
    held = dims.next_location_keys(none, dims.listed_names(first)).checkpoint()
    assert keys(dims.location_members(held)) == {"Unknown": 0, "B": 1, "C": 2}
    more = dims.next_location_keys(held, dims.listed_names(later))
    assert keys(dims.location_members(held.unionByName(more))) == {
        "Unknown": 0, "B": 1, "C": 2, "A": 3}
    extended = dims.extend_location(dims.location_members(held), names(spark, "A", "B", None))
    assert keys(extended) == {"Unknown": 0, "B": 1, "C": 2, "A": 3}


def test_changed_status_ignores_null(spark):
    rows = listings(spark, {"host_id": 1, "host_is_superhost": "t"},
                    {"host_id": 1, "host_is_superhost": None, "snapshot_date": DAY2},
                    {"host_id": 2, "host_is_superhost": "t"},
                    {"host_id": 2, "host_is_superhost": "f", "snapshot_date": DAY2},
                    {"host_id": 3, "host_is_superhost": None})
    assert [r.host_id for r in profiles.hosts_superhost_changed(rows).collect()] == [2]
    row = profiles.superhost_profile(rows).first()
    assert (row.total_unique_hosts, row.superhost_hosts, row.non_superhost_hosts,
            row.hosts_superhost_changed) == (3, 2, 1, 1)
    assert row.superhost_changed_pct == Decimal("33.3")


def test_rate_before_a_loss_needs_the_history(spark):
    rows = listings(
        spark, {"host_is_superhost": "t", "host_response_rate": "95%"},
        {"host_is_superhost": "f", "host_response_rate": "60%", "snapshot_date": DAY2})
    row = investor.response_rate_before_loss(rows).first()
    assert (row.previous_response_rate, row.response_rate, row.response_change) == (95, 60, -35)


def test_licences_gained_and_lost(spark):
    rows = listings(spark, *[{"license": text, "snapshot_date": day} for text, day in
                             [("Exempt", DAY1), ("00001", DAY2), (None, DAY3)]])
    got = [(r.snapshot_date, r.change) for r in
           investor.license_transitions(facts.listing_facts(rows)).orderBy("snapshot_date").collect()]
    assert got == [(DAY2, "Gained"), (DAY3, "Lost")]


def test_host_versions_join_unbroken_stretches(spark):
    rows = listings(spark, *[{"host_response_rate": rate, "snapshot_date": day} for rate, day in
                             [("90%", DAY1), ("90%", DAY2), ("80%", DAY3)]])
    got = [(int(r.host_response_rate), r.valid_from, r.valid_to, r.is_current)
           for r in investor.host_versions(rows).orderBy("valid_from").collect()]
    assert got == [(90, DAY1, DAY3, 0), (80, DAY3, None, 1)]


def test_mean_rates_leave_out_minus_one(spark):
    rows = listings(spark, {"host_id": 1, "host_response_rate": "80%"},
                    {"host_id": 2, "host_response_rate": "N/A"})
    row = investor.average_rates(dims.dim_host(rows)).first()
    assert (row.avg_response_rate, row.response_hosts, row.response_hosts_without) == (80.0, 1, 1)


def test_gates_find_what_they_look_for(spark):
    rows = listings(spark, {}, {}, {"id": 2, "room_type": None})
    assert [tuple(r) for r in quality.duplicate_listing_snapshots(rows).collect()] == [(1, DAY1, 2)]
    gaps = profiles.required_nulls({"listings": rows}).where("null_rows > 0").collect()
    assert [(r.column_name, r.null_rows) for r in gaps] == [("room_type", 1)]
    assert {r.column_name for r in profiles.required_nulls({"listings": rows}).collect()} == set(
        C.LISTING_REQUIRED)
    tags = {r.tag: r.untagged_rows for r in quality.untagged(rows, reviews(spark, (1, DAY1))).collect()}
    assert tags == {"listings.snapshot_date": 0, "listings.property_category": 3,
                    "reviews.snapshot_date": 0}


def test_orphans_in_every_relation(spark):
    fact = spark.createDataFrame([(1, 9, 1, 1, 1, DAY1)] * 3, "listing_id long, host_id long, "
                                 "property_id int, room_id int, location_id int, snapshot_date date")
    one = lambda key: spark.createDataFrame([(0,), (1,)], f"{key} long")
    tables = {
        "FactListings": fact, "DimHost": one("host_id"), "DimPropertyType": one("property_id"),
        "DimRoomType": one("room_id"), "DimLocation": one("location_id"),
        "DimListings": one("listing_id"), "DimDate": dims.dim_date(spark),
        "FactReviews": spark.createDataFrame([(5, dt.date(1999, 1, 1)), (1, DAY1)],
                                             "listing_id long, date date"),
    }
    got = {r.relation: r.orphan_rows for r in quality.foreign_keys(tables).collect()}
    assert got == {
        "FactListings.host_id": 3, "FactListings.property_id": 0, "FactListings.room_id": 0,
        "FactListings.location_id": 0, "FactListings.listing_id": 0,
        "FactReviews.listing_id": 1, "FactReviews.date": 1}


def test_a_hot_host_changes_nothing(spark):
    """A third of all rows on one host: same answers, one row per task and key shuffled."""
    changes = [{"id": i, "host_id": 1 if i % 3 == 0 else i, "host_name": f"h{i}"}
               for i in range(1, 61)]
    rows = listings(spark, *changes).repartition(4)
    hosts = {r.host_id: r.host_name for r in dims.dim_host(rows).collect()}
    assert hosts[1] == "h1" and len(hosts) == 1 + len({c["host_id"] for c in changes})
    fact, _ = star(spark, rows)
    assert fact.where(F.col("host_id") == 1).count() == 21
