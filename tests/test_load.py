"""Whole loads from CSV files, and the properties that make the archive trustworthy."""

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from snapstar import contracts as C
from snapstar.plans import facts, history, load, quality

DAYS = ["2025-06-24", "2025-09-26", "2026-06-28"]


def _write(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        writer.writerows([[row.get(c, "") for c in header] for row in rows])


def listing(i, **changes):
    return {"id": i, "host_id": 70 + i % 2, "latitude": "37.9", "longitude": "23.7",
            "name": f"Flat {i}", "description": 'Near the "old" town,\nquiet', "price": "$1,050.00",
            "neighbourhood_cleansed": "Plaka", "property_type": "Entire rental unit",
            "room_type": "Entire home/apt", "accommodates": "2", "minimum_nights": "3",
            "host_since": "2015-02-01", "host_is_superhost": "t", "host_response_rate": "90%",
            "scrape_id": "1", "minimum_nights_avg_ntm": "3.5", **changes}


def make_feed(tmp_path, days=DAYS, extra=None):
    base = list(C.expected_file_columns("listings"))
    narrow = [c for c in base if c not in C.LISTING_QUOTE_COLUMNS] + list(C.LISTING_DROPPED[:22])
    wide = base + list(C.LISTING_DROPPED)
    for n, day in enumerate(days):
        rows = [listing(i) for i in range(1, 4 + n)]
        if n:
            rows[0] |= {"host_is_superhost": "f", "name": "Renamed"}
        if n == 2:
            rows[0] |= {"price_quote_checkin_date": "2026-07-01", "price_quote_raw": "raw"}
        rows += (extra or {}).get(day, [])
        folder = tmp_path / "feed" / day
        _write(folder / f"{day}_listings.csv", wide if n == 2 else narrow, rows)
        _write(folder / f"{day}_reviews.csv",
               ["listing_id", "id", "date", "reviewer_id", "reviewer_name", "comments"],
               [{"listing_id": 1 if r % 4 else 99, "id": r, "date": "2024-05-01", "reviewer_id": 5,
                 "reviewer_name": "Ann", "comments": "ok"} for r in range(n, 8 + n)])
        _write(folder / f"{day}_neighbourhoods.csv", ["neighbourhood_group", "neighbourhood"],
               [{"neighbourhood": name} for name in ["Plaka", "Psyrri"] + ["Gazi"] * (n > 0)])
    return str(tmp_path / "feed")


def content(star):
    return {name: sorted(map(str, rows.collect())) for name, rows in star.items()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("load")
    feed, root = make_feed(tmp), str(tmp / "warehouse")
    reports = [load.load(spark, feed, root, [day]) for day in DAYS]
    star = load.rebuild(spark, root)
    return feed, root, reports, star


def test_archives_and_star(spark, loaded):
    _, root, reports, star = loaded
    counts = {(r.table_name, str(r.snapshot_date)): r.row_count for r in quality.history_counts(
        history.read_archive(spark, root, "listings"),
        history.read_archive(spark, root, "reviews")).collect()}
    assert counts == {(t, d): n for t, ns in (("listings", (3, 4, 5)), ("reviews", (8, 8, 8)))
                      for d, n in zip(DAYS, ns)}
    assert all(r.agrees for report in reports for r in report["reconciled"].collect())
    assert star["FactListings"].count() == 12 and star["FactReviews"].count() == 10
    assert star["FactListings"].where("price = 1050.00").count() == 12
    assert {r.name for r in star["DimListings"].where("listing_id = 1").collect()} == {"Renamed"}
    checks = {r.check: (r.value, r.expected) for r in load.acceptance(spark, root).collect()}
    assert all(expected in (None, value) for value, expected in checks.values())
    assert checks["orphaned_review_listing_ids"][0] == 3  # reviews 0, 4 and 8
    archive = history.read_archive(spark, root, "listings")
    assert len(archive.columns) == 64 and quality.schema_differences(archive, "listings") == []
    changed = archive.selectExpr("* except (id, price)", "cast(id as int) as id", "1 as x")
    assert quality.schema_differences(changed, "listings") == [
        "missing price", "unknown x", "id is int, not bigint"]
    columns = quality.column_list(load.read_star(spark, root))
    assert ("DimRoomType", 1, "room_id", "int", True) in columns
    assert {row[0] for row in columns} == set(load.STAR)


def test_quote_columns_are_null_before_they_existed(spark, loaded):
    _, root, _, _ = loaded
    rows = history.read_archive(spark, root, "listings").where("price_quote_raw is not null")
    assert [(str(r.snapshot_date), r.price_quote_checkin_date) for r in rows.collect()] == [
        ("2026-06-28", "2026-07-01")]


def test_new_neighbourhoods_wait_for_approval(spark, loaded):
    _, _, reports, star = loaded
    waiting = [[r.neighbourhood for r in report["new_neighbourhoods"].collect()] for report in reports]
    assert waiting[1:] == [["Gazi"], ["Gazi"]]
    assert {r.neighbourhood_cleansed for r in star["DimLocation"].collect()} == {
        "Unknown", "Plaka", "Psyrri"}


def test_second_load_of_a_snapshot_is_refused(spark, loaded):
    feed, root, _, _ = loaded
    before = history.read_archive(spark, root, "listings").count()
    with pytest.raises(history.SnapshotExists, match="2025-09-26"):
        load.load(spark, feed, root, ["2025-09-26"])
    assert history.read_archive(spark, root, "listings").count() == before


def test_order_of_loading_and_batching_do_not_matter(spark, loaded, tmp_path):
    feed, _, _, star = loaded
    root = str(tmp_path / "other")
    load.load(spark, feed, root, [DAYS[0]])  # neighbourhood keys start with the first load
    load.load(spark, feed, root, [DAYS[2], DAYS[1]])
    assert content(load.rebuild(spark, root)) == content(star)


def test_removed_snapshot_leaves_no_trace(spark, loaded, tmp_path):
    feed, _, _, _ = loaded
    with_all, without = str(tmp_path / "a"), str(tmp_path / "b")
    load.load(spark, feed, with_all, [DAYS[0]])
    load.load(spark, feed, with_all, DAYS[1:], approved=["Gazi"])
    history.remove(spark, with_all, dt.date.fromisoformat(DAYS[2]))
    load.load(spark, feed, without, [DAYS[0]])
    load.load(spark, feed, without, [DAYS[1]], approved=["Gazi"])
    assert content(load.rebuild(spark, with_all)) == content(load.rebuild(spark, without))
    # and the snapshot can be loaded again
    load.load(spark, feed, with_all, [DAYS[2]])
    assert history.read_archive(spark, with_all, "listings").count() == 12


@pytest.mark.parametrize("bad, message", [
    (listing(1), "listing 1 twice in 2025-06-24"),
    (listing(9, room_type=""), "listings.room_type: 1 nulls"),
])
def test_bad_snapshot_is_refused_before_anything_is_written(spark, tmp_path, bad, message):
    feed = make_feed(tmp_path, DAYS[:1], {DAYS[0]: [bad]})
    root = str(tmp_path / "warehouse")
    with pytest.raises(C.ContractError, match=message):
        load.load(spark, feed, root)
    assert history.read_archive(spark, root, "listings").isEmpty()
    assert history.read_archive(spark, root, "reviews").isEmpty()


def test_a_load_that_died_half_way_can_be_repeated(spark, tmp_path):
    feed, root = make_feed(tmp_path, DAYS[:1]), str(tmp_path / "warehouse")
    reviews, _ = load.stage(spark, feed, root, "reviews")
    history.append(reviews, root, "reviews")  # listings, the commit mark, never came
    load.load(spark, feed, root)
    assert history.read_archive(spark, root, "reviews").count() == 8


def test_text_in_a_number_column_is_reported_and_stops_the_append(spark, tmp_path):
    feed = make_feed(tmp_path, DAYS[:1], {DAYS[0]: [listing(9, beds="many")]})
    root = str(tmp_path / "warehouse")
    _, report = load.stage(spark, feed, root, "listings")
    assert [(r.column_name, r.final_type) for r in report.where("reason is not null").collect()] == [
        ("beds", "text")]
    with pytest.raises(Exception, match="beds cannot hold many"):
        load.load(spark, feed, root)
    assert all(history.read_archive(spark, root, kind).isEmpty() for kind in load.KINDS)


def test_a_fraction_in_a_whole_column_stops_the_load_before_any_append(spark, tmp_path):
    feed = make_feed(tmp_path, DAYS[:1], {DAYS[0]: [listing(9, accommodates="3.7")]})
    root = str(tmp_path / "warehouse")
    with pytest.raises(Exception, match="accommodates cannot hold 3.7"):
        load.load(spark, feed, root)
    assert all(history.read_archive(spark, root, kind).isEmpty() for kind in load.KINDS)


def test_location_keys_outlive_an_older_snapshot_loaded_later(spark, tmp_path):
    feed, root = make_feed(tmp_path), str(tmp_path / "warehouse")
    load.load(spark, feed, root, [DAYS[2]])
    first = {r.neighbourhood_cleansed: r.location_id
             for r in load.rebuild(spark, root)["DimLocation"].collect()}
    _write(tmp_path / "feed" / DAYS[0] / f"{DAYS[0]}_neighbourhoods.csv",
           ["neighbourhood_group", "neighbourhood"], [{"neighbourhood": "Anafiotika"}])
    load.load(spark, feed, root, [DAYS[0]], approved=["Anafiotika"])
    later = {r.neighbourhood_cleansed: r.location_id
             for r in load.rebuild(spark, root)["DimLocation"].collect()}
    assert later == first | {"Anafiotika": max(first.values()) + 1}


def test_stored_categories_follow_changed_rules(spark, tmp_path):
    feed, root = make_feed(tmp_path, DAYS[:2]), str(tmp_path / "warehouse")
    load.load(spark, feed, root)
    assert history.retag_archive(spark, root) == 0
    old = history.read_archive(spark, root, "listings").where("snapshot_date = date'2025-06-24'")
    history.append(old.withColumn("property_category", F.lit("Old")).checkpoint(), root, "listings")
    assert history.retag_archive(spark, root) == 3
    rows = history.read_archive(spark, root, "listings").groupBy("property_category").count()
    assert [tuple(r) for r in rows.collect()] == [("Entire Property", 7)]


def test_retag_and_backfill_of_categories(spark):
    rows = spark.createDataFrame([("Cave", "Kept"), ("Cave", None)],
                                 "property_type string, property_category string")
    assert [r.property_category for r in history.with_category(rows).collect()] == [
        "Kept", "Unique / Other"]
    assert {r.property_category for r in history.retag_categories(rows).collect()} == {
        "Unique / Other"}


def test_a_snapshot_filter_reads_its_partition_only(spark, loaded):
    _, root, _, _ = loaded
    one = history.read_archive(spark, root, "listings").where("snapshot_date = date'2025-06-24'")
    plan = one.select("id", "price")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan
    assert "ReadSchema: struct<id:bigint,price:string>" in plan


def test_review_texts_stay_in_the_archive(spark, loaded):
    _, root, _, _ = loaded
    fact = facts.fact_reviews(history.read_archive(spark, root, "reviews"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<listing_id:bigint,id:bigint,date:date,reviewer_id:bigint>" in plan
    assert "partial_max" in plan and "Window" not in plan
