"""CSV snapshots: discovery, reading, fit checks and typing."""

import datetime as dt

import pytest

from snapstar import contracts as C
from snapstar.plans import history
from snapstar.sources import csv_snapshots, fit


@pytest.fixture()
def feed(tmp_path):
    def write(name, text):
        path = tmp_path / "feed" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
    write("q1/2025-06-24_neighbourhoods.csv", 'neighbourhood_group,neighbourhood\n,"Plaka"\n,N/A\n')
    write("q1/2025-06-24_reviews.csv",
          'listing_id,id,date,reviewer_id,reviewer_name,comments\n'
          '1,10,2024-01-01,5,Ann,"two\nlines, ""quoted"""\n1,11,2024-01-02,6,"",N/A\n')
    write("q2/2025-09-26_reviews.csv",
          'listing_id,id,date,reviewer_id,reviewer_name,comments\n1,10,2024-01-01,5,Ann,x\n')
    write("q2/2025-09-26_calendar.csv", "listing_id,date\n1,2024-01-01\n")
    write("q2/notes.csv", "a\n1\n")
    return str(tmp_path / "feed")


def test_discovery_routes_by_name_and_subfolder(spark, feed):
    got = {(r.snapshot.rsplit("/", 1)[-1], r.kind, r.subfolder, r.action)
           for r in csv_snapshots.discover(spark, feed).collect()}
    assert got == {
        ("2025-06-24_neighbourhoods.csv", "neighbourhoods", "q1", "load"),
        ("2025-06-24_reviews.csv", "reviews", "q1", "load"),
        ("2025-09-26_reviews.csv", "reviews", "q2", "load"),
        ("2025-09-26_calendar.csv", "calendar", "q2", "skip"), ("notes.csv", "", "q2", "skip")}
    assert csv_snapshots.discover(spark, feed, ["q1"]).count() == 2


def test_no_file_is_an_error(spark, feed):
    with pytest.raises(FileNotFoundError, match="listings"):
        csv_snapshots.read_snapshots(spark, feed, "listings")
    with pytest.raises(FileNotFoundError, match="q9"):
        csv_snapshots.read_snapshots(spark, feed, "reviews", ["q9"])


def test_text_rows_keep_everything_but_empty(spark, feed):
    rows = csv_snapshots.read_snapshots(spark, feed, "reviews").orderBy("snapshot_date", "id")
    first, second, third = rows.collect()
    assert first.comments == 'two\nlines, "quoted"'
    assert second.comments == "N/A" and second.reviewer_name is None
    assert [r.snapshot_date for r in (first, second, third)] == [
        dt.date(2025, 6, 24), dt.date(2025, 6, 24), dt.date(2025, 9, 26)]
    assert all(kind == "string" for name, kind in rows.dtypes if name != "snapshot_date")


def test_layouts_with_more_columns_load_beside_older_ones(spark, feed, tmp_path):
    path = tmp_path / "feed" / "q3" / "2026-06-28_reviews.csv"
    path.parent.mkdir()
    path.write_text("id,listing_id,date,reviewer_id,reviewer_name,comments,extra\n"
                    "12,1,2026-01-01,5,Bo,y,new\n")
    rows = csv_snapshots.read_snapshots(spark, feed, "reviews").collect()
    assert {r.id: (r.listing_id, r.extra) for r in rows} == {
        "10": ("1", None), "11": ("1", None), "12": ("1", "new")}
    with pytest.raises(C.ContractError, match="unknown columns \\['extra'\\]"):
        csv_snapshots.check_columns(csv_snapshots.read_snapshots(spark, feed, "reviews"), "reviews")


def test_part_files_of_one_snapshot(spark, tmp_path):
    rows = spark.createDataFrame([(None, f"N{i}") for i in range(6)],
                                 "neighbourhood_group string, neighbourhood string")
    target = f"{tmp_path}/feed/q1/2025-06-24_neighbourhoods.csv"
    rows.repartition(3).write.csv(target, header=True)
    found = csv_snapshots.discover(spark, f"{tmp_path}/feed").collect()
    assert [(r.kind, r.action) for r in found] == [("neighbourhoods", "load")]
    read = csv_snapshots.read_snapshots(spark, f"{tmp_path}/feed", "neighbourhoods")
    assert read.count() == 6 and read.where("snapshot_date = date'2025-06-24'").count() == 6


def test_fallback_types():
    expected = {
        "id": "bigint", "scrape_id": "bigint", "latitude": "double", "bathrooms": "double",
        "host_since": "text(20)", "price_quote_checkin_date": "text(20)", "last_scraped": "text(20)",
        "availability_365": "int", "minimum_nights": "int", "beds": "int",
        "calculated_host_listings_count_entire_homes": "int", "number_of_reviews": "int",
        "description": "text", "estimated_revenue_l365d": "text",
    }
    assert {c: C.fallback_type(c) for c in expected} == expected
    assert C.staging_type("listings", "price") == "text(20)"
    assert C.staging_type("listings", "number_of_reviews_ltm") == "smallint"


RAW = "id string, beds string, minimum_nights string, host_name string, maximum_nights string, " \
      "price string"


def raw(spark):
    return spark.createDataFrame([
        ("9007199254740993", "2", "1.5", "x" * 101, None, "$1.00"),
        ("2", "2.0", "3", "Ann", None, None), ("3", "two", None, None, None, "$" * 20),
    ], RAW)


def test_fit_report(spark):
    fits = {r.column_name: r.fit for r in fit.numeric_fit(raw(spark), "listings").collect()}
    assert fits == {"id": "int", "beds": "text", "minimum_nights": "float", "maximum_nights": "int"}
    texts = {r.column_name: (r.longest, r.fits) for r in fit.text_fit(raw(spark), "listings").collect()}
    assert texts == {"host_name": (101, False), "price": (20, True)}
    report = {r.column_name: (r.declared_type, r.final_type, r.reason)
              for r in fit.widening_report(raw(spark), "listings").collect()}
    assert report == {
        "id": ("bigint", "bigint", None), "beds": ("int", "text", "holds text that is no number"),
        "minimum_nights": ("int", "double", "holds fractions"),
        "host_name": ("text(100)", "text", "needs room for 101 characters"),
        "maximum_nights": ("int", "int", None), "price": ("text(20)", "text(20)", None)}


def test_typed_rows_follow_the_report(spark):
    rows = fit.typed(raw(spark), "listings", fit.widening_report(raw(spark), "listings"))
    assert dict(rows.dtypes) == {"id": "bigint", "beds": "string", "minimum_nights": "double",
                                 "host_name": "string", "maximum_nights": "int", "price": "string"}
    first = rows.first()
    assert first.id == 9007199254740993 and first.minimum_nights == 1.5


def test_a_value_that_cannot_be_cast_stops_the_load(spark):
    rows = spark.createDataFrame([("9.999",), ("high",)], "review_scores_rating string")
    with pytest.raises(Exception, match="cannot hold high"):
        history.conform(rows, "listings").collect()
    too_big = spark.createDataFrame([("70000",)], "number_of_reviews_ltm string")
    with pytest.raises(Exception, match="cannot hold 70000"):
        history.conform(too_big, "listings").collect()
