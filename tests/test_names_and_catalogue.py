"""Names matched without case, chosen once; tables in the session catalogue against the contract."""

import pytest

from rows import listings
from snapstar.functions.comparison import relaxed_names
from snapstar.plans import catalogue, dimensions as dims, editions, facts, load
from test_load import DAYS, listing, make_feed

ODD = [
    {}, {"id": 2, "property_type": "ENTIRE rental UNIT  ", "room_type": "entire HOME/apt"},
    {"id": 3, "property_type": "Hotel room", "neighbourhood_cleansed": "plaka "},
    {"id": 4, "property_type": None, "neighbourhood_cleansed": "elsewhere"},
    {"id": 5, "property_type": "boat"}, {"id": 6, "property_type": "hotel ROOM"},
]


def test_odd_spellings_are_one_member(spark):
    rows = listings(spark, *ODD)
    blind = relaxed_names(rows)
    direct, observed = (
        dims.dim_property_type(r) for r in (blind, dims.observed_names(blind)["property_type"]))
    members = sorted(map(tuple, direct.collect()))
    assert members == sorted(map(tuple, observed.collect())) == [
        (0, "Unknown", "Unknown"), (1, "ENTIRE rental UNIT  ", "Entire Property"),
        (2, "Hotel room", "Hotel / Serviced"), (3, "boat", "Unique / Other")]
    assert dims.dim_property_type(rows).count() == 6  # Unknown and five spellings
    places = spark.createDataFrame([(0, "Unknown"), (1, "PLAKA")],
                                   "location_id int, neighbourhood_cleansed string")
    keys = facts.fact_listings(
        blind, direct, dims.dim_room_type(blind), places, dims.dim_host(rows)
    ).select("listing_id", "property_id", "room_id", "location_id").collect()
    assert sorted(map(tuple, keys)) == [
        (1, 1, 1, 1), (2, 1, 1, 1), (3, 2, 1, 1), (4, 0, 1, 0), (5, 3, 1, 1), (6, 2, 1, 1)]


def test_new_names_by_either_rule(spark):
    names = spark.createDataFrame([("plaka",), ("Gazi",), ("GAZI ",), (None,)], "neighbourhood string")
    known = spark.createDataFrame([("PLAKA",)], "neighbourhood_cleansed string")
    waiting = lambda rows: sorted(r[0] for r in dims.new_neighbourhoods(rows, known).collect())
    assert waiting(relaxed_names(names)) == ["GAZI "]
    assert waiting(names) == ["GAZI ", "Gazi", "plaka"]


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    tmp = tmp_path_factory.mktemp("names")
    feed = make_feed(tmp, DAYS[:2], {DAYS[1]: [
        listing(9, property_type="ENTIRE RENTAL UNIT ", neighbourhood_cleansed="PLAKA",
                room_type="Entire Home/Apt")]})
    root = str(tmp / "w")
    load.load(spark, feed, root, DAYS[:2])
    return root


def test_a_warehouse_chooses_once(spark, warehouse):
    exact = load.rebuild(spark, warehouse)
    assert (exact["DimPropertyType"].count(), exact["DimRoomType"].count()) == (3, 3)
    assert exact["FactListings"].where("location_id = 0").count() == 1
    load.match_names(spark, warehouse, without_case=True)
    for star in (load.refresh(spark, warehouse), load.rebuild(spark, warehouse)):
        assert (star["DimPropertyType"].count(), star["DimRoomType"].count()) == (2, 2)
        assert star["FactListings"].where("location_id = 0 or property_id <> 1").count() == 0
        assert star["FactListings"].count() == 8


def test_catalogue_follows_the_edition(spark, warehouse):
    load.rebuild(spark, warehouse)
    names = catalogue.register(spark, warehouse, "names_test")
    assert {n.lower() for n in names} == set(catalogue.table_list(spark, "names_test"))
    assert len(names) == 11
    assert catalogue.differences(spark, warehouse, "names_test").collect() == []
    assert catalogue.partitions(spark, "listings_history", "names_test") == DAYS[:2]
    one = spark.table("names_test.listings_history").where(f"snapshot_date = date'{DAYS[0]}'")
    assert one.count() == 3 and spark.table("names_test.FactListings").count() == 8
    assert "PartitionFilters: [isnotnull(snapshot_date" in (
        one._jdf.queryExecution().executedPlan().toString())
    # A lost table, an unknown one and a changed type show.
    spark.sql("DROP TABLE names_test.DimHost")
    spark.sql("CREATE TABLE names_test.strange (x int) USING parquet")
    spark.sql("DROP TABLE names_test.reviews_history")
    spark.sql("CREATE TABLE names_test.reviews_history (listing_id int, id bigint, date date, "
              "reviewer_id bigint, reviewer_name string, comments string) USING parquet")
    found = sorted(tuple(r) for r in catalogue.differences(spark, warehouse, "names_test").collect())
    assert sorted((t, c or "", p) for t, c, p in found) == [
        ("DimHost", "", "table is missing"),
        ("reviews_history", "listing_id", "is int, not bigint"),
        ("reviews_history", "snapshot_date", "column is missing"),
        ("strange", "", "table is unknown")]
    catalogue.register(spark, warehouse, "names_test")
    assert catalogue.differences(spark, warehouse, "names_test").collect() == []
    spark.sql("DROP DATABASE names_test CASCADE")
    assert editions.edition(spark, warehouse).parts("star/DimHost")
