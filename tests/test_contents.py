"""Fingerprints of contents: what they tell apart, and loads that they refuse."""

import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rows import DAY1, DAY2, listings
from snapstar import contracts as C
from snapstar.plans import contents, editions, history, load
from test_load import DAYS, make_feed


def prints(rows, kind="listings"):
    return {(r.snapshot_date, r.column_group): (r.row_count, r.fingerprint)
            for r in contents.fingerprints(rows, kind).collect()}


def differing(one, two):
    a, b = prints(one), prints(two)
    return {group for (_, group), value in a.items() if b.get((_, group)) != value}


def test_each_column_belongs_to_one_group():
    for kind, layout in C.ARCHIVE.items():
        names = [name for name, _ in layout if name != "snapshot_date"]
        found = [c for columns in contents.groups(kind, names).values() for c in columns]
        assert sorted(found) == sorted(names)
    assert "host_name" in contents.groups("listings", ["host_name", "name"])["host"]


def test_order_and_partitions_do_not_matter_repeats_do(spark):
    rows = listings(spark, {"id": 1}, {"id": 2, "price": None}, {"id": 3})
    assert prints(rows) == prints(rows.orderBy(F.desc("id")).repartition(3))
    twice = rows.unionByName(rows.where("id = 3"))
    assert differing(rows, twice) == set(contents.GROUPS["listings"])
    assert prints(rows.limit(0)) == {}


@pytest.mark.parametrize("changes, group", [
    ({"price": "$51.00"}, "listing"), ({"host_name": None}, "host"), ({"host_name": ""}, "host"),
    ({"price_quote_raw": ""}, "quotes"), ({"number_of_reviews": 0}, "reviews"),
])
def test_a_changed_value_shows_in_its_group_only(spark, changes, group):
    assert differing(listings(spark, {}), listings(spark, changes)) == {group}


def test_values_that_change_places_show(spark):
    rows = listings(spark, {"id": 1, "price": "$1"}, {"id": 2, "price": "$2"})
    swapped = listings(spark, {"id": 1, "price": "$2"}, {"id": 2, "price": "$1"})
    assert differing(rows, swapped) == {"listing"}
    # a value that moved into a neighbouring column, where there was none
    one = listings(spark, {"host_about": "x", "host_location": None})
    assert differing(one, listings(spark, {"host_about": None, "host_location": "x"})) == {"host"}
    moved = listings(spark, {"id": 1, "snapshot_date": DAY2})
    assert set(prints(moved)).isdisjoint(prints(listings(spark, {"id": 1, "snapshot_date": DAY1})))


def test_wider_types_keep_the_fingerprint(spark):
    rows = listings(spark, {"id": 2**60 + 1, "beds": 3}, {"id": 2**60, "beds": None})
    wide = rows.withColumn("beds", F.col("beds").cast("double")).withColumn(
        "number_of_reviews_ly", F.col("number_of_reviews_ly").cast("bigint"))
    assert prints(rows) == prints(wide)
    halves = wide.withColumn("beds", F.col("beds") + 0.25)
    assert differing(rows, halves) == {"listing"}
    near = listings(spark, {"id": 2**60 + 2, "beds": 3}, {"id": 2**60, "beds": None})
    assert differing(rows, near) == set(contents.GROUPS["listings"])


@settings(max_examples=8, deadline=None)
@given(names=st.lists(st.sampled_from(["A", "B", "", None]), min_size=1, max_size=5),
       other=st.lists(st.sampled_from(["A", "B", "", None]), min_size=1, max_size=5))
def test_equal_fingerprints_mean_equal_multisets(spark, names, other):
    made = lambda values: listings(spark, *[{"name": v} for v in values])
    order = lambda values: sorted(map(repr, values))
    assert (prints(made(names)) == prints(made(other))) == (order(names) == order(other))


def test_a_load_keeps_fingerprints_that_its_files_answer_to(spark, tmp_path):
    feed, root = make_feed(tmp_path), str(tmp_path / "warehouse")
    load.load(spark, feed, root, DAYS[:1])
    load.load(spark, feed, root, DAYS[1:], approved=["Gazi"], wider={"beds": "double"})
    found = contents.verify(spark, root)
    dates = {(r.table_name, str(r.snapshot_date)) for r in found.collect()}
    assert dates >= {(kind, day) for kind in ("listings", "reviews") for day in DAYS}
    assert found.where(~F.col("agrees")).isEmpty()
    with editions.change(spark, root) as made:  # files changed behind the warehouse's back
        rows = history.read_archive(spark, root, "listings", made).where(
            F.col("snapshot_date") == F.lit(DAYS[1]))
        history.append(rows.withColumn("host_name", F.lit("X")), root, "listings", made)
    bad = contents.verify(spark, root).where(~F.col("agrees")).collect()
    assert [(r.table_name, str(r.snapshot_date), r.column_group, r.rows_before, r.rows_after)
            for r in bad] == [("listings", DAYS[1], "host", 4, 4)]
    load.remove(spark, root, dt.date.fromisoformat(DAYS[1]))
    assert contents.verify(spark, root).where(~F.col("agrees")).isEmpty()


@pytest.mark.parametrize("target, step", [
    ("snapstar.sources.fit.typed", "read and staged"),
    ("snapstar.plans.history.conform", "staged and archived"),
])
def test_equal_counts_do_not_hide_changed_rows(spark, tmp_path, monkeypatch, target, step):
    """A fault in the cast, or in the archiving, that changes a value and no count."""
    feed, root = make_feed(tmp_path, DAYS[:1]), str(tmp_path / "warehouse")
    module, name = target.rsplit(".", 1)
    faulty = __import__(module, fromlist=[name])
    whole, calls = getattr(faulty, name), []

    def changed(rows, kind, *rest):
        out = whole(rows, kind, *rest)
        calls.append(kind)
        if kind == "listings" and calls.count(kind) == 1:
            return out.withColumn("name", F.when(F.col("id") == 1, "Flat 2").otherwise(F.col("name")))
        return out

    monkeypatch.setattr(faulty, name, changed)
    with pytest.raises(C.ContractError, match=f"{step}: listings of {DAYS[0]}, columns of listing"):
        load.load(spark, feed, root)
    assert history.read_archive(spark, root, "listings").isEmpty()
