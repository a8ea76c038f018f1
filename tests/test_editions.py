"""Tables that switch together, state of newest rows, widened columns."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rows import DAY1, DAY2, DAY3, listings, reviews
from snapstar import contracts as C
from snapstar.plans import dimensions as dims, editions, facts, history, latest_state, load, quality
from test_load import DAYS, content, listing, make_feed


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def archives(spark, root):
    return [history.read_archive(spark, root, kind) for kind in ("listings", "reviews")]


def same_as_scan(spark, root):
    held, seen = archives(spark, root)
    return (
        rows_of(latest_state.dim_host(spark, root)) == rows_of(dims.dim_host(held))
        and rows_of(latest_state.dim_listings(spark, root)) == rows_of(dims.dim_listings(held))
        and rows_of(latest_state.fact_reviews(spark, root)) == rows_of(facts.fact_reviews(seen)))


def add(spark, root, *parts):
    with editions.change(spark, root) as made:
        dates = set()
        for kind, rows in parts:
            before = set(made.parts(f"history/{kind}"))
            history.append(rows, root, kind, made)
            dates |= set(made.parts(f"history/{kind}")) - before
        latest_state.add(made, sorted(map(dt.date.fromisoformat, dates)))


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(latest_state, "BUCKETS", 4)


def test_state_in_any_order_and_after_removals(spark, tmp_path):
    """Late snapshots, ties between listings of a host, keys that come and go, removals."""
    rng, root = random.Random(2), str(tmp_path)
    days = [DAY3, DAY1, dt.date(2026, 9, 30), DAY2]
    for day in days:
        held = [
            {"id": i, "host_id": rng.choice([7, 8, 9]), "snapshot_date": day,
             "name": rng.choice(["A", "B", None]), "host_name": rng.choice(["Ann", "Bo", None])}
            for i in rng.sample(range(1, 9), rng.randrange(1, 8))]
        seen = [(r, day) for r in rng.sample(range(20), rng.randrange(1, 15))]
        add(spark, root, ("listings", listings(spark, *held)), ("reviews", reviews(spark, *seen)))
    assert same_as_scan(spark, root)
    for day in (days[2], days[1]):  # the newest and the oldest
        load.remove(spark, root, day)
        assert same_as_scan(spark, root)


def test_a_merge_reads_the_new_snapshot_and_moves_only_it(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, ("listings", listings(spark, {}, {"id": 2})), ("reviews", reviews(spark, (1, DAY1))))
    with editions.change(spark, root) as made:
        history.append(listings(spark, {"snapshot_date": DAY2}), root, "listings", made)
        state = latest_state.read_state(spark, root, "hosts", made)
        kind = latest_state.KINDS["hosts"]
        fresh = latest_state.found(
            history.read_archive(spark, root, "listings", made).where(
                F.col("snapshot_date") == DAY2), kind).repartition(latest_state.BUCKETS, "host_id")
        both = latest_state.merged(state, fresh, "host_id")
        files = both.inputFiles()
        assert any("/state/hosts/" in f for f in files)
        plan = both._jdf.queryExecution().executedPlan().toString()
        old_side = plan[plan.index("SortMergeJoin"):plan.index("_key#", plan.index("Sort [_key"))]
        assert "Exchange" not in old_side and "Bucketed: true" in old_side
        assert f"PartitionFilters: [isnotnull(snapshot_date" in plan
        latest_state.add(made, [DAY2])
    assert same_as_scan(spark, root)


def test_refresh_is_the_rebuild(spark, tmp_path):
    feed, root = make_feed(tmp_path), str(tmp_path / "a")
    load.load(spark, feed, root, [DAYS[0], DAYS[2]])
    load.refresh(spark, root)
    load.load(spark, feed, root, [DAYS[1]], approved=["Gazi"])
    refreshed = content(load.refresh(spark, root))
    before = editions.edition(spark, root)
    load.remove(spark, root, dt.date.fromisoformat(DAYS[2]))
    fewer = content(load.refresh(spark, root))
    after = editions.edition(spark, root)
    assert fewer == content(load.rebuild(spark, root)) != refreshed
    was, now = (held.parts("star/FactListings") for held in (before, after))
    assert now == {date: was[date] for date in DAYS[:2]}  # not written again
    load.load(spark, feed, root, [DAYS[2]])
    assert content(load.rebuild(spark, root)) == refreshed


def test_a_load_killed_at_any_write_leaves_the_edition_before(spark, tmp_path, monkeypatch):
    feed, root = make_feed(tmp_path, DAYS[:2]), str(tmp_path / "w")
    load.load(spark, feed, root, [DAYS[0]])
    load.refresh(spark, root)
    number, whole = editions.edition(spark, root).number, editions.Change.put
    state = lambda: (
        [rows_of(rows) for rows in archives(spark, root)], content(load.read_star(spark, root)))
    before = state()
    for last in (0, 1, 3, 5, 6):  # two archives (no name was approved), four tables of state
        calls = []

        def put(self, *args, **named):
            if len(calls) == last:
                raise RuntimeError("killed")
            calls.append(args)
            return whole(self, *args, **named)

        monkeypatch.setattr(editions.Change, "put", put)
        try:
            load.load(spark, feed, root, [DAYS[1]])
        except RuntimeError:
            assert last < 6 and editions.edition(spark, root).number == number
        else:
            assert last == 6
    monkeypatch.setattr(editions.Change, "put", whole)
    loaded = state()
    assert loaded[1] == before[1] and loaded[0] != before[0]  # the star waits for its refresh
    assert editions.vacuum(spark, root, hours=1) == []  # young folders may be a running load's
    gone = editions.vacuum(spark, root, hours=0)
    assert {path.split("/load=")[0] for path in gone} >= {
        "history/listings", "history/reviews", "state/hosts"}
    assert state() == loaded and editions.vacuum(spark, root, hours=0) == []
    assert editions.numbers(spark, root) == [editions.edition(spark, root).number]


def test_one_of_two_changes_on_the_same_edition_is_refused(spark, tmp_path):
    root = str(tmp_path)
    first, second = editions.Change(spark, root), editions.Change(spark, root)
    first.store("star/X", spark.range(1))
    second.store("star/X", spark.range(2))
    first.publish()
    with pytest.raises(editions.EditionConflict):
        second.publish()
    held = editions.edition(spark, root)
    assert editions.stored(spark, root, held, "star/X").count() == 1


def test_an_earlier_edition_can_still_be_read(spark, tmp_path):
    root = str(tmp_path)
    history.append(listings(spark, {}), root, "listings")
    history.append(listings(spark, {"snapshot_date": DAY2}), root, "listings")
    history.remove(spark, root, DAY1)
    counts = [
        history.read_archive(spark, root, "listings", editions.edition(spark, root, n)).count()
        for n in editions.numbers(spark, root)]
    assert counts == [1, 2, 1]


def test_a_fraction_is_loaded_under_an_approved_wider_type(spark, tmp_path):
    feed = make_feed(tmp_path, DAYS[:2], {DAYS[1]: [listing(9, beds="2.5")]})
    root = str(tmp_path / "w")
    load.load(spark, feed, root, [DAYS[0]])
    with pytest.raises(Exception, match="beds cannot hold 2.5"):
        load.load(spark, feed, root, [DAYS[1]])
    assert dict(history.read_archive(spark, root, "listings").dtypes)["beds"] == "int"
    load.load(spark, feed, root, [DAYS[1]], wider={"beds": "double"})
    archive = history.read_archive(spark, root, "listings")
    assert dict(archive.dtypes)["beds"] == "double"
    assert {r.beds for r in archive.collect()} == {None, 2.5}
    paths = {p.types.get("beds") for p in editions.edition(spark, root).parts("history/listings").values()}
    assert paths == {None, "double"}  # the older snapshot was not written again
    one = archive.where(f"snapshot_date = date'{DAYS[0]}'")
    plan = one.select("id", "beds")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint,beds:int>" in plan
    assert load.rebuild(spark, root)["FactListings"].count() == 8


@pytest.mark.parametrize("column, target", [("beds", "smallint"), ("id", "double"), ("name", "int")])
def test_a_type_that_could_lose_values_is_refused(spark, tmp_path, column, target):
    with pytest.raises(C.ContractError, match=f"{column}: .* cannot become {target}"):
        history.widen(editions.Change(spark, str(tmp_path)), "listings", {column: target})
