"""Host versions as stored intervals: any order of snapshots gives the table of a full scan."""

import datetime as dt
import random

import pytest

from catalogue import history_queries, inputs
from rows import DAY1, listings
from snapstar.plans import editions, history, host_history, investor, latest_state


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def same_as_scan(spark, root):
    scan = investor.host_versions(history.read_archive(spark, root, "listings"))
    kept = host_history.host_versions(spark, root)
    assert kept.columns == scan.columns
    assert rows_of(kept) == rows_of(scan)
    return kept.count()


def add(spark, root, *parts):
    with editions.change(spark, root) as made:
        days = []
        for day, rows in parts:
            history.append(rows, root, "listings", made)
            days.append(day)
        host_history.add(made, days)


def take_out(spark, root, day):
    with editions.change(spark, root) as made:
        history.remove(spark, root, day, made)
        host_history.take_out(made, day)


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(latest_state, "BUCKETS", 4)


def drawn(spark, rng, day):
    return listings(spark, *[
        {"id": i, "host_id": rng.choice([7, 8, 9, 10]), "snapshot_date": day,
         "host_is_superhost": rng.choice(["t", "t", "f", None]),
         "host_response_rate": rng.choice(["90%", "90%", "N/A", None])}
        for i in rng.sample(range(1, 12), rng.randrange(1, 8))])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_snapshots_and_removals(spark, tmp_path, seed):
    rng, root = random.Random(seed), str(tmp_path)
    days = [dt.date(2024, 1 + n, 1) for n in range(6)]
    rng.shuffle(days)
    batches = [(day, drawn(spark, rng, day)) for day in days]
    add(spark, root, *batches[:2])
    for batch in batches[2:]:
        add(spark, root, batch)
    same_as_scan(spark, root)
    for day in rng.sample(days, 3):
        take_out(spark, root, day)
    same_as_scan(spark, root)


def one_host(spark, day, superhost):
    return day, listings(spark, {"snapshot_date": day, "host_is_superhost": superhost})


def test_a_late_snapshot_splits_and_its_removal_joins(spark, tmp_path):
    root, days = str(tmp_path), [dt.date(2024, 1, n) for n in (1, 2, 3, 4)]
    add(spark, root, *[one_host(spark, day, "t") for day in (days[0], days[2])])
    assert same_as_scan(spark, root) == 1
    add(spark, root, one_host(spark, days[1], "f"))
    assert same_as_scan(spark, root) == 3
    add(spark, root, one_host(spark, days[3], "t"))  # within the last interval
    assert same_as_scan(spark, root) == 3
    take_out(spark, root, days[1])
    assert same_as_scan(spark, root) == 1
    for day in (days[0], days[2], days[3]):
        take_out(spark, root, day)
    assert same_as_scan(spark, root) == 0
    add(spark, root, one_host(spark, days[1], "f"))
    assert same_as_scan(spark, root) == 1


def test_a_removal_reads_no_snapshot_and_a_merge_only_the_new_one(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, one_host(spark, DAY1, "t"))
    late = dt.date(2024, 5, 1)
    with editions.change(spark, root) as made:
        history.append(one_host(spark, late, "f")[1], root, "listings", made)
        state = host_history.read_state(spark, root, made)
        rest = host_history.without(state, DAY1)
        assert not [f for f in rest.inputFiles() if "history" in f]
        assert "Exchange" not in rest._jdf.queryExecution().executedPlan().toString()
        host_history.add(made, [late])
    assert same_as_scan(spark, root) == 2


def test_an_append_outside_a_load_leaves_no_stale_state(spark, tmp_path):
    root = str(tmp_path)
    add(spark, root, one_host(spark, DAY1, "t"))
    history.append(one_host(spark, dt.date(2024, 5, 1), "f")[1], root, "listings")
    assert not host_history.kept(editions.edition(spark, root))


def test_snapshots_are_derived_once_and_merged_one_by_one(spark, monkeypatch):
    sf_dir = "/root/testdata/sf0.001"
    plan = inputs.listings(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line and "o_custkey" in line]
    assert len(scans) == 1
    written, merged = [], []
    append, add_ = history.append, host_history.add
    monkeypatch.setattr(history, "append", lambda rows, *args: written.append(1) or append(rows, *args))
    monkeypatch.setattr(
        host_history, "add", lambda made, days, *args: merged.append(days) or add_(made, days, *args))
    history_queries.state_host_versions_after_removal(spark, sf_dir)
    days = sorted(day for one in merged for day in one)
    assert len(written) == 1 and merged == [[day] for day in days[1::2] + days[0::2]] and len(days) == 7
