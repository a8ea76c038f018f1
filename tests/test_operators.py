"""Operators against brute force on small rows."""

import random
import statistics
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapstar.operators.keys import numbered, numbered_names
from snapstar.operators.latest import first_per_group, latest_per_key
from snapstar.operators.matching import keep_known_keys, look_up, not_listed, unmatched_rows
from snapstar.operators.median import grouped_median
from snapstar.operators.tallies import repeated_keys, value_counts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_numbered(spark):
    words = sorted({"".join(random.Random(i).choices("abcdé", k=4)) for i in range(300)})
    keys = spark.createDataFrame([(w,) for w in random.Random(1).sample(words, len(words))], "w string")
    got = numbered(keys, ["w"], "n").collect()
    assert {r.w: r.n for r in got} == {w: i for i, w in enumerate(words, 1)}
    assert numbered(keys.where("false"), ["w"], "n").count() == 0


def test_numbered_by_range_with_two_columns(spark):
    pairs = [(d, w) for d in (1, 2, 3) for w in "abcdefgh"]
    keys = spark.createDataFrame(random.Random(2).sample(pairs, len(pairs)), "d int, w string")
    got = numbered(keys, ["d", "w"], "n").collect()
    assert {(r.d, r.w): r.n for r in got} == {p: i for i, p in enumerate(sorted(pairs), 1)}


def test_latest_per_key_takes_newest_then_lowest_tie(spark):
    rows = spark.createDataFrame(
        [(1, 1, 10, "old"), (1, 2, 12, "tie"), (1, 2, 11, "win"), (2, 1, 5, None)],
        "k int, v int, t int, x string",
    )
    got = {r.k: r.x for r in latest_per_key(rows, "k", "v", "t", ["x"]).collect()}
    assert got == {1: "win", 2: None}


def test_latest_per_key_combines_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("0 as k", "id as v", "id as t", "'x' || id as x")
    plan = plan_of(latest_per_key(rows, "k", "v", "t", ["x"]))
    assert "partial_max" in plan


def test_first_per_group_is_limited_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 as g", "id as o")
    first = first_per_group(rows, "g", ["o"], 2)
    assert sorted((r.g, r.o, r.rn) for r in first.collect()) == [
        (0, 0, 1), (0, 3, 2), (1, 1, 1), (1, 4, 2), (2, 2, 1), (2, 5, 2)]
    assert "WindowGroupLimit" in plan_of(first) and "Partial" in plan_of(first)


def test_look_up_never_loses_or_doubles_rows(spark, tmp_path):
    rows = spark.createDataFrame([("a",), ("b",), (None,), ("Unknown",), ("z",)], "name string")
    members = spark.createDataFrame([(0, "Unknown"), (1, "a"), (2, "b")], "key int, label string")
    members.write.parquet(f"{tmp_path}/members")
    members = spark.read.parquet(f"{tmp_path}/members")
    got = look_up(rows, members, {"name": "label"}, "key")
    assert Counter((r.name, r.key) for r in got.collect()) == Counter(
        {("a", 1): 1, ("b", 2): 1, (None, 0): 1, ("Unknown", 0): 1, ("z", 0): 1})
    assert "BroadcastHashJoin" in plan_of(got)  # the stored members' size is known


def test_keep_known_keys(spark):
    rows = spark.createDataFrame([(k,) for k in [1, 1, 2, 3, None]], "k bigint")
    all_known = spark.createDataFrame([(1,), (2,), (3,)], "k bigint")
    some = spark.createDataFrame([(1,), (3,)], "k bigint")
    known = keep_known_keys(rows, all_known, "k")
    assert sorted(r.k for r in known.collect()) == [0, 1, 1, 2, 3]
    assert "Join" not in plan_of(known)
    partly = keep_known_keys(rows, some, "k")
    assert sorted(r.k for r in partly.collect()) == [0, 0, 1, 1, 3]


def test_unmatched_rows_with_a_hot_key(spark):
    rows = spark.createDataFrame([(9,)] * 50 + [(1,)] * 5 + [(None,)], "k bigint")
    members = spark.createDataFrame([(1,), (2,)], "m bigint")
    assert unmatched_rows(rows, "k", members, "m").first().orphan_rows == 51
    assert unmatched_rows(rows.where("k = 1"), "k", members, "m").first().orphan_rows == 0


def test_not_listed_ignores_nulls_on_both_sides(spark):
    rows = spark.createDataFrame([("a",), ("n",), ("n",), (None,)], "x string")
    members = spark.createDataFrame([("a",), (None,)], "y string")
    assert [r.x for r in not_listed(rows, "x", members, "y").collect()] == ["n"]


@pytest.mark.parametrize("seed", range(4))
def test_grouped_median_is_exact(spark, seed):
    draw = random.Random(seed)
    rows = [
        (g, None if draw.random() < 0.1 else Decimal(draw.randrange(0, 10 ** (3 + g))) / 100)
        for g in range(4) for _ in range(draw.choice([1, 2, 7, 100, 101]))
    ]
    # A third of all rows share one value of one group.
    rows += [(0, Decimal("3.50"))] * (len(rows) // 2)
    table = spark.createDataFrame(rows, "g int, p decimal(10,2)")
    expected = {}
    for g in range(4):
        values = [p for k, p in rows if k == g and p is not None]
        if values:
            expected[g] = statistics.median(values)
    counted = table.groupBy("g", "p").agg(F.count("*").alias("n"))
    got = {r.g: r.median for r in grouped_median(counted, ["g"], "p", "n", 5).collect()}
    assert got == expected


def test_repeated_keys_and_value_counts(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    assert [tuple(r) for r in repeated_keys(rows, ["k"]).collect()] == [(1, 2)]
    counts = value_counts(rows, ["v"]).collect()
    assert {(r.column_name, r.value, r.row_count) for r in counts} == {("v", "a", 2), ("v", None, 1)}


def test_names_are_numbered_in_byte_order(spark):
    names = ["", "a", "ab", "abc", "abd", "b", "é", "éa", "B", "\U0001F600", "ab ", "aa"]
    rows = spark.createDataFrame([(n,) for n in names], "name string").repartition(3)
    got = {r.name: r.n for r in numbered_names(rows, "name", "n").collect()}
    assert sorted(got, key=got.get) == sorted(names, key=str.encode)
    assert sorted(got.values()) == list(range(1, len(names) + 1))
