"""Shuffle files of stored rows are given back when the rows are written."""

from __future__ import annotations

import glob
import io
import os
import time
from contextlib import redirect_stdout

from pyspark.sql import functions as F

from snapstar.llm import jaccard

SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffled(spark) -> set[str]:
    local = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", "/tmp")
    return set(glob.glob(f"{local}/blockmgr-*/*/shuffle_*.data"))


def test_stored_rows_leave_no_shuffle_files(spark):
    before, rows = shuffled(spark), spark.range(2_000).withColumn("k", F.col("id") % 7)
    plain = rows.groupBy("k").count()
    plain.collect()
    kept = shuffled(spark) - before
    assert kept  # else this test sees nothing
    setting = spark.conf.get(SETTING)
    stored = jaccard._stored(rows.repartition("k").groupBy("id").agg(F.max("k").alias("k")), "release")
    for _ in range(100):
        if not shuffled(spark) - before - kept:
            break
        time.sleep(0.1)
    assert not shuffled(spark) - before - kept
    assert spark.conf.get(SETTING) == setting
    assert stored.count() == 2_000 and plain.count() == 7


def test_rows_that_meet_themselves_are_dealt_once(spark):
    shared = spark.createDataFrame(
        [(t, node, 40, at, 1) for node in range(6) for at, t in enumerate(range(node, node + 12))],
        "token long, node long, n int, at int, least int")
    comps = spark.createDataFrame([(0, 0), (1, 0)], "node long, comp long")
    rows = jaccard.open_rows(shared, comps, 75)
    side = lambda s: [F.col("token"), *[
        F.col(x).alias(f"{x}{s}") for x in rows.columns if x != "token"]]
    met = rows.select(*side("1")).join(rows.select(*side("2")), "token").where(
        "node1 < node2 AND comp1 <> comp2 AND n1 >= least2 AND NOT arrays_overlap(before1, before2)")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with redirect_stdout(io.StringIO()) as plan:
            met.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Both sides of the join and the extremes read one exchange of the rows with their memories.
    dealt = [line for line in plan.getvalue().split("\n") if "Exchange hashpartitioning(token" in line and "Reused" not in line]
    assert 0 < len(dealt) <= 2, plan.getvalue()
    assert {r["before"] is None for r in rows.collect()} == {False}


def test_each_text_is_named_once(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"one two three {k % 3}") for k in range(9)], "doc_id long, text string")

    def found(rows, key="doc_id", text="text"):
        names = spark.createDataFrame(
            [(k, jaccard.node_of(jaccard.shingle_set(f"one two three {k % 3}"))) for k in range(9)],
            "doc_id long, node long")
        return names.withColumn("component", F.col("node"))

    monkeypatch.setattr(jaccard, "near_duplicates", found)
    kept = jaccard.one_of_each(docs)
    with redirect_stdout(io.StringIO()) as plan:
        kept.explain()
    assert plan.getvalue().count("ArrowEvalPython") == 1, plan.getvalue()
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2]
