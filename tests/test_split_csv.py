"""Files with quoted line breaks, cut anywhere, give the rows of Spark's one-task reader."""

import csv
import random

import pytest

from snapstar.plans import load
from snapstar.sources import csv_snapshots, split_csv
from test_load import DAYS, make_feed

COLUMNS = ["a", "b", "c"]


def write(path, rows, end="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        made = csv.writer(out, lineterminator=end)
        made.writerow(COLUMNS)
        made.writerows(rows)
    return str(path)


def odd_rows(rng, n):
    texts = ["", "x", "line\nbreak", 'say "so"', '"', "\n", "a,b", "é 😀", "two\n\nbreaks", "w" * 200,
             '"\n"', " lead", "trail ", "cr\r\nlf"]
    return [[str(k), rng.choice(texts), rng.choice(texts) * rng.randrange(1, 4)] for k in range(n)]


@pytest.mark.parametrize("block, broadcast", [(300, True), (5000, False), (1 << 20, True)])
def test_any_cut_gives_the_same_rows(spark, tmp_path, monkeypatch, block, broadcast):
    if not broadcast:
        monkeypatch.setattr(split_csv, "BROADCAST_BLOCKS", 0)
    rng = random.Random(block)
    paths = [write(tmp_path / "one.csv", odd_rows(rng, 300)),
             write(tmp_path / "two.csv", odd_rows(rng, 40)), write(tmp_path / "none.csv", [])]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes",
                                             "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = split_csv.read_split(spark, paths, COLUMNS)
        rows = sorted(str(tuple(r)[:3]) for r in got.collect())
        tasks = split_csv._lines(spark, paths).rdd.getNumPartitions()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    plain = csv_snapshots.read_text(spark, paths, COLUMNS)
    assert rows == sorted(str(tuple(r)) for r in plain.collect()) and len(rows) == 340
    assert tasks > 20 or block > 1000


def test_a_record_longer_than_many_blocks(spark, tmp_path):
    long = "\n".join(["a line"] * 3000)
    path = write(tmp_path / "long.csv", [["1", long, "x"], ["2", "", "y"]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
        rows = split_csv.read_split(spark, [path], COLUMNS).select(*COLUMNS).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(map(tuple, rows)) == [("1", long, "x"), ("2", None, "y")]


def test_files_of_windows_line_ends(spark, tmp_path):
    path = write(tmp_path / "w.csv", [["1", "a\nb", ""], ["2", "", "z"]], "\r\n")
    rows = split_csv.read_split(spark, [path], COLUMNS).select(*COLUMNS).collect()
    assert sorted(map(tuple, rows)) == [("1", "a\nb", None), ("2", None, "z")]


@pytest.mark.parametrize("text, message", [
    ('a,b,c\n1,"open,2\n', "quotes do not close"), ("a,b,d\n1,2,3\n", "header is not as expected")])
def test_broken_files_are_refused(spark, tmp_path, text, message):
    (tmp_path / "bad.csv").write_text(text)
    with pytest.raises(Exception, match=message):
        split_csv.read_split(spark, [str(tmp_path / "bad.csv")], COLUMNS).collect()


def test_a_staged_feed_is_the_same_either_way(spark, tmp_path):
    feed = make_feed(tmp_path)
    for kind in ("listings", "reviews"):
        one = csv_snapshots.read_snapshots(spark, feed, kind, DAYS[1:])
        many = csv_snapshots.read_snapshots(spark, feed, kind, DAYS[1:], split=True)
        assert sorted(one.columns) == sorted(many.columns)
        columns = sorted(one.columns)
        assert sorted(map(str, one.select(columns).collect())) == sorted(
            map(str, many.select(columns).collect()))
    rows, _ = load.stage(spark, feed, str(tmp_path / "w"), "listings", DAYS[:1], split=True)
    assert {r.description for r in rows.collect()} == {'Near the "old" town,\nquiet'}
