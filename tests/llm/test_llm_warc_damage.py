"""No record is lost: long headers are read whole, damaged starts are errors."""

import random
import string

import pytest

from snapstar.llm import warc


def archive(rng, sizes):
    url = lambda n: "".join(rng.choices(string.ascii_letters, k=n))
    members = [
        warc.member("response", k, url(n), b"body %d" % k, warc.base32(b"x" * 20), 6)
        for k, n in enumerate(sizes)]
    return b"".join(members), [sum(map(len, members[:k])) for k in range(len(members))]


def read(tmp_path, raw, split):
    (tmp_path / "a.warc.gz").write_bytes(raw)
    starts = []
    with open(tmp_path / "a.warc.gz", "rb") as source:
        for start in range(0, len(raw), split):
            starts += [at for at, _, _ in warc.records(source, len(raw), start, start + split)]
    return starts


@pytest.mark.parametrize("split", [1 << 30, 1 << 20, 100_000])
def test_long_urls_are_read(tmp_path, split):
    raw, starts = archive(random.Random(1), [20, 2_000_000, 20, 5_000_000, 20])
    assert read(tmp_path, raw, split) == starts


@pytest.mark.parametrize("split", [1 << 30, 500])
@pytest.mark.parametrize("record, byte", [(0, 0), (3, 0), (3, 1), (9, 2), (9, 3)])
def test_a_damaged_start_is_an_error(tmp_path, split, record, byte):
    raw, starts = archive(random.Random(2), [30] * 10)
    assert read(tmp_path, raw, split) == starts
    broken = bytearray(raw)
    broken[starts[record] + byte] ^= 0xE0
    with pytest.raises(ValueError, match="no record begins|not begin with a record"):
        read(tmp_path, bytes(broken), split)


def test_pages_with_long_urls_through_spark(spark, tmp_path):
    rng = random.Random(3)
    url = "".join(rng.choices(string.ascii_letters, k=3_000_000))
    rows = [(1, url, "one"), (2, "u", "two"), (3, None, "one")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = str(tmp_path / "archives")
    assert warc.write_archives(pages, folder) == 3
    read_ = warc.read_archives(spark, folder, 1 << 19).collect()
    assert sorted((r.page_id, r.url, r.record_type) for r in read_ if r.url) == [
        (1, url, "response"), (2, "u", "response")]
    assert [(r.page_id, r.refers_to) for r in read_ if r.url is None] == [(3, 1)]
