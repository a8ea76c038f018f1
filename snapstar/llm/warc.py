"""WARC archives: a writer with revisit records and a splittable reader.

Writing: every record is a gzip member of its own. Members are compressed where a page is read, so
the shuffle that looks for equal payloads carries compressed bytes; it is a join on the payload's
digest, of which a hot value is split by the adaptive skew join. Each task writes one file under a
hidden name and moves it to its final one, so a repeated or speculative task changes nothing.

Reading: files are cut into byte ranges of any size. A task looks in its range for the gzip magic,
takes a candidate for a record only if the inflated bytes begin with a whole WARC header, and owns
the records that start inside its range; it reads past the end for the last one. After a record
the next begins at once, so only the first of a range is searched for, and what follows a record, in
this range or the next, must be a record or the end of the file; anything else is an error. (A payload
that is itself a gzipped archive could be taken for a record if deflate stores it raw; UTF-8 text
cannot.) A header may be of any length.

Files are opened through pyarrow's file systems by their URI, in any shared folder those know.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from snapstar.llm.text import table
from snapstar.session import new_folder

SPLIT_BYTES = 8 << 20
LEAST_BYTES = 0
DATE = "1970-01-01T00:00:00Z"
MAGIC = b"\x1f\x8b\x08"
PIECE = 16 << 10
#: Tasks that read, at most; with more ranges than that, a task reads several.
MOST_TASKS = 20_000
ROWS = ("path string, start long, page_id long, url string, record_type string, "
        "refers_to long, payload_bytes long, payload_digest string, payload binary")


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a Hadoop-style URI."""
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", uri)))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def member(
    kind: str, page: int | None, url: str | None, body: bytes, digest: str, size: int,
    refers_to: int | None = None,
) -> bytes:
    """One gzipped record. A revisit keeps the HTTP header, whose length is the full payload's."""
    named = lambda key: f"<urn:page:{'none' if key is None else key}>"
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}"
        "\r\n\r\n"
    ).encode() + body
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {named(page)}",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(
            r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url))
    if kind == "revisit":
        head += [f"WARC-Refers-To: {named(refers_to)}", "WARC-Profile: "
                 "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    whole = "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"
    return squeeze.compress(whole) + squeeze.flush()


def _responses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for page, url, body in zip(batch["_page"], batch["_url"], batch["_body"]):
            page, digest = None if pd.isna(page) else int(page), hashlib.sha1(body).digest()
            rows.append((page, url, digest, len(body),
                         member("response", page, url, body, base32(digest), len(body))))
        yield pd.DataFrame(
            rows, columns=["_page", "_url", "_digest", "_size", "_member"]
        ).astype({"_page": "Int64"})


def _writer(folder: str):
    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = TaskContext.get()
        system, root = opened(folder)
        name = f"part-{task.partitionId():06d}.warc.gz"
        hidden = f"{root}/.{name}-{task.taskAttemptId()}"
        count = 0
        out = None
        for batch in batches:
            out = out or system.open_output_stream(hidden, compression=None)
            for row in batch.itertuples(index=False):
                page, url, digest, size, made, shared, first = row
                page, first = (None if pd.isna(x) else int(x) for x in (page, first))
                revisit = bool(shared) and page != first
                out.write(member("revisit", page, url, b"", base32(digest), size, first)
                          if revisit else made)
                count += 1
        if out is not None:
            out.close()
            system.move(hidden, f"{root}/{name}")
        yield pd.DataFrame({"path": [f"{folder}/{name}"], "records": [count]})
    return write


def write_archives(
    pages: DataFrame, folder: str, page: str = "page_id", url: str = "url", html: str = "html",
    least_bytes: int = LEAST_BYTES,
) -> int:
    """Write one record per row into ``folder``; returns the number of records.

    Of rows with equal payloads of ``least_bytes`` or more, those with the smallest id are
    responses, the others revisits of it; so repeated rows of the smallest id are all responses,
    and a null id is one only if no other row has that payload with an id. Null html is an empty
    payload, a null url leaves out the target. Other columns are ignored. An empty table writes no
    record.
    """
    spark = pages.sparkSession
    system, root = opened(folder)
    system.create_dir(root, recursive=True)
    named = pages.select(
        F.col(page).cast("long").alias("_page"), F.col(url).alias("_url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("_body"),
    )
    shared = named.where(F.length("_body") >= least_bytes).select(
        F.unhex(F.sha1("_body")).alias("_digest"), "_page"
    ).groupBy("_digest").agg(F.count("*").alias("n"), F.min("_page").alias("_first")).where(
        F.col("n") > 1
    ).select("_digest", F.lit(True).alias("_shared"), "_first")
    made = named.mapInPandas(
        _responses, "_page long, _url string, _digest binary, _size long, _member binary")
    joined = made.join(shared, "_digest", "left").select(
        "_page", "_url", "_digest", "_size", "_member",
        F.coalesce("_shared", F.lit(False)).alias("_shared"), "_first",
    )
    done = joined.mapInPandas(_writer(folder), "path string, records long")
    return done.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0]


class _Range:
    """The bytes of a file from ``start``, loaded as far as they are asked for."""

    def __init__(self, source, size: int, start: int, end: int):
        self.source, self.size, self.start = source, size, start
        source.seek(start)
        self.data = bytearray(source.read(min(end + PIECE, size) - start))

    def piece(self, at: int, count: int = PIECE) -> bytes:
        missing = min(at + count, self.size) - self.start - len(self.data)
        if missing > 0:
            self.data += self.source.read(max(missing, min(
                1 << 20, self.size - self.start - len(self.data))))
        return bytes(self.data[at - self.start:at - self.start + count])


def _header(raw: bytes) -> tuple[dict[str, str], int] | None:
    """Fields of a WARC header and where its block begins; None if it is no whole header."""
    end = raw.find(b"\r\n\r\n")
    if end < 0 or not raw.startswith(b"WARC/1."):
        return None
    fields = dict(
        line.split(":", 1) for line in raw[:end].decode("utf-8", "replace").split("\r\n")[1:]
        if ":" in line
    )
    fields = {name.strip().lower(): value.strip() for name, value in fields.items()}
    return (fields, end + 4) if fields.get("content-length", "").isdigit() else None


def _is_record(part: _Range, at: int) -> bool:
    """Whether the bytes inflate to a whole header; they are read on as long as it is unfinished."""
    inflate, seen, here = zlib.decompressobj(31), bytearray(), at
    try:
        while not inflate.eof:
            raw = part.piece(here)
            if not raw:
                return False
            here += len(raw)
            looked = max(len(seen) - 3, 0)
            seen += inflate.decompress(raw)
            if not seen.startswith(b"WARC/1.") and not b"WARC/1.".startswith(bytes(seen[:7])):
                return False
            if seen.find(b"\r\n\r\n", looked) >= 0:
                return _header(bytes(seen)) is not None
    except zlib.error:
        return False
    return False


def _next_record(part: _Range, at: int, end: int) -> int | None:
    """Start of the first record in [at, end)."""
    while at < end:
        found = part.piece(at).find(MAGIC)
        if found < 0:
            at += PIECE - len(MAGIC) + 1
        elif at + found >= end:
            return None
        elif _is_record(part, at + found):
            return at + found
        else:
            at += found + 1
    return None


def records(source, size: int, start: int, end: int) -> Iterator[tuple[int, dict, bytes]]:
    """(start, header fields, block) of the records that begin in [start, end) of a file."""
    end = min(end, size)
    if start >= end:
        return
    part = _Range(source, size, start, end)
    at = _next_record(part, start, end)
    if start == 0 and at != 0:
        raise ValueError("the file does not begin with a record")
    while at is not None and at < end:
        inflate, whole, here = zlib.decompressobj(31), [], at
        while not inflate.eof:
            raw = part.piece(here)
            if not raw:
                raise ValueError(f"the record at byte {at} is cut off")
            whole.append(inflate.decompress(raw))
            here += len(raw)
        raw = b"".join(whole)
        fields, body = _header(raw)
        yield at, fields, raw[body:body + int(fields["content-length"])]
        at = here - len(inflate.unused_data)
        if at < size and not _is_record(part, at):
            raise ValueError(f"no record begins at byte {at}, where one ends")


def _page(name: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", name or "")
    return int(found[1]) if found else None


def _read_ranges(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = [field.split()[0] for field in ROWS.split(", ")]
    for batch in batches:
        for path, size, start, end in zip(
            batch["path"], batch["length"], batch["start"], batch["end"]
        ):
            rows = []
            system, name = opened(path)
            with system.open_input_file(name) as source:
                for at, fields, block in records(source, size, start, end):
                    head, _, body = block.partition(b"\r\n\r\n")
                    kind = fields["warc-type"]
                    full = int(re.search(rb"(?i)\ncontent-length: *(\d+)", head)[1])
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    if kind == "response" and (
                        len(body) != full or base32(hashlib.sha1(body).digest()) != digest
                    ):
                        raise ValueError(f"{path}: the record at byte {at} is damaged")
                    rows.append((
                        path, at, _page(fields["warc-record-id"]), fields.get("warc-target-uri"),
                        kind, _page(fields.get("warc-refers-to")), full, digest,
                        body if kind == "response" else None,
                    ))
                    if len(rows) == 500:
                        yield _frame(rows, columns)
                        rows = []
            yield _frame(rows, columns)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns).astype(
        {"start": "int64", "page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})


def read_archives(spark: SparkSession, folder: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """The records of all ``*.warc.gz`` files of a folder, read by byte ranges.

    Columns: path and start of the record, page_id, url, record_type, refers_to, payload_bytes and
    payload_digest (of the full payload, also for revisits) and the payload (null for revisits).
    A folder without records gives no rows; a damaged record, or bytes between records, stop the job.
    A record, however long its url or payload, is in the memory of its task whole.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(
        folder
    ).select("path", "length").where("length > 0")
    ranges = listed.select(
        "path", "length",
        F.explode(F.sequence(F.lit(0), F.col("length") - 1, F.lit(split_bytes))).alias("start"),
    ).withColumn("end", F.least("length", F.col("start") + split_bytes))
    total = listed.agg(F.sum(F.ceil(F.col("length") / split_bytes))).first()[0] or 1
    return ranges.repartition(min(int(total), MOST_TASKS)).mapInPandas(_read_ranges, ROWS)


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back by byte ranges."""
    folder, kept = new_folder(spark, "warc"), new_folder(spark, "warc-read")
    written, seen = write_archives(table(spark, sf_dir, "pages"), folder), Observation()
    read_archives(spark, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    ).observe(seen, F.count("*").alias("records")).write.parquet(kept)
    if seen.get["records"] != written:
        raise ValueError(f"{written} records written, {seen.get['records']} read")
    return spark.read.parquet(kept)


_DIGITS = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {5 * k + 1}, 5))::INTEGER"
    f" >> {shift}) & 31), 1)"
    for k in range(8) for shift in (15, 10, 5, 0)
)
OP9_SQL = f"""
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS body, sha1(coalesce(html, '')) AS h FROM pages),
r AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, CAST(octet_length(body) AS BIGINT) AS payload_bytes,
       {_DIGITS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM r
"""
