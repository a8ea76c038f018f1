"""Folders and small texts in whatever file system the session reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Listed:
    name: str
    is_folder: bool
    #: Milliseconds since 1970.
    modified: int


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def listed(spark: SparkSession, path: str) -> list[Listed]:
    """What lies directly in a folder, by name; nothing if there is no such folder."""
    system, place = _at(spark, path)
    if not system.exists(place):
        return []
    found = [
        Listed(status.getPath().getName(), status.isDirectory(), status.getModificationTime())
        for status in system.listStatus(place)
    ]
    return sorted(found, key=lambda one: one.name)


def delete(spark: SparkSession, path: str) -> None:
    system, place = _at(spark, path)
    system.delete(place, True)


def read_small(spark: SparkSession, path: str) -> str:
    system, place = _at(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> bool:
    """Put a whole new file in place by one rename; False if there is one of that name already."""
    system, place = _at(spark, path)
    if system.exists(place):
        return False
    hidden = spark._jvm.org.apache.hadoop.fs.Path(
        place.getParent(), f".{place.getName()}-{spark._jvm.java.util.UUID.randomUUID()}")
    stream = system.create(hidden, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return bool(system.rename(hidden, place))
