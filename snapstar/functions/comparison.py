"""Text comparison that ignores case and trailing blanks.

Spark compares text byte by byte unless told otherwise. Data that was curated in a database with a
case-insensitive collation can be compared the same way: a column of a collated type carries its rule
through every comparison, grouping and join made with it. A warehouse chooses once
(``plans.load.match_names``); plans then take the names of listings through ``relaxed_names``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

#: Lower case compared, trailing blanks aside.
CASE_BLIND, EXACT = "UTF8_LCASE_RTRIM", "UTF8_BINARY"
#: Columns that are matched with members or rules.
NAMES = ("property_type", "room_type", "neighbourhood_cleansed", "neighbourhood")


def relaxed(text: Column) -> Column:
    """``text`` for ``==``, ``startswith``, ``contains``, ``isin``, joins and grouping without case."""
    return F.collate(text, CASE_BLIND)


def exact(text: Column) -> Column:
    """``text`` compared byte by byte again, as stored tables carry it."""
    return F.collate(text, EXACT)


def relaxed_names(rows: DataFrame, names: tuple[str, ...] = NAMES) -> DataFrame:
    """``rows`` whose names compare without case and trailing blanks from here on."""
    return rows.withColumns({c: relaxed(F.col(c)) for c in names if c in rows.columns})


def like(text: Column, rows: DataFrame, column: str) -> Column:
    """``text`` under the rule that ``column`` of ``rows`` compares by."""
    kind = rows.schema[column].dataType
    return F.collate(text, kind.collation) if isinstance(kind, StringType) else text


def one_spelling(rows: DataFrame, name: str) -> DataFrame:
    """The distinct values of a column, each in the first (by bytes) of its spellings."""
    plain = exact(F.col(name))
    return rows.groupBy(F.col(name).alias("_matched")).agg(F.min(plain).alias(name)).select(name)
