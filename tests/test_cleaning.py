"""Cleaning rules on literal values, one case per documented trap."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from snapstar.functions import cleaning as clean
from snapstar.functions.comparison import relaxed


def apply(spark, rule, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", rule(F.col("v")).alias("out")).orderBy("i").collect()]


def test_money(spark):
    texts = ["$50.00", "$1,250.00", "", None, "abc", "1e3", "-5", "$12345678901.00"]
    assert apply(spark, clean.money, texts) == [
        Decimal("50.00"), Decimal("1250.00"), None, None, None, None, Decimal("-5.00"), None]
    assert apply(spark, clean.money, ["$50.00 ", " $50.", "50.", ".5", ".", "- 5", " "]) == [
        Decimal("50.00"), Decimal("50.00"), Decimal("50.00"), Decimal("0.50"), None, None, None]


def test_rates(spark):
    assert apply(spark, clean.rate, ["95%", "N/A", None]) == [Decimal(95), Decimal(-1), Decimal(-1)]
    assert apply(spark, clean.published_rate, ["95%", "N/A", None]) == [Decimal(95), None, None]


@pytest.mark.parametrize("bad", ["", "many", "1e2"])
def test_bad_rate_stops_the_job(spark, bad):
    with pytest.raises(Exception, match="not a rate"):
        apply(spark, clean.rate, [bad])


def test_bad_rate_stops_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match="not a rate"):
            apply(spark, clean.rate, ["many"])
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_unknown_inside_text_and_whole(spark):
    texts = ["see N/A here", "N/A", None, "fine", "N/A "]
    assert apply(spark, clean.or_unknown, texts) == [
        "see Unknown here", "Unknown", "Unknown", "fine", "Unknown "]
    assert apply(spark, clean.or_unknown_whole, texts) == [
        "see N/A here", "Unknown", "Unknown", "fine", "Unknown"]


def test_verifications(spark):
    assert apply(spark, clean.verifications, ["None", "N/A", None, "['email']"]) == [
        "Unknown", "Unknown", "Unknown", "['email']"]


def test_flags(spark):
    assert apply(spark, clean.flag, ["t", "f", None, "x"]) == [1, 0, 0, 0]


def test_license(spark):
    texts = [None, "", "  ", "Exempt", "00001"]
    assert apply(spark, clean.license_status, texts) == [
        "Unknown", "Unknown", "Unknown", "Exempt", "Licensed"]
    assert apply(spark, clean.has_license, texts) == [0, 0, 0, 0, 1]


CATEGORY = {
    "Entire rental unit": "Entire Property", "Cycladic home": "Entire Property",
    "Private room in serviced apartment": "Private Room", "Casa particular": "Private Room",
    "Shared room in hostel": "Shared Room", "Room in aparthotel": "Hotel / Serviced",
    "Room in boutique hotel": "Hotel / Serviced", "Room in serviced apartment": "Hotel / Serviced",
    "Cave": "Unique / Other", "Spaceship": "Unique / Other", None: "Unique / Other",
}


def test_property_category(spark):
    assert apply(spark, clean.property_category, list(CATEGORY)) == list(CATEGORY.values())


def test_property_category_without_case(spark):
    plain = lambda c: clean.property_category(c)
    blind = lambda c: clean.property_category(relaxed(c))
    texts = ["ENTIRE HOME", "casa PARTICULAR ", "ROOM IN HOTEL"]
    assert apply(spark, plain, texts) == ["Unique / Other"] * 3
    assert apply(spark, blind, texts) == ["Entire Property", "Private Room", "Hotel / Serviced"]


def test_relaxed_groups_greek_names(spark):
    rows = spark.createDataFrame([("ΠΛΑΚΑ",), ("πλακα",), ("πλακα  ",), ("άλλο",)], "v string")
    assert rows.select(relaxed(F.col("v")).alias("v")).distinct().count() == 2


def test_quote_dates(spark):
    days = apply(spark, clean.quote_date, ["2026-07-01", "05/07/2026", "soon", None])
    assert [str(d) for d in days] == ["2026-07-01", "2026-07-05", "None", "None"]


def test_lengths_and_numbers(spark):
    assert apply(spark, clean.trimmed_length, ["ab  ", "", None]) == [2, 0, None]
    assert apply(spark, clean.whole_number, ["12", "12.0", "x", "1e2", None]) == [
        12, 12, None, None, None]


def test_percentage_rounds_half_up(spark):
    rows = spark.createDataFrame([(1, 800), (1, 3), (0, 5), (5, 5)], "a bigint, b bigint")
    shares = rows.select(clean.percentage(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.p for r in shares] == [Decimal("0.1"), Decimal("33.3"), Decimal(0), Decimal(100)]
