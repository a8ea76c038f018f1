"""Strict casts: what they take and refuse, and that a value is computed once."""

import pytest

from snapstar.sources import fit

TEXTS = ["5", " 5 ", "+5", "-5", "\t5", "5.0", "5.", "1e3", "007", "-0", None]


@pytest.mark.parametrize("kind", ["smallint", "int", "bigint"])
def test_whole_numbers_in_every_spelling(spark, kind):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    got = [r[0] for r in rows.selectExpr(fit.strict("x", kind)).collect()]
    assert got == [5, 5, 5, -5, 5, 5, 5, 1000, 7, 0, None]


@pytest.mark.parametrize("kind, text", [
    ("int", "5.5"), ("int", "x"), ("int", ""), ("int", "\x7f5"), ("smallint", "70000"),
    ("bigint", "9223372036854775808"), ("double", "x"), ("date", "2024-13-01"),
    ("decimal(4,2)", "100.00")])
def test_misfits_stop_the_job(spark, kind, text):
    rows = spark.createDataFrame([(text,)], "x string")
    with pytest.raises(Exception, match="x cannot hold"):
        rows.selectExpr(fit.strict("x", kind)).collect()


def test_a_value_is_computed_once():
    for kind, cast, times in (
        ("int", "decimal(38,6)", 2), ("double", "as double)", 1), ("date", "try_to_date(", 2),
    ):
        assert fit.strict("x", kind).count(cast) == times  # a date has two formats
