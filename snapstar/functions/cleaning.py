"""Cleaning rules, each a Column in and a Column out.

Text matching is case-sensitive, as Spark's default collation is. Columns of a collated type
(``functions.comparison.relaxed``) are matched without regard to case or trailing blanks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from snapstar import contracts as C

_DECIMAL_TEXT = r"^-?([0-9]+\.?[0-9]*|\.[0-9]+)$"


def or_unknown(text: Column) -> Column:
    """Every ``N/A`` inside the text becomes ``Unknown``; so does a missing text."""
    return F.coalesce(F.replace(text, F.lit("N/A"), F.lit(C.UNKNOWN)), F.lit(C.UNKNOWN))


def or_unknown_whole(text: Column) -> Column:
    """Only a text that *is* ``N/A`` (or is missing) becomes ``Unknown``."""
    return F.coalesce(F.when(F.rtrim(text) != "N/A", text), F.lit(C.UNKNOWN))


def verifications(text: Column) -> Column:
    """As ``or_unknown``, and ``None`` inside the text counts as unknown too."""
    return or_unknown(F.replace(text, F.lit("None"), F.lit(C.UNKNOWN)))


def money(text: Column) -> Column:
    """``$1,250.00`` -> 1250.00; anything that is no plain number -> null.

    Blanks around the number and a point without digits behind it are accepted (``$50. ``). The
    pattern keeps out exponent forms such as ``1e3``, which a bare cast would accept.
    """
    digits = F.trim(F.translate(text, "$,", ""))
    return F.when(digits.rlike(_DECIMAL_TEXT), digits.try_cast("decimal(10,2)"))


def rate(text: Column) -> Column:
    """``95%`` -> 95.00; missing or ``N/A`` -> -1; any other text stops the job."""
    digits = F.replace(F.translate(text, "%", ""), F.lit("N/A"), F.lit(str(C.NO_RATE)))
    return (
        F.when(text.isNull(), F.lit(C.NO_RATE).cast("decimal(5,2)"))
        .when(digits.rlike(_DECIMAL_TEXT), digits.cast("decimal(5,2)"))
        .otherwise(F.raise_error(F.concat(F.lit("not a rate: "), text)).cast("decimal(5,2)"))
    )


def published_rate(text: Column) -> Column:
    """The rate, null where none was published (for averages and differences)."""
    return F.nullif(rate(text), F.lit(C.NO_RATE).cast("decimal(5,2)"))


def flag(text: Column) -> Column:
    """``t`` -> 1, everything else including null -> 0."""
    return F.coalesce((text == "t").cast("int"), F.lit(0))


def count_or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0))


def license_status(text: Column) -> Column:
    """Licensed, Exempt or Unknown; a blank text is no licence."""
    given = F.nullif(F.rtrim(text), F.lit(""))
    return (
        F.when(given == "Exempt", "Exempt")
        .when(given.isNotNull(), "Licensed")
        .otherwise(C.UNKNOWN)
    )


def has_license(text: Column) -> Column:
    """1 only where a registration number is held; an exemption is none."""
    return (license_status(text) == "Licensed").cast("int")


def _applies(kind: Column, rule: dict) -> Column:
    tests = [kind.startswith(p) for p in rule.get("prefixes", ())]
    tests += [kind.contains(f) for f in rule.get("fragments", ())]
    if "values" in rule:
        tests.append(kind.isin(*rule["values"]))
    return reduce(Column.__or__, tests)


def property_category(kind: Column) -> Column:
    """One of five groups; the first rule that applies wins, unseen types fall to the last."""
    label = F.lit(C.OTHER_CATEGORY)
    for rule in reversed(C.PROPERTY_CATEGORY_RULES):
        label = F.when(_applies(kind, rule), rule["label"]).otherwise(label)
    return label


def quote_date(text: Column) -> Column:
    """A quote date written in any of the known formats, else null."""
    return F.coalesce(*[F.try_to_date(text, pattern) for pattern in C.QUOTE_DATE_FORMATS])


def whole_number(text: Column) -> Column:
    """``12`` and ``12.0`` -> 12; anything that is no plain number -> null."""
    return F.when(text.rlike(_DECIMAL_TEXT), text.try_cast("decimal(20,2)")).try_cast("int")


def trimmed_length(text: Column) -> Column:
    """Length without trailing blanks."""
    return F.length(F.rtrim(text))


def percentage(part: Column, whole: Column) -> Column:
    """``100 * part / whole`` with one decimal, halves rounded up."""
    share = (part * F.lit(100)).cast("decimal(20,0)") / whole.cast("decimal(18,0)")
    return F.round(share, 1).cast("decimal(4,1)")


def mean(total: Column, rows: Column) -> Column:
    """Exact decimal total over row count, as a double; null over no rows."""
    return F.when(rows > 0, total.cast("double") / rows)
