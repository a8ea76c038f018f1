"""Calendar attributes of a day, in English and independent of session settings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(day: Column) -> Column:
    """20250624 for 2025-06-24."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attribute name -> expression. ``week`` is the ISO week, beside the calendar year."""
    weekday = F.dayofweek(day)  # 1 = Sunday ... 7 = Saturday
    return {
        "date_id": date_key(day),
        "date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "quarter_name": F.format_string("Q%d %d", F.quarter(day), F.year(day)),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "month_short": F.date_format(day, "MMM"),
        "week": F.weekofyear(day),
        "day": F.dayofmonth(day),
        "day_name": F.date_format(day, "EEEE"),
        "day_short": F.date_format(day, "EEE"),
        "is_weekend": weekday.isin(1, 7).cast("int"),
    }
