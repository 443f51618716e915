"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sunday_week(d: Column) -> Column:
    """Week of the year, weeks starting on Sunday, 0 before the first Sunday."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("bigint")


def quarter_end(d: Column) -> Column:
    return F.date_add(F.add_months(F.trunc(d, "quarter"), 3), -1)


def year_end(d: Column) -> Column:
    return F.date_add(F.add_months(F.trunc(d, "year"), 12), -1)


def date_key(d: Column) -> Column:
    """20240131 for 2024-01-31."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")


def calendar_columns(d: Column, as_of: Column | None = None) -> dict[str, Column]:
    """The 34 attributes of the date dimension, in output order. `as_of` drives the 'current' flags."""
    today = F.current_date() if as_of is None else as_of
    year, quarter, month = F.year(d), F.quarter(d), F.month(d)
    weekday, monday = F.dayofweek(d), F.trunc(d, "week")
    month_end = F.last_day(d)

    def num(c: Column) -> Column:
        return c.cast("bigint")

    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": num(year),
        "year_start_date": F.trunc(d, "year"),
        "year_end_date": year_end(d),
        "is_leap_year": (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0)),
        "quarter": num(quarter),
        "quarter_name": F.concat(F.lit("Q"), quarter.cast("string")),
        "quarter_start_date": F.trunc(d, "quarter"),
        "quarter_end_date": quarter_end(d),
        "month": num(month),
        "month_name": F.date_format(d, "MMMM"),
        "month_name_short": F.date_format(d, "MMM"),
        "month_start_date": F.trunc(d, "month"),
        "month_end_date": month_end,
        "days_in_month": num(F.dayofmonth(month_end)),
        "is_last_day_of_month": d == month_end,
        "week": sunday_week(d),
        "iso_week": num(F.weekofyear(d)),
        "iso_year": num(F.extract(F.lit("yearofweek"), d)),
        "week_start_date": monday,
        "week_end_date": F.date_add(monday, 6),
        "week_of_month": num(F.ceil(F.dayofmonth(d) / 7)),
        "day_of_week": num(weekday),
        "day_name": F.date_format(d, "EEEE"),
        "day_name_short": F.date_format(d, "EEE"),
        "day_of_month": num(F.dayofmonth(d)),
        "day_of_year": num(F.dayofyear(d)),
        "is_weekend": weekday.isin(1, 7),
        "is_weekday": ~weekday.isin(1, 7),
        "is_current_day": d == today,
        "is_current_month": F.trunc(d, "month") == F.trunc(today, "month"),
        "is_current_quarter": F.trunc(d, "quarter") == F.trunc(today, "quarter"),
        "is_current_year": F.trunc(d, "year") == F.trunc(today, "year"),
    }
