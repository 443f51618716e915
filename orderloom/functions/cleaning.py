"""Null handling, safe casts, sentinels and locale-formatted prices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentinels of the source catalogue.
PRODUCT_TYPE_SENTINELS = ("-1", "--_select_--")
GENDER_SENTINELS = ("false", "FALSE")
UNKNOWN = "Unknown"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """'' becomes NULL; everything else is kept."""
    return F.nullif(_col(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """TRUE for NULL and for ''."""
    return _col(c).isNull() | (_col(c) == "")


def blanks_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({name: blank_to_null(name) for name in columns})


def safe_decimal(c: Column | str, precision: int = 38, scale: int = 9) -> Column:
    """Decimal, or NULL when the text is not a number."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def safe_double(c: Column | str) -> Column:
    """Double, or NULL when the text is not a number. Words such as NaN and Infinity and suffixes are no numbers."""
    text = _col(c).cast("string")
    return F.when(text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"), text).try_cast("double")


def sentinel_to_unknown(c: Column | str, sentinels: Sequence[str] = ()) -> Column:
    """Blank values and the listed sentinels become 'Unknown'."""
    value = _col(c)
    junk = is_blank(value)
    if sentinels:
        junk = junk | value.isin(*sentinels)
    return F.when(junk, F.lit(UNKNOWN)).otherwise(value)


def zero_code_to_null(c: Column | str) -> Column:
    """Category ids '0' and '' mean 'no category'."""
    return F.when(_col(c) != "0", blank_to_null(c))


def positive_or_null(c: Column | str) -> Column:
    """Prices at or below zero are not prices."""
    return F.when(_col(c) > 0, _col(c))


def geo_completeness(country: Column | str, region: Column | str, city: Column | str) -> Column:
    """3 = city known, 2 = region known, 1 = country known, 0 = nothing."""
    return (
        F.when(_col(city).isNotNull(), F.lit(3))
        .when(_col(region).isNotNull(), F.lit(2))
        .when(_col(country).isNotNull(), F.lit(1))
        .otherwise(F.lit(0))
    )


def dash_to_null(c: Column | str) -> Column:
    """Geolocation sources write '-' for an unknown value."""
    return F.nullif(_col(c), F.lit("-"))


def parse_locale_price(c: Column | str, precision: int = 38, scale: int = 9) -> Column:
    """Read '1.234,50', '1,234.50', '12,5' and '12.5'. Text that is no number gives NULL.

    The shape of the separators decides: a dot before a comma means a decimal comma,
    a comma before a dot means a decimal dot, and a lone comma is a decimal comma.
    """
    text = _col(c)
    normal = (
        F.when(text.like("%.%,%"), F.translate(text, ",.", "."))
        .when(text.like("%,%.%"), F.translate(text, ",", ""))
        .otherwise(F.translate(text, ",", "."))
    )
    return normal.try_cast(f"decimal({precision},{scale})")


def natural_key(user_id: Column | str, device_id: Column | str) -> Column:
    """A customer is the account id, or the device when nobody is logged in."""
    return F.coalesce(_col(user_id), _col(device_id))


def email_domain(email: Column | str) -> Column:
    """Text behind the first '@'; NULL when there is none."""
    return blank_to_null(F.regexp_extract(_col(email), "@(.+)$", 1))


def purchase_segment(orders: Column | str) -> Column:
    """One order is 'One-time', two to five 'Repeat', the rest 'Loyal'."""
    n = _col(orders)
    return F.when(n == 1, "One-time").when(n.between(2, 5), "Repeat").otherwise("Loyal")


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole for two counts, rounded half up in integer arithmetic; NULL when whole is 0."""
    scale = 100 * 10**digits
    part, whole = part.cast("decimal(20,0)"), whole.cast("decimal(20,0)")
    rounded = F.floor(F.try_divide(part * (2 * scale) + whole, whole * 2))
    return (rounded.cast("double") / F.lit(float(10**digits))).cast("double")


def average(total: Column, count: Column, digits: int = 2) -> Column:
    """Mean of whole numbers from their sum and count, rounded half up in integer arithmetic."""
    return percent(total, count * 100, digits)
