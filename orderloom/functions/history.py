"""Expressions for slowly changing dimensions of type 2."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def end_of_time() -> Column:
    return F.to_timestamp(F.lit("9999-12-31 00:00:00"))


def beginning_of_time() -> Column:
    return F.to_timestamp(F.lit("1900-01-01 00:00:00"))


def row_hash(columns: Sequence[str | Column], sep: str = "") -> Column:
    """MD5 (hex) of the tracked columns. NULL counts as ''. A `sep` keeps ('a','b') and ('ab','') apart."""
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("")) for c in columns
    ]
    return F.md5(F.concat_ws(sep, *texts))


def next_start(start: str, key: str, tie_break: Sequence[str] = ()) -> Column:
    """Start of the next version of the same key. Ties are ordered by `tie_break`."""
    return F.lead(start).over(Window.partitionBy(key).orderBy(start, *tie_break))


def valid_to(start: str, key: str, tie_break: Sequence[str] = (), fallback: Column | None = None) -> Column:
    """End of a version: start of the next one, or the far future (or `fallback`) for the last."""
    return F.coalesce(next_start(start, key, tie_break), end_of_time() if fallback is None else fallback)


def is_current(start: str, key: str, tie_break: Sequence[str] = ()) -> Column:
    return next_start(start, key, tie_break).isNull()
