"""Slowly changing dimension of type 2: collapse, first load, change detection, incremental merge.

Rows are first combined to one per (key, tracked values) on the map side, so a key with many events
shrinks before it moves. Neighbouring versions are found in a global order instead of a window per
key, so that even a key with very many versions is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.history import end_of_time, row_hash
from orderloom.operators.dedup import first_per_key
from orderloom.operators.keys import add_surrogate_key, max_key, with_row_index
from orderloom.session import stored


class HistorySpec(NamedTuple):
    """What identifies a row, what is tracked, what is merely carried along."""

    key: str = "customer_natural_key"
    tracked: tuple[str, ...] = ("email_address",)
    carried: tuple[str, ...] = ("user_id_db", "device_id")
    at: str = "event_timestamp"
    surrogate: str = "customer_key"
    hash_sep: str = ""

    @property
    def columns(self) -> list[str]:
        return [
            self.surrogate, self.key, *self.carried, *self.tracked,
            "valid_from", "valid_to", "is_current", "row_hash",
        ]


CUSTOMER = HistorySpec()


def collapse_versions(rows: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """One row per (key, tracked values): first and last sighting, carried values, hash."""
    return (
        rows.groupBy(spec.key, *spec.tracked)
        .agg(
            *[F.max(c).alias(c) for c in spec.carried],
            F.min(spec.at).alias("first_seen"),
            F.max(spec.at).alias("last_seen"),
        )
        .withColumn("row_hash", row_hash(spec.tracked, spec.hash_sep))
    )


def _version_order(spec: HistorySpec) -> list[str]:
    return [spec.key, "first_seen", *spec.tracked]


def number_versions(versions: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """Add version_number 1, 2, … within each key, by first sighting."""
    indexed = with_row_index(versions, _version_order(spec))
    starts = indexed.groupBy(spec.key).agg(F.min("_index").alias("_start"))
    return indexed.join(starts, spec.key).select(
        *versions.columns, (F.col("_index") - F.col("_start") + 1).alias("version_number")
    )


def initial_history(versions: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """All versions with validity range, current flag and surrogate key."""
    indexed = with_row_index(versions, _version_order(spec), following=[spec.key, "first_seen"])
    next_start = F.when(F.col("_next")[spec.key] == F.col(spec.key), F.col("_next")["first_seen"])
    return indexed.select(
        F.col("_index").cast("bigint").alias(spec.surrogate),
        spec.key,
        *spec.carried,
        *spec.tracked,
        F.col("first_seen").alias("valid_from"),
        F.coalesce(next_start, end_of_time()).alias("valid_to"),
        next_start.isNull().alias("is_current"),
        "row_hash",
    )


def latest_versions(versions: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """The version of each key that started last."""
    order = [F.col("first_seen").desc(), *[F.col(c).desc() for c in spec.tracked]]
    return first_per_key(versions, [spec.key], order)


def current_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("is_current"))


def detect_changes(history: DataFrame, versions: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """Staged versions whose hash differs from the current row of the same key."""
    now = current_rows(history).select(
        spec.key, F.col(spec.surrogate).alias("old_key"), F.col("row_hash").alias("_current_hash")
    )
    return versions.join(now, spec.key).where(F.col("row_hash") != F.col("_current_hash")).drop("_current_hash")


def expire_versions(history: DataFrame, changes: DataFrame, now: Column, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """Current rows of changed keys, closed at `now`."""
    return (
        current_rows(history)
        .join(changes.select(spec.key), spec.key, "left_semi")
        .withColumns({"valid_to": now, "is_current": F.lit(False)})
        .select(*spec.columns)
    )


def _opened(rows: DataFrame, now: Column, after: Column, spec: HistorySpec, first_by: Sequence[str] = ()) -> DataFrame:
    body = rows.select(
        *first_by,
        spec.key,
        *spec.carried,
        *spec.tracked,
        now.alias("valid_from"),
        end_of_time().alias("valid_to"),
        F.lit(True).alias("is_current"),
        "row_hash",
    )
    return add_surrogate_key(body, spec.surrogate, [*first_by, spec.key, *spec.tracked], after).drop(*first_by)


def new_versions(history: DataFrame, changes: DataFrame, now: Column, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """Changed keys as new current rows, numbered behind the largest key."""
    return _opened(changes, now, max_key(history, spec.surrogate), spec)


def unseen_keys(history: DataFrame, versions: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """Staged versions of keys without a current row."""
    return versions.join(current_rows(history).select(spec.key), spec.key, "left_anti")


def history_delta(
    history: DataFrame,
    versions: DataFrame,
    now: Column,
    spec: HistorySpec = CUSTOMER,
    every_version: bool = False,
) -> DataFrame:
    """Rows to merge: closed rows, new versions, new keys.

    By default only the latest staged version of a key is compared, so that exactly one row per key
    stays current. `every_version` compares all of them, as the original warehouse job does: an old
    value that differs from the current one opens again, and a new key gets all its versions as current.
    """
    staged = versions if every_version else latest_versions(versions, spec)
    known = current_rows(history).select(spec.key, F.col(spec.surrogate).alias("old_key"), F.col("row_hash").alias("_current_hash"))
    fresh = F.col("old_key").isNull()
    # What is new, stored once: the staged versions are computed for this one join only.
    found = stored(
        staged.join(known, spec.key, "left")
        .where(fresh | (F.col("row_hash") != F.col("_current_hash")))
        .select(*staged.columns, fresh.alias("_fresh"))
    )
    changes = found.where(~F.col("_fresh"))
    # new versions of known keys are numbered first, then the new keys
    opened = _opened(found, now, max_key(history, spec.surrogate), spec, ["_fresh"])
    return expire_versions(history, changes, now, spec).unionByName(opened)


def merge_history(history: DataFrame, delta: DataFrame, spec: HistorySpec = CUSTOMER) -> DataFrame:
    """Upsert by surrogate key. Columns that only one side has are kept and filled with NULL.

    Write the result to a new path and switch readers; never overwrite the table being read.
    """
    untouched = history.join(delta.select(spec.surrogate), spec.surrogate, "left_anti")
    return untouched.unionByName(delta, allowMissingColumns=True)
