"""The models of the warehouse, built in the order of their inputs and published as one version.

A model is a function of its inputs (sources or other models) and one of four kinds:

- view: not stored; each model that reads it computes it.
- table: written once per build, to a new folder.
- incremental: a daily mart in parts of a month. A later build computes the months from the newest stored day on (less
  `lookback_days` for late rows) and keeps the folders of all others.
- history: a dimension with versions. Open versions lie in key buckets, closed ones in a folder per build. A later build
  replaces the buckets with a change only; closed folders are never written again.

Nothing of a build is visible before all of it is written. See `sources.published`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, replace
from functools import partial
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.history import CUSTOMER, HistorySpec, collapse_versions, history_delta
from orderloom.plans import core, intermediate, marts, quality, staging
from orderloom.session import packed
from orderloom.sources import published

HISTORY_BUCKETS = 64
NO_MONTH = "0000-00"  # rows without a day


@dataclass(frozen=True)
class Model:
    """`build` takes the frames of `inputs` in this order; that of an incremental model also a day, or None for all."""

    build: Callable[..., DataFrame]
    inputs: tuple[str, ...]
    kind: str = "table"
    cluster: tuple[str, ...] = ()
    #: The day of an incremental model's rows.
    day: str = "order_date"
    spec: HistorySpec = CUSTOMER
    #: Whether a table's rows come in tasks of bounded size: they are written from there, not moved once more.
    dealt: bool = False


MODELS: dict[str, Model] = {
    "stg_events": Model(staging.stg_events, ("raw_events",), "view"),
    "stg_ip_locations": Model(staging.stg_ip_locations, ("raw_ip_locations",), "view"),
    "stg_products": Model(staging.stg_products, ("raw_products",), "view"),
    "int_events_checkout_success": Model(intermediate.checkout_success, ("stg_events",), "view"),
    "int_events_cart_items": Model(partial(intermediate.cart_items, unique_events=True), ("int_events_checkout_success", "stg_ip_locations", "exchange_rates"), "view"),
    "dim_date": Model(core.date_rows, ("days",)),
    "dim_product": Model(core.dim_product, ("stg_products",), cluster=("product_id",)),
    "dim_location": Model(core.dim_location, ("stg_ip_locations",), cluster=("country_name", "region_name")),
    "dim_device": Model(core.dim_device, ("int_events_checkout_success",)),
    "dim_exchange_rate": Model(core.dim_exchange_rate, ("exchange_rates",)),
    "dim_customer": Model(core.customer_rows, ("stg_events",), "history", ("customer_natural_key",)),
    "fact_sales_order_line": Model(
        core.fact_sales_order_line,
        ("int_events_cart_items", "dim_date", "dim_product", "dim_customer", "dim_location", "dim_device", "dim_exchange_rate"),
        cluster=("event_date", "store_id", "product_key", "customer_key"),
        dealt=True,
    ),
    "int_dq_sales_outliers": Model(quality.sales_outliers, ("fact_sales_order_line",)),
    "int_dq_outlier_summary": Model(quality.outlier_summary, ("int_dq_sales_outliers", "fact_sales_order_line"), "view"),
    "int_sales_with_customer": Model(
        intermediate.sales_with_customer,
        ("fact_sales_order_line", "dim_date", "dim_customer", "int_dq_sales_outliers"),
        cluster=("order_date", "store_id", "customer_natural_key"),
        dealt=True,
    ),
    "mart_sales_daily": Model(
        marts.mart_sales_daily, ("int_sales_with_customer", "dim_device", "dim_date"), "incremental", ("store_id", "device_category")
    ),
    "mart_sales_by_geography": Model(
        marts.mart_sales_by_geography, ("int_sales_with_customer", "dim_location", "dim_date"), "incremental", ("country_name",)
    ),
    "mart_sales_by_product": Model(
        marts.mart_sales_by_product, ("int_sales_with_customer", "dim_product", "dim_date"), "incremental", ("category_id", "collection_name")
    ),
    "mart_customer_summary": Model(
        marts.mart_customer_summary, ("int_sales_with_customer", "dim_device", "dim_location"),
        cluster=("email_domain", "is_guest", "purchase_frequency_segment"),
    ),
}


def needed(models: Mapping[str, Model], wanted: Iterable[str] | None, given: Iterable[str]) -> list[str]:
    """The wanted models (all by default) and what they read, inputs first. Names that are given are not built."""
    given = set(given)
    todo, graph = list(models if wanted is None else wanted), {}
    while todo:
        name = todo.pop()
        if name in graph or name in given:
            continue
        if name not in models:
            raise KeyError(f"{name!r} is neither a model nor a given source")
        graph[name] = [i for i in models[name].inputs if i not in given]
        todo += graph[name]
    return list(TopologicalSorter(graph).static_order())


def build_models(
    spark: SparkSession,
    root: str,
    sources: Mapping[str, DataFrame],
    models: Mapping[str, Model] = MODELS,
    wanted: Iterable[str] | None = None,
    kinds: Mapping[str, str] | None = None,
    full_refresh: bool = False,
    lookback_days: int = 0,
    now: Column | None = None,
) -> dict[str, DataFrame]:
    """Build models below `root` and publish them; gives every model's frame.

    `sources` may also hold frames for models that are not to be built here. `kinds` changes how models are kept, for
    instance {"stg_events": "table"} for a view that several models read. `now` is when changed versions of a history
    begin (default: the current time). A model that fails ends the build, and the version before it stays.
    """
    after, version = published.latest_version(spark, root)
    version = dict(version)
    frames = dict(sources)
    for name in needed(models, wanted, sources):
        model = replace(models[name], kind=(kinds or {}).get(name, models[name].kind))
        inputs = [frames[i] for i in model.inputs]
        old = {} if full_refresh else version.get(name, {})
        if model.kind == "view":
            frames[name] = model.build(*inputs)
            continue
        if model.kind == "table":
            version[name] = published.write_part(model.build(*inputs), root, name, cluster=model.cluster, dealt=model.dealt)
        elif model.kind == "incremental":
            version[name] = _newer_months(spark, root, name, model, inputs, old, lookback_days)
        elif model.kind == "history":
            version[name] = _merged_history(spark, root, name, model, inputs, old, now, len(version.get(name, {})))
        else:
            raise ValueError(f"{name}: unknown kind {model.kind!r}")
        frames[name] = published.read_table(spark, root, name, version)
    published.publish(spark, root, version, after)
    return frames


def _newer_months(spark: SparkSession, root: str, name: str, model: Model, inputs: list, old: dict, lookback_days: int) -> dict:
    """Entries of an incremental model: months before the reopened ones keep their folders."""
    first = None
    if old:
        newest = {max(old): old[max(old)]}  # parts are months
        last = published.read_table(spark, root, name, {name: newest}).agg(F.max(model.day).alias("d"))
        first = last.select(F.trunc(F.date_sub("d", lookback_days), "month")).first()[0]
    fresh = model.build(*inputs, None if first is None else F.date_sub(F.lit(first), 1))
    month = F.coalesce(F.date_format(model.day, "yyyy-MM"), F.lit(NO_MONTH))
    parts = published.write_parts(fresh, root, name, month, model.cluster)
    kept = {} if first is None else {m: entry for m, entry in old.items() if m < f"{first:%Y-%m}"}
    if not kept and not parts:  # nothing yet: an empty table that can be read
        return published.write_part(fresh.limit(0), root, name, NO_MONTH)
    return kept | parts


def _merged_history(
    spark: SparkSession, root: str, name: str, model: Model, inputs: list, old: dict, now: Column | None, number: int
) -> dict:
    """Entries of a history: open versions by bucket of their key, closed ones by build."""
    spec, rows = model.spec, model.build(*inputs)
    bucket = F.format_string("open-%02d", F.pmod(F.xxhash64(spec.key), F.lit(HISTORY_BUCKETS)))
    versions = collapse_versions(rows, spec)
    if not old:
        history = packed(core.history_with_members(versions, spec))
        parts = published.write_parts(history.where("is_current"), root, name, bucket, model.cluster)
        return parts | published.write_part(history.where("not is_current"), root, name, "closed-0", model.cluster)
    history = published.read_table(spark, root, name, {name: old})
    delta = packed(history_delta(history, versions, F.current_timestamp() if now is None else now, spec))
    touched = [r[0] for r in delta.select(bucket.alias("b")).distinct().collect()]  # at most HISTORY_BUCKETS
    if not touched:
        return old
    closed = delta.where("not is_current")
    entries = {p: old[p] for p in touched if p in old}
    fresh = delta.where("is_current")
    if entries:
        stays = published.read_table(spark, root, name, {name: entries}).join(closed.select(spec.surrogate), spec.surrogate, "left_anti")
        fresh = stays.unionByName(fresh, allowMissingColumns=True)
    untouched = {p: entry for p, entry in old.items() if p not in touched}
    parts = published.write_parts(fresh, root, name, bucket, model.cluster)
    return untouched | parts | published.write_part(closed, root, name, f"closed-{number}", model.cluster)
