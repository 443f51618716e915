"""Product pages: URL map, page parsing, retries, failure reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import pages as p
from orderloom.functions.cleaning import is_blank, percent
from orderloom.functions.urls import clean_url, url_host
from orderloom.operators.dedup import first_per_key
from orderloom.operators.lookups import first_source_wins, merge_by_key

# Event types whose page is the product page, and the type whose referrer is.
PRODUCT_PAGE_TYPES = (
    "view_product_detail", "select_product_option", "select_product_option_quality", "add_to_cart_action",
    "product_detail_recommendation_visible", "product_detail_recommendation_noticed",
)
REFERRER_TYPE = "product_view_all_recommend_clicked"
FAILED = ("error", "no_react_data")


def _first_url(rows: DataFrame) -> DataFrame:
    kept = rows.where(~is_blank("product_id") & ~is_blank("url"))
    return kept.groupBy("product_id").agg(F.min_by("url", "_id").alias("url"))


def product_url_map(events: DataFrame) -> DataFrame:
    """One URL per product: of its earliest product-page event, else the referrer of a recommendation click."""
    own = F.coalesce(F.nullif("product_id", F.lit("")), "viewing_product_id")
    direct = events.where(F.col("collection").isin(*PRODUCT_PAGE_TYPES)).select(
        "_id", own.alias("product_id"), F.col("current_url").alias("url")
    )
    referred = events.where(F.col("collection") == REFERRER_TYPE).select(
        "_id", F.col("viewing_product_id").alias("product_id"), F.col("referrer_url").alias("url")
    )
    return first_source_wins(_first_url(direct), _first_url(referred), "product_id")


def pages_to_products(pages: DataFrame, product_id: str = "product_id", url: str = "url", html: str = "html") -> DataFrame:
    """Product rows from page HTML: the embedded object first, then structured data, else 'no_react_data'.

    Each script is cut out and parsed once per page; the parsed value is a column of its own.
    """
    staged = (
        pages.select(F.col(product_id).cast("string").alias("_id"), F.col(url).alias("_url"), F.col(html).alias("_html"))
        .withColumn("_text", p.embedded_json("_html"))
        .withColumn("_text", F.when(~F.col("_text").rlike(r"^\{\s*\}$"), F.col("_text")))
        .withColumn("_doc", F.from_json("_text", p.EMBEDDED_SCHEMA))
        .withColumn("_linked", F.when(F.col("_text").isNull(), F.from_json(p.linked_json("_html"), p.LINKED_SCHEMA)["mainEntity"]))
    )
    embedded = F.col("_text").isNotNull()
    linked = ~embedded & p.linked_is_product(F.col("_linked"))
    first = p.embedded_fields(F.col("_doc"))
    second = p.linked_fields(F.col("_linked"))
    out = []
    for name in [*first, *(n for n in second if n not in first)]:
        nothing = F.lit(None)
        value = F.when(embedded, first.get(name, nothing)).when(linked, second.get(name, nothing))
        out.append(value.alias(name))
    status = F.when(embedded | linked, "success").otherwise("no_react_data")
    return staged.select(
        F.col("_id").alias("product_id"),
        F.col("_url").alias("url"),
        status.alias("status"),
        F.when(~(embedded | linked), F.lit(p.NO_DATA_MESSAGE)).alias("error_message"),
        *out,
    )


def failed_rows(results: DataFrame, only_http: int | None = None) -> DataFrame:
    """Results worth a retry; `only_http` narrows to errors with that HTTP status."""
    if only_http is None:
        return results.where(F.col("status").isin(*FAILED))
    return results.where((F.col("status") == "error") & (F.col("http_status") == only_http))


def stable_url(product_id: Column | str, root: str) -> Column:
    """Catalogue address that does not depend on the product's slug."""
    c = F.col(product_id) if isinstance(product_id, str) else product_id
    return F.concat(F.lit(root.rstrip("/") + "/catalog/product/view/id/"), c)


def retry_list(results: DataFrame, root: str) -> DataFrame:
    """Failed products with cleaned address and stable fallback address."""
    return failed_rows(results).select(
        "product_id", clean_url("url").alias("url"), stable_url("product_id", root).alias("fallback_url")
    )


def merge_retries(results: DataFrame, retries: DataFrame, blocked_retries: DataFrame | None = None) -> DataFrame:
    """Retry rows replace results of the same product even when they failed again; the pass for blocked
    pages replaces only by its successes."""
    def one(df: DataFrame) -> DataFrame:
        return first_per_key(df, ["product_id"], [F.col("status").desc(), "url"])

    updates = [one(retries)]
    if blocked_retries is not None:
        updates.append(one(blocked_retries.where(F.col("status") == "success")))
    return merge_by_key(results, "product_id", *updates)


def summarize(results: DataFrame) -> DataFrame:
    """Totals by outcome; zeros for an empty input."""
    good = F.count_if(F.col("status") == "success")
    return results.agg(
        F.count("*").alias("total"),
        good.alias("success"),
        F.coalesce(F.try_divide(good * F.lit(100.0), F.count("*")), F.lit(0.0)).alias("success_rate"),
        F.count_if(F.col("status") == "error").alias("errors"),
        F.count_if(F.col("status") == "no_react_data").alias("no_react_data"),
        F.count_if(F.col("http_status") == 403).alias("http_403"),
        F.count_if(F.col("fallback_used")).alias("fallback_used"),
    )


def quality_gate(summary: DataFrame, passing: float = 90.0, warning: float = 80.0) -> DataFrame:
    """'passed', 'warning' or 'failed' by success rate, with the exit code of a run."""
    rate = F.col("success_rate")
    verdict = F.when(rate >= passing, "passed").when(rate >= warning, "warning").otherwise("failed")
    code = F.when(rate >= passing, 0).when(rate >= warning, 1).otherwise(2).cast("bigint")
    return summary.withColumn("verdict", verdict).withColumn("exit_code", code)


def failure_report(results: DataFrame, hosts: int = 10, messages: int = 5, message_length: int | None = None) -> DataFrame:
    """Failures by HTTP status, the hosts with most of them, and the most common messages.

    `message_length` cuts messages first, so that those which differ only behind it count as one.
    """
    failed = failed_rows(results)
    total = failed.agg(F.count("*").alias("n")).scalar()

    def ranked(kind: str, value: Column, rows: DataFrame, size: int | None) -> DataFrame:
        counts = rows.groupBy(value.alias("value")).agg(F.count("*").alias("failures"))
        if size is not None:
            counts = counts.orderBy(F.col("failures").desc(), "value").limit(size)
        return counts.select(F.lit(kind).alias("breakdown"), "value", "failures")

    parts = ranked("http_status", F.coalesce(F.col("http_status").cast("string"), F.lit("None")), failed, None)
    parts = parts.unionByName(ranked("host", url_host("url"), failed, hosts))
    texts = failed.where(~is_blank("error_message"))
    message = F.col("error_message") if message_length is None else F.substring("error_message", 1, message_length)
    parts = parts.unionByName(ranked("message", message, texts, messages))
    return parts.withColumn("failure_pct", percent(F.col("failures"), total, 1))
