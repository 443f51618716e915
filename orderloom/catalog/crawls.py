"""Product pages, addresses and crawl results."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.registry import query
from orderloom.catalog.standins import duck, table, view
from orderloom.functions import pages as p
from orderloom.operators import crawl
from orderloom.operators.lookups import not_yet_done

DIRECT = "('view_product_detail', 'select_product_option', 'select_product_option_quality', 'add_to_cart_action', 'product_detail_recommendation_visible', 'product_detail_recommendation_noticed')"


@query(
    "product_url_map",
    duck(
        f"""SELECT product_id, url FROM direct UNION ALL SELECT product_id, url FROM referred WHERE product_id NOT IN (SELECT product_id FROM direct)""",
        "ev",
        direct=f"""SELECT coalesce(nullif(product_id, ''), viewing_product_id) AS product_id, arg_min(current_url, _id) AS url FROM ev
          WHERE collection IN {DIRECT} AND coalesce(nullif(product_id, ''), viewing_product_id) <> '' GROUP BY 1""",
        referred="""SELECT viewing_product_id AS product_id, arg_min(referrer_url, _id) AS url FROM ev
          WHERE collection = 'product_view_all_recommend_clicked' AND viewing_product_id <> '' AND referrer_url <> '' GROUP BY 1""",
    ),
)
def product_url_map(spark, sf):
    """One address per product: direct page views first, then referrers."""
    return crawl.product_url_map(view(spark, sf, "ev"))


HEADING = "regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)"
DECODED = "{}"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    DECODED = f"replace({DECODED}, '{_entity}', '{_char}')"
NAME = "trim(" + DECODED.format(f"regexp_replace({HEADING}, '<[^>]*>', '', 'g')") + ")"


@query("page_product_name", f"SELECT page_id, {NAME} AS product_name FROM pages")
def page_product_name(spark, sf):
    """Name from the first heading of each page (these pages have no Open Graph title)."""
    return table(spark, sf, "pages").select("page_id", p.product_name("html").alias("product_name"))


def _scripted(spark, sf):
    """Pages with product scripts: embedded object, structured data, a broken object, or nothing."""
    pages = table(spark, sf, "pages")
    number = F.col("page_id")
    product = F.to_json(
        F.struct(
            number.alias("product_id"),
            F.concat(F.lit("Ring "), number.cast("string")).alias("name"),
            F.concat(F.lit("sku-"), number.cast("string")).alias("sku"),
            (number % 100 + F.lit(0.5)).alias("price"),
            F.length("html").alias("qty"),
            F.lit("ring").alias("product_type"),
            F.struct(F.lit("EUR").alias("currencyCode"), F.lit(19).alias("currentTax")).alias("product_price"),
            F.struct(F.array(F.struct(F.concat(F.lit("https://img/"), number.cast("string")).alias("large_image_url"))).alias("images")).alias("media_image"),
            F.struct(F.struct(F.lit("women").alias("value")).alias("gender")).alias("attributes"),
        )
    )
    linked = F.to_json(
        F.struct(
            F.struct(
                F.concat(F.lit("Band "), number.cast("string")).alias("name"),
                F.when(number % 8 == 1, F.concat(F.lit("ld-"), number.cast("string"))).alias("sku"),
                F.struct(F.lit("12.50").alias("price"), F.lit("USD").alias("priceCurrency")).alias("offers"),
                F.array(F.struct(F.lit("Stone").alias("name"), F.lit("ruby").alias("value"))).alias("additionalProperty"),
            ).alias("mainEntity")
        )
    )
    script = (
        F.when(number % 4 == 0, F.concat(F.lit("<script>\n var react_data = "), product, F.lit("; </script>")))
        .when(number % 4 == 1, F.concat(F.lit('<script id="structured-data" type="application/ld+json">'), linked, F.lit("</script>")))
        .when(number % 4 == 2, F.lit("<script>var react_data = {invalid json, missing quotes};</script>"))
        .otherwise("")
    )
    return pages.select("page_id", number.cast("string").alias("product_id"), "url", F.concat("html", script).alias("html"))


@query("page_embedded_json", "SELECT page_id, 'Ring ' || page_id AS name FROM pages WHERE page_id % 4 = 0")
def page_embedded_json(spark, sf):
    """The embedded object where there is a valid one."""
    found = _scripted(spark, sf).select("page_id", p.embedded_json("html").alias("doc"))
    return found.where(F.col("doc").isNotNull()).select("page_id", F.get_json_object("doc", "$.name").alias("name"))


@query("page_json_ld", "SELECT page_id, 'Band ' || page_id AS name, 'ld-' || page_id AS sku, '12.50' AS price, 'ruby' AS stone FROM pages WHERE page_id % 8 = 1")
def page_json_ld(spark, sf):
    """Structured data with name and sku."""
    item = _scripted(spark, sf).select("page_id", F.from_json(p.linked_json("html"), p.LINKED_SCHEMA)["mainEntity"].alias("item"))
    found = item.where(p.linked_is_product(F.col("item")))
    fields = p.linked_fields(F.col("item"))
    return found.select(
        "page_id", fields["product_name"].alias("name"), fields["sku"].alias("sku"), fields["price"].alias("price"),
        fields["additional_properties"]["stone"].alias("stone"),
    )


@query(
    "product_fields_flatten",
    """SELECT page_id, 'Ring ' || page_id AS product_name, 'sku-' || page_id AS sku, CAST(page_id % 100 AS VARCHAR) || '.5' AS price, CAST(length(html) AS VARCHAR) AS qty,
      'EUR' AS currency_code, '19' AS tax_rate, 'https://img/' || page_id AS primary_image_url, 'women' AS gender_label, CAST(NULL AS VARCHAR) AS primary_video_url
    FROM pages WHERE page_id % 4 = 0""",
)
def product_fields_flatten(spark, sf):
    """Flat fields out of the nested embedded object."""
    docs = _scripted(spark, sf).withColumn("doc", F.from_json(p.embedded_json("html"), p.EMBEDDED_SCHEMA))
    fields = p.embedded_fields(F.col("doc"))
    names = ["product_name", "sku", "price", "qty", "currency_code", "tax_rate", "primary_image_url", "gender_label", "primary_video_url"]
    return docs.where(F.col("doc").isNotNull()).select("page_id", *[fields[n].alias(n) for n in names])


@query(
    "page_to_product",
    """SELECT CAST(page_id AS VARCHAR) AS product_id, url, CASE WHEN page_id % 4 = 0 OR page_id % 8 = 1 THEN 'success' ELSE 'no_react_data' END AS status,
      CASE WHEN page_id % 4 = 0 THEN 'Ring ' || page_id WHEN page_id % 8 = 1 THEN 'Band ' || page_id END AS product_name,
      CASE WHEN page_id % 4 = 0 THEN CAST(page_id % 100 AS VARCHAR) || '.5' WHEN page_id % 8 = 1 THEN '12.50' END AS price,
      CASE WHEN page_id % 4 = 0 THEN 'EUR' WHEN page_id % 8 = 1 THEN 'USD' END AS currency_code,
      CASE WHEN NOT (page_id % 4 = 0 OR page_id % 8 = 1) THEN 'react_data not found, HTML fallback also failed' END AS error_message,
      CASE WHEN page_id % 8 = 1 THEN 'json_ld_fallback' END AS data_source FROM pages""",
)
def page_to_product(spark, sf):
    """Product row of every page."""
    rows = crawl.pages_to_products(_scripted(spark, sf))
    return rows.select("product_id", "url", "status", "product_name", "price", "currency_code", "error_message", "data_source")


@query(
    "failed_for_retry",
    duck(
        """SELECT product_id, CASE WHEN contains(url, '?utm_source=feed') THEN replace(url, '?utm_source=feed', '') ELSE replace(url, '&ref=x', '') END AS url,
          'https://shop.example.com/catalog/product/view/id/' || product_id AS fallback_url, coalesce(http_status = 403 AND status = 'error', FALSE) AS is_blocked
        FROM crawl WHERE status IN ('error', 'no_react_data')""",
        "crawl",
    ),
)
def failed_for_retry(spark, sf):
    """Failed products with cleaned and stable addresses; blocked ones are marked."""
    results = view(spark, sf, "crawl")
    blocked = crawl.failed_rows(results, 403).select("product_id", F.lit(True).alias("is_blocked"))
    todo = crawl.retry_list(results, "https://shop.example.com").join(blocked, "product_id", "left")
    return todo.withColumn("is_blocked", F.coalesce("is_blocked", F.lit(False)))


@query(
    "resume_anti_join",
    duck("SELECT product_id FROM prod WHERE status = 'success' AND product_id NOT IN (SELECT product_id FROM crawl)", "prod", "crawl"),
)
def resume_anti_join(spark, sf):
    """Products that have not been crawled yet."""
    todo = view(spark, sf, "prod").where(F.col("status") == "success").select("product_id")
    return not_yet_done(todo, view(spark, sf, "crawl"), "product_id")


MERGED = """SELECT c.product_id, coalesce(b.url, r.url, c.url) AS url, coalesce(b.status, r.status, c.status) AS status,
  CAST(coalesce(b.http_status, r.http_status, c.http_status) AS BIGINT) AS http_status,
  CASE WHEN b.product_id IS NOT NULL THEN b.error_message WHEN r.product_id IS NOT NULL THEN r.error_message ELSE c.error_message END AS error_message,
  coalesce(b.fallback_used, r.fallback_used, c.fallback_used) AS fallback_used
FROM crawl c LEFT JOIN retry r USING (product_id) LEFT JOIN (SELECT * FROM retry_blocked WHERE status = 'success') b ON b.product_id = c.product_id"""


def _merged(spark, sf):
    return crawl.merge_retries(view(spark, sf, "crawl"), view(spark, sf, "retry"), view(spark, sf, "retry_blocked"))


@query("merge_retry_results", duck("SELECT * FROM merged", "retry_blocked", merged=MERGED))
def merge_retry_results(spark, sf):
    """First results, retries and the pass for blocked pages merged by priority."""
    return _merged(spark, sf).drop("page_id")


SUMMARY = """SELECT CAST(count(*) AS BIGINT) AS total, CAST(count(*) FILTER (status = 'success') AS BIGINT) AS success,
  round(100.0 * count(*) FILTER (status = 'success') / count(*), 6) AS success_rate, CAST(count(*) FILTER (status = 'error') AS BIGINT) AS errors,
  CAST(count(*) FILTER (status = 'no_react_data') AS BIGINT) AS no_react_data, CAST(count(*) FILTER (http_status = 403) AS BIGINT) AS http_403,
  CAST(count(*) FILTER (fallback_used) AS BIGINT) AS fallback_used FROM {}"""


@query("summarize_crawl", duck(SUMMARY.format("crawl"), "crawl"))
def summarize_crawl(spark, sf):
    return crawl.summarize(view(spark, sf, "crawl")).withColumn("success_rate", F.round("success_rate", 6))


@query(
    "crawl_quality_gate",
    duck(
        f"""SELECT stage, total, success, verdict, exit_code FROM (SELECT *, CASE WHEN success_rate >= 90 THEN 'passed' WHEN success_rate >= 80 THEN 'warning' ELSE 'failed' END AS verdict,
          CAST(CASE WHEN success_rate >= 90 THEN 0 WHEN success_rate >= 80 THEN 1 ELSE 2 END AS BIGINT) AS exit_code
          FROM (SELECT 'first' AS stage, * FROM ({SUMMARY.format('crawl')}) UNION ALL SELECT 'merged', * FROM ({SUMMARY.format('merged')})))""",
        "retry_blocked",
        merged=MERGED,
    ),
)
def crawl_quality_gate(spark, sf):
    """Verdict before and after the retries."""
    out = None
    for stage, results in (("first", view(spark, sf, "crawl")), ("merged", _merged(spark, sf))):
        one = crawl.quality_gate(crawl.summarize(results))
        one = one.select(F.lit(stage).alias("stage"), "total", "success", "verdict", "exit_code")
        out = one if out is None else out.unionByName(one)
    return out


PCT1 = "CAST((failures * 2000 + (SELECT count(*) FROM failed)) // ((SELECT count(*) FROM failed) * 2) AS DOUBLE) / 10"


@query(
    "analyze_failures",
    duck(
        f"""SELECT breakdown, value, failures, {PCT1} AS failure_pct FROM (
          SELECT 'http_status' AS breakdown, coalesce(CAST(http_status AS VARCHAR), 'None') AS value, CAST(count(*) AS BIGINT) AS failures FROM failed GROUP BY 2
          UNION ALL (SELECT 'host', split_part(url, '/', 3), CAST(count(*) AS BIGINT) FROM failed GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
          UNION ALL (SELECT 'message', error_message[1:60], CAST(count(*) AS BIGINT) FROM failed WHERE error_message <> '' GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5))""",
        "crawl",
        failed="SELECT * FROM crawl WHERE status IN ('error', 'no_react_data')",
    ),
)
def analyze_failures(spark, sf):
    """Failures by status, host and message."""
    return crawl.failure_report(view(spark, sf, "crawl"), message_length=60)
