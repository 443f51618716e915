"""The test tables dressed up as the raw tables of a shop.

Every view is one SELECT in the SQL that Spark and DuckDB share; a few tokens differ:
`@name@` is a test table, `DIV` integer division, `EPOCH(x)` seconds since 1970.
All views scale with the test tables. Nothing is sampled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from orderloom.session import use_utc

# A click-stream event per row of `events`.
EV = """
SELECT 'e' || lpad(CAST(event_id AS STRING), 12, '0') AS _id,
  'd' || CAST(user_id AS STRING) AS device_id,
  CASE WHEN user_id % 3 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS user_id_db,
  CASE WHEN user_id % 4 = 0 THEN ''
       ELSE 'u' || CAST(user_id AS STRING) || '_' || CAST((event_id DIV 700) % 3 AS STRING)
            || '@mail' || CAST(user_id % 7 AS STRING) || '.com' END AS email_address,
  CASE WHEN user_id % 50 = 7 THEN '10.0.' || CAST(user_id % 256 AS STRING) || '.9'
       WHEN user_id % 50 = 11 THEN '2001:db8::' || CAST(user_id AS STRING)
       WHEN user_id % 50 = 13 THEN 'unknown-' || CAST(user_id AS STRING)
       WHEN user_id % 50 = 17 THEN '192.168.1.' || CAST(user_id % 256 AS STRING)
       WHEN user_id % 50 = 19 THEN '127.0.0.1'
       ELSE CAST(user_id % 200 + 11 AS STRING) || '.' || CAST((user_id DIV 200) % 256 AS STRING) || '.'
            || CAST((user_id DIV 51200) % 256 AS STRING) || '.' || CAST(user_id % 250 AS STRING) END AS ip,
  CAST(user_id % 90 AS STRING) AS store_id,
  CASE user_id % 7
    WHEN 0 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 13_3 like Mac OS X) Version/13.0 Mobile Safari/604.1'
    WHEN 1 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/120.0.0.0 Safari/537.36'
    WHEN 2 THEN 'Mozilla/5.0 (Linux; Android 10) Chrome/80.0 Mobile Safari/537.36'
    WHEN 3 THEN 'Mozilla/5.0 (iPad; CPU OS 13_3 like Mac OS X) Version/13.0 Safari/604.1'
    WHEN 4 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.0.0'
    WHEN 5 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10.15; rv:121.0) Firefox/121.0'
    ELSE 'curl/7.68.0' END AS user_agent,
  CASE WHEN event_id % 19 = 0 THEN '' ELSE '1920x1080' END AS resolution,
  CASE event_type WHEN 'purchase' THEN 'checkout_success'
    WHEN 'view' THEN CASE event_id % 4 WHEN 0 THEN 'view_listing_page' WHEN 1 THEN 'search_box_action'
                                       ELSE 'view_product_detail' END
    WHEN 'click' THEN CASE event_id % 5 WHEN 0 THEN 'product_view_all_recommend_clicked'
                                        WHEN 1 THEN 'product_detail_recommendation_clicked'
                                        ELSE 'select_product_option' END
    WHEN 'signup' THEN CASE event_id % 3 WHEN 0 THEN 'checkout' WHEN 1 THEN 'add_to_cart_action'
                                         ELSE 'view_my_account' END
    ELSE CASE event_id % 3 WHEN 0 THEN 'product_detail_recommendation_visible'
                           WHEN 1 THEN 'product_detail_recommendation_noticed'
                           ELSE 'view_static_page' END END AS collection,
  EPOCH(ts) AS time_stamp,
  'https://shop' || CAST(user_id % 10 AS STRING) || CASE WHEN user_id % 4 = 1 THEN '.ca' ELSE '.de' END
    || '/p-' || CAST(event_id % 500 AS STRING) || '.html'
    || CASE event_id % 6 WHEN 0 THEN '?utm_source=feed&alloy=gold' WHEN 1 THEN '?alloy=red&stone=ruby'
                         WHEN 2 THEN '?fbclid=x' ELSE '' END AS current_url,
  CASE WHEN event_id % 4 = 0 THEN '' ELSE 'https://ref.example.com/p-' || CAST(event_id % 600 AS STRING) END AS referrer_url,
  CASE WHEN event_id % 11 = 0 THEN '' WHEN event_id % 5 = 0 THEN NULL
       ELSE CAST(event_id % 500 AS STRING) END AS product_id,
  CASE WHEN event_id % 7 = 0 THEN '' ELSE CAST(event_id % 650 AS STRING) END AS viewing_product_id,
  CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN '' WHEN event_id % 23 = 0 THEN '1.234,50'
       WHEN event_id % 29 = 0 THEN '0'
       ELSE CAST(CAST(round(value * 100) AS BIGINT) DIV 100 AS STRING) || '.'
            || lpad(CAST(CAST(round(value * 100) AS BIGINT) % 100 AS STRING), 2, '0') END AS price,
  CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 37 = 0 THEN ''
       ELSE CASE user_id % 3 WHEN 0 THEN 'EUR' WHEN 1 THEN 'USD' ELSE 'CAD' END END AS currency,
  CASE WHEN event_type = 'purchase' AND event_id % 10 > 0 THEN CAST(event_id AS STRING) ELSE '' END AS order_id,
  event_id % 5 = 0 AS recommendation,
  CAST('2024-02-01' AS DATE) AS ingest_date,
  event_id, user_id
FROM @events@
"""

# The same events, every tenth delivered again (with another price) one day later.
EV_DUP = """
SELECT * FROM ev
UNION ALL
SELECT _id, device_id, user_id_db, email_address, ip, store_id, user_agent, resolution, collection, time_stamp,
  current_url, referrer_url, product_id, viewing_product_id, '77.50' AS price, currency, order_id, recommendation,
  CAST('2024-02-02' AS DATE) AS ingest_date, event_id, user_id
FROM ev WHERE event_id % 10 = 0
"""

# The events as JSON lines with the type mixtures of real exports, and some blank lines.
JSONL = """
SELECT '{"_id":"' || _id || '","device_id":"' || device_id || '"'
  || CASE WHEN user_id_db = '' THEN '' ELSE ',"user_id_db":"' || user_id_db || '"' END
  || CASE WHEN email_address = '' THEN ',"email_address":null' ELSE ',"email_address":"' || email_address || '"' END
  || ',"ip":"' || ip || '","store_id":' || CASE WHEN event_id % 2 = 0 THEN store_id ELSE '"' || store_id || '"' END
  || ',"user_agent":"' || user_agent || '","resolution":"' || resolution || '"'
  || ',"utm_source":' || CASE event_id % 3 WHEN 0 THEN 'true' WHEN 1 THEN '"google"' ELSE 'null' END
  || ',"api_version":"1.0","collection":"' || collection || '","time_stamp":'
  || CASE WHEN event_id % 2 = 1 THEN '"' || CAST(time_stamp AS STRING) || '"' ELSE CAST(time_stamp AS STRING) END
  || ',"current_url":"' || current_url || '","referrer_url":"' || referrer_url || '","product_id":'
  || CASE WHEN product_id IS NULL THEN 'null' ELSE '"' || product_id || '"' END
  || ',"viewing_product_id":"' || viewing_product_id || '","option":'
  || CASE event_id % 5 WHEN 0 THEN '{"alloy":"gold-' || store_id || '","diamond":""}'
       WHEN 1 THEN '[{"option_id":"' || CAST(event_id % 100 AS STRING)
            || '","option_label":"alloy","value_id":"7","value_label":"red"},"junk",{"option_label":"stone","quality":"A"}]'
       WHEN 2 THEN '""' WHEN 3 THEN '{}' ELSE 'null' END
  || ',"price":' || CASE WHEN price IS NULL THEN 'null' ELSE '"' || price || '"' END
  || ',"currency":' || CASE WHEN currency IS NULL THEN 'null' ELSE '"' || currency || '"' END
  || ',"key_search":' || CASE WHEN event_id % 6 = 0 THEN '{"q":1}' WHEN event_id % 6 = 1 THEN '"[gold"' ELSE '"ring"' END
  || CASE WHEN collection = 'checkout_success'
       THEN ',"cart_products":[{"product_id":' || CAST(event_id % 500 AS STRING) || ',"amount":' || CAST(event_id % 4 + 1 AS STRING)
            || ',"price":"12,50","currency":"EUR","option":""},{"product_id":"' || CAST(event_id % 300 AS STRING)
            || '","amount":1,"price":"9.90","currency":"USD","option":[{"option_id":261151,"option_label":"diamond","value_id":2166253,"value_label":"Sapphire"}]}]'
       WHEN event_id % 2 = 0 THEN ',"cart_products":[]' ELSE '' END
  || ',"order_id":' || CASE WHEN order_id = '' THEN '""' ELSE order_id END
  || ',"is_paypal":' || CASE WHEN event_id % 4 = 0 THEN 'true' WHEN event_id % 4 = 1 THEN '"false"' ELSE 'null' END
  || ',"recommendation":' || CASE WHEN recommendation THEN 'true' ELSE 'false' END
  || ',"recommendation_clicked_position":' || CASE WHEN event_id % 8 = 0 THEN CAST(event_id % 12 AS STRING) ELSE 'null' END
  || ',"extra":{"a":{"b":{"c":{"d":{"e":{"f":' || CAST(event_id % 7 AS STRING) || '}}}}},"mix":[1,2,3,"x",{"late":true}]}'
  || '}' AS line, event_id
FROM ev
UNION ALL
SELECT '   ' AS line, event_id FROM ev WHERE event_id % 50 = 0
"""

# Order lines: one per row of lineitem, with money in cents and a few impossible quantities and prices.
LINES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
  CASE WHEN l_orderkey % 997 = 1 THEN 9999 WHEN l_orderkey % 991 = 2 THEN 1000 WHEN l_orderkey % 983 = 3 THEN 60
       ELSE CAST(l_quantity AS BIGINT) END AS quantity,
  CASE WHEN l_orderkey % 101 = 5 THEN 0
       ELSE CAST(round(l_extendedprice * 100) AS BIGINT) DIV greatest(CAST(l_quantity AS BIGINT), 1) END AS unit_cents,
  l_shipdate
FROM @lineitem@ JOIN @orders@ ON l_orderkey = o_orderkey
"""

# Order lines in the shape of the sales fact. Discounted small orders stay below the line threshold.
SALES = """
SELECT CAST(l_orderkey AS STRING) AS order_id, order_date,
  CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date) AS BIGINT) AS date_key,
  l_suppkey % 86 + 1 AS store_id, o_custkey + 1 AS customer_key, l_partkey + 1 AS product_key,
  CASE WHEN o_custkey % 13 = 0 THEN -1 ELSE o_custkey % 25 + 1 END AS location_key,
  o_custkey % 3 + 1 AS device_key, quantity, unit_cents,
  CASE WHEN l_orderkey % 4 = 0 THEN quantity * unit_cents ELSE quantity * unit_cents DIV 40 END AS usd_cents
FROM lines
"""

# Product catalogue: one crawl result per part, some delivered twice, with sentinels.
PROD = """
SELECT CAST(p_partkey AS STRING) AS product_id,
  CASE WHEN p_partkey % 41 = 0 THEN '' WHEN p_partkey % 3 = 0 THEN 'http://shop.example.com/p/' || CAST(p_partkey AS STRING)
       ELSE 'https://shop.example.com/p/' || CAST(p_partkey AS STRING) || '?utm_source=x&size=' || CAST(p_size AS STRING) END AS url,
  CASE WHEN p_partkey % 20 = 1 THEN 'error' WHEN p_partkey % 50 = 2 THEN 'no_react_data' ELSE 'success' END AS status,
  CASE WHEN p_partkey % 40 = 1 THEN 403 WHEN p_partkey % 20 = 1 THEN 404 WHEN p_partkey % 50 = 3 THEN NULL ELSE 200 END AS http_status,
  CASE WHEN p_partkey % 20 = 1 THEN 'HTTP error on page of brand ' || p_brand || ' while reading the product description block'
       WHEN p_partkey % 50 = 2 THEN 'no data' ELSE NULL END AS error_message,
  p_partkey % 40 = 1 AS fallback_used,
  CASE WHEN p_partkey % 43 = 0 THEN '' WHEN p_partkey % 47 = 0 THEN 'ab' ELSE p_name END AS product_name,
  CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE 'SKU-' || CAST(p_partkey AS STRING) END AS sku,
  CASE p_partkey % 9 WHEN 0 THEN '-1' WHEN 1 THEN '--_select_--' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE p_type END AS product_type,
  CASE WHEN p_partkey % 8 = 0 THEN '' ELSE p_brand END AS collection,
  CASE p_partkey % 6 WHEN 0 THEN 'false' WHEN 1 THEN 'FALSE' WHEN 2 THEN '' WHEN 3 THEN 'women' ELSE 'men' END AS gender,
  CASE p_partkey % 10 WHEN 0 THEN '0' WHEN 1 THEN '' ELSE CAST(p_size % 12 AS STRING) END AS category,
  CASE WHEN p_partkey % 10 < 2 THEN '' ELSE 'cat ' || CAST(p_size % 12 AS STRING) END AS category_name,
  CASE p_partkey % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'CAD' ELSE '' END AS currency_code,
  CASE WHEN p_partkey % 31 = 0 THEN '0' WHEN p_partkey % 37 = 0 THEN 'n/a' WHEN p_partkey % 61 = 0 THEN ''
       ELSE CAST(CAST(round(p_retailprice * 100) AS BIGINT) DIV 100 AS STRING) || '.'
            || lpad(CAST(CAST(round(p_retailprice * 100) AS BIGINT) % 100 AS STRING), 2, '0') END AS price,
  CAST(CAST(floor(p_retailprice) AS BIGINT) - p_partkey % 15 + CASE WHEN p_partkey % 71 = 0 THEN 30 ELSE 0 END AS STRING) AS min_price,
  CAST(CAST(floor(p_retailprice) AS BIGINT) + p_partkey % 25 + 1 AS STRING) AS max_price,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size AS STRING) || '.5' END AS gold_weight,
  CASE WHEN p_partkey % 10 = 9 THEN NULL ELSE 's' || CAST(p_partkey % 17 AS STRING) END AS store_code,
  'set' || CAST(p_partkey % 5 AS STRING) AS attribute_set, 'm' || CAST(p_partkey % 7 AS STRING) AS material_design,
  CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 6 = 1 THEN 'http://img/x.jpg' ELSE 'https://img/x.jpg' END AS primary_image_url,
  CASE WHEN p_partkey % 3 = 0 THEN 'https://video/x.mp4' ELSE '' END AS primary_video_url,
  CAST('2024-02-01' AS DATE) AS ingest_date, p_partkey
FROM @part@
"""
PROD_COLUMNS = (
    "product_id, url, status, http_status, error_message, fallback_used, product_name, sku, product_type,"
    " collection, gender, category, category_name, currency_code, price, min_price, max_price, gold_weight,"
    " store_code, attribute_set, material_design, primary_image_url, primary_video_url"
)
PROD_DUP = f"""
SELECT * FROM prod
UNION ALL
SELECT {PROD_COLUMNS.replace("product_name", "'new ' || product_name AS product_name")},
  CAST('2024-02-02' AS DATE) AS ingest_date, p_partkey
FROM prod WHERE p_partkey % 12 = 5
"""

# Address book: one address per customer, with the address formula of the events.
GEO = """
SELECT CASE WHEN c_custkey % 50 = 7 THEN '10.0.' || CAST(c_custkey % 256 AS STRING) || '.9'
       WHEN c_custkey % 50 = 11 THEN '2001:db8::' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 50 = 13 THEN 'unknown-' || CAST(c_custkey AS STRING)
       WHEN c_custkey % 50 = 17 THEN '192.168.1.' || CAST(c_custkey % 256 AS STRING)
       WHEN c_custkey % 50 = 19 THEN '127.0.0.1'
       ELSE CAST(c_custkey % 200 + 11 AS STRING) || '.' || CAST((c_custkey DIV 200) % 256 AS STRING) || '.'
            || CAST((c_custkey DIV 51200) % 256 AS STRING) || '.' || CAST(c_custkey % 250 AS STRING) END AS ip,
  CASE WHEN c_custkey % 21 = 0 THEN '' WHEN c_custkey % 22 = 0 THEN NULL WHEN c_custkey % 23 = 0 THEN '-' ELSE n_name END AS country,
  CASE WHEN c_custkey % 7 = 0 OR c_custkey % 22 = 0 THEN '' ELSE r_name END AS region,
  CASE WHEN c_custkey % 5 = 0 OR c_custkey % 7 = 0 OR c_custkey % 22 = 0 THEN NULL WHEN c_custkey % 58 = 1 THEN 'X'
       ELSE c_mktsegment END AS city,
  CAST('2024-02-01' AS DATE) AS ingest_date, c_custkey
FROM @customer@ JOIN @nation@ ON c_nationkey = n_nationkey JOIN @region@ ON n_regionkey = r_regionkey
"""

# Currency seed out of the suppliers' countries: a symbol may have a pattern rate and a default rate.
FX = """
SELECT DISTINCT 'c' || CAST(s_nationkey % 9 AS STRING) AS currency_symbol, '%.ca/%' AS url_pattern,
  CAST(1 AS BIGINT) AS priority, 'CA' || CAST(s_nationkey % 9 AS STRING) AS currency_code,
  CAST(CAST(75 + s_nationkey % 9 AS DECIMAL(18,6)) / 100 AS DECIMAL(18,6)) AS rate_to_usd
FROM @supplier@ WHERE s_nationkey % 9 < 4
UNION
SELECT DISTINCT 'c' || CAST(s_nationkey % 9 AS STRING), '', CAST(2 AS BIGINT),
  CASE WHEN s_nationkey % 9 = 8 THEN 'UNDEFINED' ELSE 'EU' || CAST(s_nationkey % 9 AS STRING) END,
  CAST(CAST(110 + s_nationkey % 9 AS DECIMAL(18,6)) / 100 AS DECIMAL(18,6))
FROM @supplier@ WHERE s_nationkey % 9 <> 6
"""

# Checkout events: one per order line. The cart holds the line, sometimes a second product, sometimes the
# same product again, and is empty for every seventh line.
CHECKOUT = """
SELECT 'o' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING)
    || '-' || CAST(l_suppkey AS STRING) || '-' || CAST(quantity AS STRING) || '-' || CAST(unit_cents AS STRING) AS event_id,
  CAST(order_date AS DATE) AS event_date, l_orderkey % 86400 AS second_of_day,
  CAST(o_custkey % 86 + 1 AS BIGINT) AS store_id,
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(o_custkey AS STRING) END AS user_id_db,
  'd' || CAST(o_custkey AS STRING) AS device_id,
  CASE WHEN o_custkey % 7 = 0 THEN NULL
       ELSE 'u' || CAST(o_custkey AS STRING) || '_' || CAST(l_orderkey % 2 AS STRING) || '@mail' || CAST(o_custkey % 6 AS STRING) || '.com' END AS email_address,
  CAST(o_custkey % 200 + 11 AS STRING) || '.' || CAST((o_custkey DIV 200) % 256 AS STRING) || '.'
    || CAST((o_custkey DIV 51200) % 256 AS STRING) || '.' || CAST(o_custkey % 250 AS STRING) AS ip_address,
  CASE o_custkey % 4
    WHEN 0 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 13_3 like Mac OS X) Version/13.0 Mobile Safari/604.1'
    WHEN 1 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) Chrome/120.0.0.0 Safari/537.36'
    WHEN 2 THEN 'Mozilla/5.0 (Linux; Android 10) Chrome/80.0 Mobile Safari/537.36'
    ELSE 'Mozilla/5.0 (iPad; CPU OS 13_3 like Mac OS X) Version/13.0 Safari/604.1' END AS user_agent,
  'https://shop' || CAST(o_custkey % 10 AS STRING) || CASE WHEN o_custkey % 3 = 1 THEN '.ca' ELSE '.de' END || '/checkout' AS current_url,
  CAST(l_orderkey AS STRING) AS order_id, l_orderkey % 5 = 0 AS is_recommendation_influenced,
  l_linenumber, l_orderkey, l_partkey, quantity, unit_cents,
  'c' || CAST(o_custkey % 9 AS STRING) AS symbol,
  CASE l_linenumber % 4
    WHEN 0 THEN CAST(unit_cents DIV 100 AS STRING) || ',' || lpad(CAST(unit_cents % 100 AS STRING), 2, '0')
    WHEN 1 THEN CAST(unit_cents DIV 100 AS STRING) || '.' || lpad(CAST(unit_cents % 100 AS STRING), 2, '0')
    WHEN 2 THEN CAST(unit_cents DIV 100000 AS STRING) || '.' || lpad(CAST((unit_cents DIV 100) % 1000 AS STRING), 3, '0')
                || ',' || lpad(CAST(unit_cents % 100 AS STRING), 2, '0')
    ELSE CAST(unit_cents DIV 100000 AS STRING) || ',' || lpad(CAST((unit_cents DIV 100) % 1000 AS STRING), 3, '0')
                || '.' || lpad(CAST(unit_cents % 100 AS STRING), 2, '0') END AS price_text
FROM lines
"""

# Crawl results per page, and two rounds of retries.
CRAWL = """
SELECT CAST(page_id AS STRING) AS product_id, url,
  CASE WHEN page_id % 9 = 4 THEN 'error' WHEN page_id % 14 = 5 THEN 'no_react_data' ELSE 'success' END AS status,
  CASE WHEN page_id % 18 = 4 THEN 403 WHEN page_id % 9 = 4 THEN 404 ELSE 200 END AS http_status,
  CASE WHEN page_id % 9 = 4 THEN 'Failed to fetch page after several attempts with status ' || CAST(400 + page_id % 4 AS STRING)
       WHEN page_id % 14 = 5 THEN 'react_data not found, HTML fallback also failed' ELSE NULL END AS error_message,
  page_id % 18 = 4 AS fallback_used, page_id
FROM @pages@
"""
RETRY = """
SELECT product_id, url || '?retry=1' AS url, CASE WHEN page_id % 2 = 0 THEN 'success' ELSE 'error' END AS status,
  CASE WHEN page_id % 2 = 0 THEN 200 ELSE 403 END AS http_status,
  CASE WHEN page_id % 2 = 0 THEN NULL ELSE 'still blocked' END AS error_message, TRUE AS fallback_used, page_id
FROM crawl WHERE status <> 'success'
"""
RETRY_BLOCKED = """
SELECT product_id, url, CASE WHEN page_id % 5 < 3 THEN 'success' ELSE 'error' END AS status,
  CASE WHEN page_id % 5 < 3 THEN 200 ELSE 403 END AS http_status, CAST(NULL AS STRING) AS error_message,
  FALSE AS fallback_used, page_id
FROM retry WHERE http_status = 403
"""

# name -> (SQL, views it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "ev": (EV, ()),
    "ev_dup": (EV_DUP, ("ev",)),
    "jsonl": (JSONL, ("ev",)),
    "lines": (LINES, ()),
    "sales": (SALES, ("lines",)),
    "prod": (PROD, ()),
    "prod_dup": (PROD_DUP, ("prod",)),
    "geo": (GEO, ()),
    "fx": (FX, ()),
    "checkout": (CHECKOUT, ("lines",)),
    "crawl": (CRAWL, ()),
    "retry": (RETRY, ("crawl",)),
    "retry_blocked": (RETRY_BLOCKED, ("retry",)),
}


def _ordered(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []
    for name in names:
        for dep in [*_ordered(VIEWS[name][1]), name]:
            if dep not in out:
                out.append(dep)
    return out


def _spark_sql(sql: str, sf_dir: str) -> str:
    sql = re.sub(r"@(\w+)@", lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", sql)
    return re.sub(r"EPOCH\((\w+)\)", r"unix_seconds(CAST(\1 AS TIMESTAMP))", sql)


def _duck_sql(sql: str) -> str:
    sql = re.sub(r"@(\w+)@", r"\1", sql)
    sql = re.sub(r"EPOCH\((\w+)\)", r"CAST(floor(epoch(\1)) AS BIGINT)", sql)
    return sql.replace(" DIV ", " // ")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stand-in view as a DataFrame."""
    use_utc(spark)
    ctes = ",\n".join(f"{n} AS ({_spark_sql(VIEWS[n][0], sf_dir)})" for n in _ordered((name,)))
    return spark.sql(f"WITH {ctes}\nSELECT * FROM {name}")


def view_of(spark: SparkSession, name: str, **inputs: DataFrame) -> DataFrame:
    """A stand-in view over frames in place of the views it reads."""
    use_utc(spark)
    sql = _spark_sql(VIEWS[name][0], "")
    for given in inputs:
        sql = re.sub(rf"\bFROM {given}\b", f"FROM {{{given}}}", sql)
    return spark.sql(sql, **inputs)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table as it is."""
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def duck(body: str, *names: str, **ctes: str) -> str:
    """DuckDB query: stand-in views, then further CTEs, then the body."""
    parts = [f"{n} AS ({_duck_sql(VIEWS[n][0]).strip()})" for n in _ordered(names)]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in ctes.items()]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + body.strip()
