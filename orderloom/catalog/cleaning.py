"""Staging models and the column rules they are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.catalog.frames import distinct_checkouts, raw_events, raw_ip_locations, raw_products, staged_checkouts
from orderloom.catalog.registry import query
from orderloom.catalog.standins import duck, table, view
from orderloom.functions import agents, cleaning as c, urls
from orderloom.operators.dedup import latest_per_key
from orderloom.operators.lookups import locate_ips
from orderloom.plans import intermediate, staging

NUMERIC = "CASE WHEN regexp_matches(price, '^[0-9]+(\\.[0-9]+)?$') THEN CAST(price AS DOUBLE) END"

STG = f"""SELECT _id AS event_id, strftime(to_timestamp(time_stamp) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS event_timestamp,
  CAST(to_timestamp(time_stamp) AT TIME ZONE 'UTC' AS DATE) AS event_date, collection AS event_type,
  CAST(store_id AS BIGINT) AS store_id, nullif(user_id_db, '') AS user_id_db, device_id, nullif(email_address, '') AS email_address,
  ip AS ip_address, user_agent, nullif(resolution, '') AS resolution, current_url, nullif(referrer_url, '') AS referrer_url,
  nullif(order_id, '') AS order_id, CAST(CASE WHEN order_id <> '' THEN event_id % 3 ELSE 0 END AS BIGINT) AS cart_lines,
  nullif(product_id, '') AS product_id, nullif(currency, '') AS currency_code, {NUMERIC} AS price,
  recommendation AS is_recommendation_influenced, strftime(CAST(ingest_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ingested_at,
  CAST(NULL AS VARCHAR) AS device_category, CAST(NULL AS VARCHAR) AS browser_name, CAST(NULL AS VARCHAR) AS operating_system
FROM ev_dup QUALIFY row_number() OVER (PARTITION BY _id ORDER BY ingest_date DESC) = 1"""


@query("stg_events", duck(STG, "ev_dup"))
def stg_events(spark, sf):
    """Deduplicated, renamed, typed and cleaned events."""
    df = staging.stg_events(raw_events(spark, sf, "ev_dup"))
    return df.withColumn("cart_lines", F.size("cart_products")).drop("cart_products")


@query(
    "dedup_latest",
    duck(
        """SELECT _id, price, CAST(ingest_date AS VARCHAR) AS ingest_date FROM ev_dup
        QUALIFY row_number() OVER (PARTITION BY _id ORDER BY ingest_date DESC) = 1""",
        "ev_dup",
    ),
)
def dedup_latest(spark, sf):
    rows = latest_per_key(view(spark, sf, "ev_dup"), ["_id"], at="ingest_date")
    return rows.select("_id", "price", F.col("ingest_date").cast("string").alias("ingest_date"))


STG_IP = """SELECT ip AS ip_address, nullif(country, '') AS country_name, nullif(region, '') AS region_name, nullif(city, '') AS city_name,
  strftime(CAST(ingest_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ingested_at,
  CAST(CASE WHEN nullif(city, '') IS NOT NULL THEN 3 WHEN nullif(region, '') IS NOT NULL THEN 2
            WHEN nullif(country, '') IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS geo_completeness_level
FROM geo QUALIFY row_number() OVER (PARTITION BY ip ORDER BY ingest_date DESC, c_custkey) = 1"""


@query("stg_ip_locations", duck(STG_IP, "geo"))
def stg_ip_locations(spark, sf):
    return staging.stg_ip_locations(raw_ip_locations(spark, sf), tie_break=["c_custkey"])


@query(
    "geo_completeness",
    duck(
        """SELECT CAST(CASE WHEN nullif(city, '') IS NOT NULL THEN 3 WHEN nullif(region, '') IS NOT NULL THEN 2
          WHEN nullif(country, '') IS NOT NULL THEN 1 ELSE 0 END AS BIGINT) AS level, CAST(count(*) AS BIGINT) AS n FROM geo GROUP BY 1""",
        "geo",
    ),
)
def geo_completeness(spark, sf):
    parts = [c.blank_to_null(x) for x in ("country", "region", "city")]
    level = c.geo_completeness(*parts)
    return view(spark, sf, "geo").groupBy(level.alias("level")).agg(F.count("*").alias("n"))


def _amount(column: str, positive: bool = True) -> str:
    number = f"CASE WHEN regexp_matches({column}, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST({column} AS DOUBLE) END"
    return f"CASE WHEN {number} > 0 THEN {number} END" if positive else number


STG_PRODUCTS = f"""SELECT product_id, nullif(url, '') AS url, nullif(product_name, '') AS product_name, sku,
  CASE WHEN coalesce(product_type, '') IN ('', '-1', '--_select_--') THEN 'Unknown' ELSE product_type END AS product_type,
  nullif(collection, '') AS collection_name,
  CASE WHEN coalesce(gender, '') IN ('', 'false', 'FALSE') THEN 'Unknown' ELSE gender END AS gender,
  CASE WHEN category NOT IN ('0', '') THEN category END AS category_id,
  CASE WHEN category_name = '' THEN 'Unknown' ELSE category_name END AS category_name, nullif(currency_code, '') AS currency_code,
  {_amount('price')} AS price, {_amount('min_price')} AS min_price, {_amount('max_price')} AS max_price,
  {_amount('gold_weight', False)} AS gold_weight, status, strftime(CAST(ingest_date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS ingested_at
FROM prod_dup WHERE status = 'success' QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY ingest_date DESC) = 1"""


@query("stg_products", duck(STG_PRODUCTS, "prod_dup"))
def stg_products(spark, sf):
    return staging.stg_products(raw_products(spark, sf, "prod_dup"))


@query("safe_cast_numeric", duck(f"SELECT _id, {NUMERIC} AS price FROM ev", "ev"))
def safe_cast_numeric(spark, sf):
    return view(spark, sf, "ev").select("_id", c.safe_decimal("price").alias("price"))


@query(
    "nullif_empty",
    duck(
        """SELECT CAST(count(nullif(user_id_db, '')) AS BIGINT) AS user_id_db, CAST(count(nullif(email_address, '')) AS BIGINT) AS email_address,
          CAST(count(nullif(product_id, '')) AS BIGINT) AS product_id, CAST(count(nullif(currency, '')) AS BIGINT) AS currency,
          CAST(count(nullif(order_id, '')) AS BIGINT) AS order_id FROM ev""",
        "ev",
    ),
)
def nullif_empty(spark, sf):
    names = ["user_id_db", "email_address", "product_id", "currency", "order_id"]
    return c.blanks_to_null(view(spark, sf, "ev"), names).agg(*[F.count(n).alias(n) for n in names])


def _case(rules: tuple[agents.AgentRule, ...], default: str, alias: str) -> str:
    """The rules as SQL: the label of the first one that fits."""
    branches = []
    for rule in rules:
        found = " OR ".join(f"contains(user_agent, '{t}')" for t in rule.any_of)
        tests = [f"({found})", *(f"NOT contains(user_agent, '{t}')" for t in rule.none_of)]
        branches.append(f"WHEN {' AND '.join(tests)} THEN '{rule.label}'")
    return f"CASE {' '.join(branches)} ELSE '{default}' END AS {alias}"


AGENT = ", ".join(
    _case(rules, default, alias)
    for rules, default, alias in (
        (agents.DEVICE_RULES, "Desktop", "device_category"), (agents.BROWSER_RULES, "Other", "browser_name"), (agents.SYSTEM_RULES, "Other", "operating_system"),
    )
)


@query(
    "parse_user_agent",
    duck(f"SELECT device_category, browser_name, operating_system, CAST(count(*) AS BIGINT) AS n FROM (SELECT {AGENT} FROM ev) GROUP BY ALL", "ev"),
)
def parse_user_agent(spark, sf):
    parsed = view(spark, sf, "ev").select(
        agents.device_category("user_agent").alias("device_category"),
        agents.browser_name("user_agent").alias("browser_name"),
        agents.operating_system("user_agent").alias("operating_system"),
    )
    return parsed.groupBy(*parsed.columns).agg(F.count("*").alias("n"))


@query(
    "customer_natural_key",
    duck("SELECT _id, coalesce(nullif(user_id_db, ''), device_id) AS customer_natural_key FROM ev WHERE coalesce(nullif(user_id_db, ''), device_id) IS NOT NULL", "ev"),
)
def customer_natural_key(spark, sf):
    ev = view(spark, sf, "ev")
    keyed = ev.select("_id", c.natural_key(c.blank_to_null("user_id_db"), "device_id").alias("customer_natural_key"))
    return keyed.where(F.col("customer_natural_key").isNotNull())


@query(
    "parse_locale_price",
    duck(
        "SELECT event_id, CASE WHEN l_linenumber % 4 = 0 AND unit_cents IS NOT NULL THEN CAST(unit_cents AS DOUBLE) / 100 ELSE CAST(unit_cents AS DOUBLE) / 100 END AS price FROM checkout",
        "checkout",
    ),
)
def parse_locale_price(spark, sf):
    """Prices written in four styles give the same number."""
    return view(spark, sf, "checkout").select("event_id", c.parse_locale_price("price_text").alias("price"))


@query(
    "email_domain",
    duck(
        """SELECT CASE WHEN email_address = '' THEN 'Guest' ELSE nullif(regexp_extract(email_address, '@(.+)$', 1), '') END AS domain,
          CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY 1""",
        "ev",
    ),
)
def email_domain(spark, sf):
    domain = F.when(F.col("email_address") == "", "Guest").otherwise(c.email_domain("email_address"))
    return view(spark, sf, "ev").groupBy(domain.alias("domain")).agg(F.count("*").alias("n"))


@query(
    "purchase_segment",
    """SELECT segment, CAST(count(*) AS BIGINT) AS customers FROM (SELECT o_custkey, CASE WHEN count(*) = 1 THEN 'One-time'
      WHEN count(*) BETWEEN 2 AND 5 THEN 'Repeat' ELSE 'Loyal' END AS segment FROM orders GROUP BY 1) GROUP BY 1""",
)
def purchase_segment(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"))
    return per.groupBy(c.purchase_segment("n").alias("segment")).agg(F.count("*").alias("customers"))


@query(
    "clean_url",
    duck(
        """SELECT CASE event_id % 6 WHEN 0 THEN replace(current_url, 'utm_source=feed&', '') WHEN 2 THEN replace(current_url, '?fbclid=x', '')
          ELSE current_url END AS url, CAST(count(*) AS BIGINT) AS n FROM ev GROUP BY 1
        UNION ALL SELECT CASE WHEN contains(url, '?utm_source=feed') THEN replace(url, '?utm_source=feed', '') ELSE replace(url, '&ref=x', '') END, 1 FROM pages""",
        "ev",
    ).replace(", 1 FROM pages", ", CAST(1 AS BIGINT) FROM pages"),
)
def clean_url(spark, sf):
    """Tracking parameters removed from event and page addresses."""
    events = view(spark, sf, "ev").groupBy(urls.clean_url("current_url").alias("url")).agg(F.count("*").alias("n"))
    pages = table(spark, sf, "pages").select(urls.clean_url("url").alias("url"), F.lit(1).cast("bigint").alias("n"))
    return events.unionByName(pages)


@query(
    "checkout_success",
    duck(
        f"""SELECT _id AS event_id, CAST(store_id AS BIGINT) AS store_id, order_id, {AGENT} FROM ev
        WHERE collection = 'checkout_success' AND order_id <> ''""",
        "ev",
    ),
)
def checkout_success(spark, sf):
    """Completed orders with parsed device, out of the raw events."""
    staged = staging.stg_events(raw_events(spark, sf))
    done = intermediate.checkout_success(staged)
    return done.select("event_id", "store_id", "order_id", "device_category", "browser_name", "operating_system")


ITEMS = """SELECT event_id, CAST(l_partkey AS VARCHAR) AS product_id, quantity, unit_cents AS cents, symbol, 0 AS pos FROM checkout WHERE l_linenumber <> 7
UNION ALL SELECT event_id, CAST(l_partkey + 1 AS VARCHAR), 1, unit_cents // 2, 'c6', 1 FROM checkout WHERE l_linenumber = 3
UNION ALL SELECT event_id, CAST(l_partkey AS VARCHAR), 1, 1, symbol, 1 FROM checkout WHERE l_linenumber = 5"""


@query(
    "explode_cart",
    duck(
        "SELECT event_id, product_id, CAST(quantity AS BIGINT) AS quantity, symbol, CAST(cents AS DOUBLE) / 100 AS price FROM items",
        "checkout",
        items=ITEMS,
    ),
)
def explode_cart(spark, sf):
    """Cart entries as rows; empty carts vanish."""
    lines = intermediate.explode_cart(intermediate.checkout_success(staged_checkouts(spark, sf)))
    return lines.select(
        "event_id", "product_id", "quantity", F.col("transaction_currency_symbol").alias("symbol"),
        F.col("transaction_price").alias("price"),
    )


# One line per event and product: the rate with the lowest priority, then the dearer line.
PICKED = """SELECT i.*, coalesce(currency_code, 'UNKNOWN') AS code, coalesce(rate_to_usd, 1) AS rate
FROM (SELECT DISTINCT * FROM items) i JOIN (SELECT DISTINCT event_id, current_url FROM checkout) USING (event_id)
LEFT JOIN fx ON symbol = currency_symbol AND (url_pattern = '' OR current_url LIKE url_pattern)
QUALIFY row_number() OVER (PARTITION BY event_id, product_id
  ORDER BY coalesce(priority, 999), currency_code NULLS FIRST, rate_to_usd NULLS FIRST, cents DESC, quantity DESC, symbol) = 1"""


@query(
    "fx_pick_by_priority",
    duck(
        """SELECT event_id, product_id, CAST(quantity AS BIGINT) AS quantity, CAST(cents AS DOUBLE) / 100 AS price, code AS currency_code,
          CAST(rate AS DOUBLE) AS rate_to_usd FROM picked""",
        "checkout",
        "fx",
        items=ITEMS,
        picked=PICKED,
    ),
)
def fx_pick_by_priority(spark, sf):
    """Rate by symbol and page address, best priority first."""
    from orderloom.operators.lookups import fx_pick

    lines = intermediate.explode_cart(intermediate.checkout_success(distinct_checkouts(spark, sf)))
    picked = fx_pick(
        lines, view(spark, sf, "fx"), ["event_id", "product_id"],
        [F.col("transaction_price").desc(), F.col("quantity").desc(), "transaction_currency_symbol"],
    )
    return picked.select(
        "event_id", "product_id", "quantity", F.col("transaction_price").alias("price"),
        F.col("transaction_currency_code").alias("currency_code"), F.col("transaction_rate_to_usd").alias("rate_to_usd"),
    )


@query(
    "cart_items",
    duck(
        f"""SELECT p.event_id, p.product_id, CAST(p.quantity AS BIGINT) AS quantity, CAST(p.cents AS DOUBLE) / 100 AS transaction_price,
          p.code AS transaction_currency_code, CAST(p.rate AS DOUBLE) AS transaction_rate_to_usd, country_name, region_name, city_name,
          coalesce(user_id_db, device_id) AS customer_natural_key, device_category, browser_name, operating_system
        FROM picked p JOIN (SELECT DISTINCT event_id, user_id_db, device_id, ip_address, {AGENT} FROM checkout) c USING (event_id)
        LEFT JOIN stg_ip g ON c.ip_address = g.ip_address""",
        "checkout",
        "fx",
        "geo",
        items=ITEMS,
        picked=PICKED,
        stg_ip=STG_IP,
    ),
)
def cart_items(spark, sf):
    """Priced cart lines with place, currency and customer key."""
    places = staging.stg_ip_locations(raw_ip_locations(spark, sf), tie_break=["c_custkey"])
    items = intermediate.cart_items(intermediate.checkout_success(distinct_checkouts(spark, sf)), places, view(spark, sf, "fx"), unique_events=True)
    return items.select(
        "event_id", "product_id", "quantity", "transaction_price", "transaction_currency_code", "transaction_rate_to_usd",
        "country_name", "region_name", "city_name", "customer_natural_key", "device_category", "browser_name", "operating_system",
    )


RANGES = """SELECT CAST(n_nationkey AS BIGINT) * 150994944 + 184549376 AS start_ip, CAST(n_nationkey AS BIGINT) * 150994944 + 318767103 AS end_ip,
  CASE WHEN n_nationkey % 8 = 3 THEN '-' ELSE n_name END AS country, r_name AS region,
  CASE WHEN n_nationkey % 2 = 0 THEN '-' ELSE 'city ' || CAST(n_nationkey AS STRING) END AS city
FROM @nation@ JOIN @region@ ON n_regionkey = r_regionkey"""


@query(
    "ip_range_lookup",
    duck(
        """SELECT DISTINCT ip, nullif(r.country, '-') AS country, nullif(r.region, '-') AS region, nullif(r.city, '-') AS city
        FROM (SELECT ip, CASE WHEN regexp_matches(ip, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') THEN
          CAST(split_part(ip, '.', 1) AS BIGINT) * 16777216 + CAST(split_part(ip, '.', 2) AS BIGINT) * 65536
          + CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT) END AS num
          FROM (SELECT ip FROM geo UNION SELECT ip FROM ev)) LEFT JOIN ranges r ON num BETWEEN r.start_ip AND r.end_ip""",
        "geo",
        "ev",
        ranges=RANGES.replace("@", ""),
    ),
)
def ip_range_lookup(spark, sf):
    """Country, region and city by address range, without comparing all pairs."""
    ips = view(spark, sf, "geo").select("ip").unionByName(view(spark, sf, "ev").select("ip"))
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    nation.createOrReplaceTempView("ip_nation")
    region.createOrReplaceTempView("ip_region")
    ranges = spark.sql(RANGES.replace("@nation@", "ip_nation").replace("@region@", "ip_region"))
    return locate_ips(ips, ranges)


# Addresses of both families. The book's IPv6 addresses end in a number of up to four digits, read as hex digits.
MIXED = """SELECT '11.0.0.0' AS start_ip, '60.255.255.255' AS end_ip, 'four' AS country, '-' AS region, 'a' AS city
UNION ALL SELECT '::ffff:100.0.0.0', '::ffff:6eff:ffff', 'mapped', 'r', '-'
UNION ALL SELECT '2001:db8::', '2001:db8::3ff', 'six', 'low', 'b' UNION ALL SELECT '2001:DB8:0:0:0:0:0:400', '2001:db8::9999', 'six', 'high', 'c'
UNION ALL SELECT '2001:db9::', '2001:db9:ffff:ffff:ffff:ffff:ffff:ffff', 'seven', '-', '-'"""


@query(
    "ip_range_lookup_mixed",
    duck(
        """SELECT ip, CASE WHEN six BETWEEN 0 AND 39321 THEN 'six' WHEN first BETWEEN 11 AND 60 THEN 'four' WHEN first BETWEEN 100 AND 110 THEN 'mapped' END AS country,
          CASE WHEN six BETWEEN 0 AND 1023 THEN 'low' WHEN six BETWEEN 1024 AND 39321 THEN 'high' WHEN first BETWEEN 100 AND 110 THEN 'r' END AS region,
          CASE WHEN six BETWEEN 0 AND 1023 THEN 'b' WHEN six BETWEEN 1024 AND 39321 THEN 'c' WHEN first BETWEEN 11 AND 60 THEN 'a' END AS city
        FROM (SELECT ip, CASE WHEN regexp_matches(ip, '^2001:db8::[0-9]{1,4}$') THEN CAST('0x' || split_part(ip, '::', 2) AS BIGINT) END AS six,
          CASE WHEN regexp_matches(ip, '^[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+$') THEN CAST(split_part(ip, '.', 1) AS BIGINT) END AS first
          FROM (SELECT ip FROM geo UNION SELECT ip FROM ev))""",
        "geo",
        "ev",
    ),
)
def ip_range_lookup_mixed(spark, sf):
    """Addresses of both families against one table of ranges, some of them wide."""
    ips = view(spark, sf, "geo").select("ip").unionByName(view(spark, sf, "ev").select("ip"))
    return locate_ips(ips, spark.sql(MIXED))


@query(
    "join_null_as_empty",
    duck(
        """SELECT coalesce(a.region, '') AS region, coalesce(a.city, '') AS city, CAST(count(*) AS BIGINT) AS n
        FROM geo a JOIN (SELECT DISTINCT nullif(region, '') AS region, city FROM geo WHERE country <> '') b
          ON coalesce(a.region, '') = coalesce(b.region, '') AND coalesce(a.city, '') = coalesce(b.city, '') GROUP BY 1, 2""",
        "geo",
    ),
)
def join_null_as_empty(spark, sf):
    """Places joined so that NULL and '' are one value."""
    from orderloom.operators.lookups import null_as_empty

    geo = view(spark, sf, "geo")
    known = geo.where(F.col("country") != "").select(
        c.blank_to_null("region").alias("_region"), F.col("city").alias("_city")
    ).distinct()
    joined = geo.join(known, null_as_empty(F.col("region"), F.col("_region")) & null_as_empty(F.col("city"), F.col("_city")))
    return joined.groupBy(
        F.coalesce("region", F.lit("")).alias("region"), F.coalesce("city", F.lit("")).alias("city")
    ).agg(F.count("*").alias("n"))


@query(
    "union_all_filter",
    "SELECT o_custkey AS id FROM orders",
)
def union_all_filter(spark, sf):
    """Rows plus a NULL row, then only rows with an id."""
    ids = table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    blank = spark.range(1).select(F.lit(None).cast("bigint").alias("id"))
    return ids.unionByName(blank).where(F.col("id").isNotNull())
