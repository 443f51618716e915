"""Column functions on hand-made values."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderloom.sources.jsonl import rejected_lines
from orderloom.functions import agents, calendar, cleaning as c, documents as d, history as h, pages as p, urls


def one(spark, fn, *values, types="string"):
    names = [f"c{i}" for i in range(len(values))]
    schema = ", ".join(f"{n} {types}" for n in names)
    return spark.createDataFrame([values], schema).select(fn(*[F.col(n) for n in names]).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1.234,50", "1234.5"), ("1,234.50", "1234.5"), ("12,5", "12.5"), ("1,234", "1.234"), ("12.5", "12.5"),
        ("12", "12"), ("1.234.567", None), ("abc", None), ("", None), (None, None), ("1.234.567,89", "1234567.89"),
    ],
)
def test_locale_price(spark, text, expected):
    got = one(spark, c.parse_locale_price, text)
    assert got == (None if expected is None else Decimal(expected))


def test_blank_and_sentinels(spark):
    assert one(spark, c.blank_to_null, "") is None
    assert one(spark, lambda x: c.sentinel_to_unknown(x, c.PRODUCT_TYPE_SENTINELS), "--_select_--") == "Unknown"
    assert one(spark, lambda x: c.sentinel_to_unknown(x, c.GENDER_SENTINELS), "FALSE") == "Unknown"
    assert one(spark, lambda x: c.sentinel_to_unknown(x), None) == "Unknown"
    assert one(spark, c.zero_code_to_null, "0") is None
    assert one(spark, c.zero_code_to_null, "12") == "12"
    assert one(spark, lambda x: c.positive_or_null(c.safe_decimal(x)), "0") is None
    assert one(spark, c.dash_to_null, "-") is None


@pytest.mark.parametrize("place, level", [(("a", "b", "c"), 3), ((None, "b", None), 2), (("a", None, None), 1), ((None,) * 3, 0)])
def test_geo_level(spark, place, level):
    assert one(spark, c.geo_completeness, *place) == level


@pytest.mark.parametrize("n, segment", [(1, "One-time"), (2, "Repeat"), (5, "Repeat"), (6, "Loyal")])
def test_segment(spark, n, segment):
    assert one(spark, c.purchase_segment, n, types="bigint") == segment


def test_email_domain_and_percent(spark):
    assert one(spark, c.email_domain, "a@x.com") == "x.com"
    assert one(spark, c.email_domain, "no address") is None
    assert one(spark, c.percent, 603, 60000, types="bigint") == 1.01
    assert one(spark, c.percent, 1, 0, types="bigint") is None
    assert one(spark, c.average, 8905, 1000, types="bigint") == 8.91


@pytest.mark.parametrize(
    "agent, expected",
    [
        ("(iPhone; CPU iPhone OS 13 like Mac OS X) Safari", ("Mobile", "Safari", "macOS")),
        ("(iPad; CPU OS 13 like Mac OS X) Safari", ("Tablet", "Safari", "macOS")),
        ("(Linux; Android 10) Chrome/80 Safari", ("Mobile", "Chrome", "Android")),
        ("(Windows NT 10.0) Chrome/120 Safari Edg/120", ("Desktop", "Edge", "Windows")),
        ("(Windows NT 10.0) Firefox/121", ("Desktop", "Firefox", "Windows")),
        ("iPad app", ("Tablet", "Other", "iOS")),
        ("Linux", ("Desktop", "Other", "Other")),
    ],
)
def test_agents(spark, agent, expected):
    got = one(spark, lambda a: F.array(agents.device_category(a), agents.browser_name(a), agents.operating_system(a)), agent)
    assert tuple(got) == expected


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://s.com/r.html?fbclid=I&alloy=gold", "https://s.com/r.html?alloy=gold"),
        ("https://s.com/r.html?utm_source=fb&utm_campaign=x&stone=diamond", "https://s.com/r.html?stone=diamond"),
        ("https://s.com/r.html", "https://s.com/r.html"),
        ("https://s.com/r?a=1&utm_term=3&b=2&a=3&flag#top", "https://s.com/r?a=1&a=3&b=2&flag=#top"),
        ("https://s.com/?gclid=1", "https://s.com/"),
        ("https://s.com/?q=a+b&r=%C3%A9", "https://s.com/?q=a+b&r=%C3%A9"),
    ],
)
def test_clean_url(spark, url, expected):
    assert one(spark, urls.clean_url, url) == expected


def test_ip_numbers(spark):
    assert one(spark, urls.ipv4_number, "1.2.3.4") == 16909060
    for text in ("300.1.1.1", "::1", "x", None):
        assert one(spark, urls.ipv4_number, text) is None
    assert one(spark, urls.is_private_ip, "172.20.1.1") and not one(spark, urls.is_private_ip, "172.32.1.1")
    assert one(spark, urls.url_host, "https://a.b/c") == "a.b"


NONE6 = (None,) * 6


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, []), ("", []), ("{}", []), ("[]", []), ("5", []), ('"x"', []),
        ('{"alloy":"","diamond":"ruby"}', [(None, "alloy", None, None, None, None), (None, "diamond", None, "ruby", None, None)]),
        ('["x",{"option_id":"1"}]', [("1", None, None, None, None, None)]),
        ('[{"option_label":"alloy","option_id":"105683","value_label":"","value_id":"765253"}]', [("105683", "alloy", "765253", "", None, None)]),
        ('[{"option_label":"s","quality":"A","quality_label":"I"}]', [(None, "s", None, None, "A", "I")]),
    ],
)
def test_normalize_option(spark, text, expected):
    assert [tuple(o) for o in one(spark, d.normalize_option, text)] == expected


def test_array_option_ignores_objects(spark):
    assert one(spark, d.array_option, '{"alloy":"gold"}') == []


def test_json_scalar(spark):
    doc = '{"a":6,"b":"x","c":{"d":1},"e":[1],"f":true,"g":null}'
    got = [one(spark, lambda x, k=k: d.json_scalar(x, f"$.{k}"), doc) for k in "abcefgz"]
    assert got == ["6", "x", None, None, "true", None, None]


@pytest.mark.parametrize(
    "html, name",
    [
        ('<meta property="og:title" content=" Ring "><h1>x</h1>', "Ring"),
        ("<meta content='Band' property='og:title'/>", "Band"),
        ("<h1 class='a'>A <b>x</b><span> B &amp; C </span></h1>", "B & C"),
        ("<h1>A <i>b</i></h1>", "A b"),
        ("<h1>Ring &euro;5 &#8217;x&#x41;&apos; &amp;lt; &nbsp;</h1>", "Ring \u20ac5 \u2019xA' &lt;"),
        ("<p>none</p>", None),
    ],
)
def test_product_name(spark, html, name):
    assert one(spark, p.product_name, html) == name


def test_repeated_keys_keep_the_last_value(spark):
    assert one(spark, lambda x: d.json_scalar(x, "$.a"), '{"a":1,"b":2,"a":3}') == "3"
    assert [tuple(o)[:2] for o in one(spark, d.normalize_option, '[{"option_id":"1","option_id":"2","option_label":"x"}]')] == [("2", "x")]
    page = 'var react_data = {"product_id":1,"product_id":2};'
    assert one(spark, p.embedded_json, page) == '{"product_id":1,"product_id":2}'
    lines = spark.createDataFrame([('{"a":1,"a":2}',), ("[1]",), ("junk",), ("  ",)], "line string")
    assert sorted(r.line for r in rejected_lines(lines).collect()) == ["[1]", "junk"]


def test_embedded_json(spark):
    good = '<script> var react_data = {"product_id": 123, "name": "Gold Ring", "price": 99.99}; </script>'
    assert '"Gold Ring"' in one(spark, p.embedded_json, good)
    assert one(spark, p.embedded_json, "<html></html>") is None
    assert one(spark, p.embedded_json, "var react_data = {invalid json, missing quotes};") is None


def test_row_hash(spark):
    assert one(spark, lambda x: h.row_hash([x]), None) == "d41d8cd98f00b204e9800998ecf8427e"
    assert one(spark, lambda a, b: h.row_hash([a, b]), "a", "b") == one(spark, lambda a, b: h.row_hash([a, b]), "ab", None)
    assert one(spark, lambda a, b: h.row_hash([a, b], "|"), "a", "b") != one(spark, lambda a, b: h.row_hash([a, b], "|"), "ab", None)


def test_calendar_year_borders(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2015-01-01', DATE'2030-12-31')) AS d")
    cols = calendar.calendar_columns(F.col("d"))
    assert len(cols) == 34
    df = days.select(*[v.alias(k) for k, v in cols.items()])
    assert df.count() == 5844
    leap = df.where("full_date = DATE'2020-02-29'").first()
    assert (leap.is_leap_year, leap.week, leap.iso_week, leap.is_last_day_of_month) == (True, 8, 9, True)
    first = df.where("full_date = DATE'2016-01-01'").first()
    assert (first.week, first.iso_week, first.iso_year, first.day_of_week) == (0, 53, 2015, 6)


def test_address_keys_match_the_standard_library(spark):
    import ipaddress
    import random

    rng = random.Random(4)
    texts = [str(ipaddress.IPv6Address(rng.getrandbits(128) >> rng.choice([0, 16, 64, 120]))) for _ in range(60)]
    texts += [ipaddress.IPv6Address(rng.getrandbits(128)).exploded.upper() for _ in range(10)] + [str(ipaddress.IPv4Address(rng.getrandbits(32))) for _ in range(20)]
    texts += ["::", "::1", "1::", "fe80::1%eth0", "::ffff:10.1.2.3", "64:ff9b::1.2.3.4", "1:2:3:4:5:6:7::", "1:2:3:4:5:6:1.2.3.4"]
    wrong = ["", ":", ":::", "1::2::3", "1:2:3:4:5:6:7", "1:2:3:4:5:6:7:8:9", "12345::", "g::", "1.2.3", "1.2.3.4.5", "256.1.1.1", "::1.2.3", "1:2:3:4:5:6:7:8::", "x"]
    df = spark.createDataFrame([(t,) for t in [*texts, *wrong, None]], "ip string").withColumn("key", urls.address_key("ip"))
    for r in df.collect():
        if r.ip in texts:
            a = ipaddress.ip_address(r.ip.split("%")[0])
            number = int(a) if a.version == 6 else int(ipaddress.IPv6Address(f"::ffff:{a}"))
            assert r.key == f"{number:032x}", r.ip
        else:
            assert r.key is None, r.ip
