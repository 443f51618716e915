"""URL cleaning and IP address text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Query parameters that only track the visitor.
TRACKING_PARAMETERS = (
    "fbclid", "utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term",
    "itm_source", "itm_medium", "itm_campaign", "itm_content",
    "gclid", "gclsrc", "_ga", "mc_cid", "mc_eid",
    "msclkid", "zanpid", "aff_id", "ref", "source",
)

IPV4_PATTERN = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}$"
PRIVATE_PATTERN = r"^(10\.|172\.(1[6-9]|2[0-9]|3[01])\.|192\.168\.)"
LOOPBACK_PATTERN = r"^127\."


def _form_text(c: Column) -> Column:
    """Decode and encode again as form text, so that equal values are spelled alike."""
    plain = F.coalesce(F.try_url_decode(c), c)
    return F.replace(F.replace(F.url_encode(plain), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def clean_url(url: Column | str, drop: Sequence[str] = TRACKING_PARAMETERS) -> Column:
    """Remove tracking parameters. Other parameters stay, repeated names next to each other."""
    text = F.col(url) if isinstance(url, str) else url
    body = F.regexp_extract(text, r"^([^?#]*)", 1)
    query = F.regexp_extract(text, r"^[^?#]*\?([^#]*)", 1)
    fragment = F.regexp_extract(text, r"^[^#]*(#.+)$", 1)
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    pairs = F.transform(
        pairs,
        lambda p: F.struct(
            F.coalesce(F.try_url_decode(F.substring_index(p, "=", 1)), F.substring_index(p, "=", 1)).alias("name"),
            F.concat(
                _form_text(F.substring_index(p, "=", 1)),
                F.lit("="),
                _form_text(F.regexp_extract(p, "^[^=]*=(.*)$", 1)),
            ).alias("text"),
        ),
    )
    kept = F.filter(pairs, lambda p: ~p["name"].isin(*drop))
    names = F.array_distinct(F.transform(kept, lambda p: p["name"]))
    grouped = F.flatten(F.transform(names, lambda n: F.filter(kept, lambda p: p["name"] == n)))
    rebuilt = F.array_join(F.transform(grouped, lambda p: p["text"]), "&")
    return F.when(query == "", F.concat(body, fragment)).otherwise(
        F.concat(body, F.when(rebuilt == "", "").otherwise(F.concat(F.lit("?"), rebuilt)), fragment)
    )


def url_host(url: Column | str) -> Column:
    """Host and port: the text between '//' and the next '/'."""
    text = F.col(url) if isinstance(url, str) else url
    return F.get(F.split(text, "/"), F.lit(2))


def is_ipv4(ip: Column | str) -> Column:
    return (F.col(ip) if isinstance(ip, str) else ip).rlike(IPV4_PATTERN)


def is_ipv6(ip: Column | str) -> Column:
    return (F.col(ip) if isinstance(ip, str) else ip).contains(":")


def is_private_ip(ip: Column | str) -> Column:
    return (F.col(ip) if isinstance(ip, str) else ip).rlike(PRIVATE_PATTERN)


def is_loopback_ip(ip: Column | str) -> Column:
    return (F.col(ip) if isinstance(ip, str) else ip).rlike(LOOPBACK_PATTERN)


def ipv4_number(ip: Column | str) -> Column:
    """Dotted IPv4 text as a number; NULL for anything else."""
    text = F.col(ip) if isinstance(ip, str) else ip
    parts = F.transform(F.split(text, r"\."), lambda p: p.try_cast("bigint"))
    valid = text.rlike(IPV4_PATTERN) & F.forall(parts, lambda p: p.between(0, 255))
    return F.when(valid, F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, p: acc * 256 + p))


#: IPv4 addresses inside the address space of IPv6 (::ffff:0:0/96).
IPV4_PREFIX = "0" * 20 + "ffff"


def _hex_groups(text: Column) -> Column:
    """Groups of hex digits between colons; none of an empty text."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(text, ":"))


def address_key(ip: Column | str) -> Column:
    """An IPv4 or IPv6 address as 32 hex digits, whose order as text is that of the numbers; NULL for anything else.

    IPv4 addresses lie at ::ffff:0:0/96, in either spelling. A zone (%eth0) is not part of the number.
    """
    text = F.col(ip) if isinstance(ip, str) else ip
    v4 = ipv4_number(text)
    text = F.lower(F.substring_index(text, "%", 1))
    # a dotted end is two groups
    dotted = ipv4_number(F.substring_index(text, ":", -1))
    ends = F.lpad(F.lower(F.hex(dotted)), 8, "0")
    text = F.when(dotted.isNotNull(), F.concat(F.regexp_replace(text, r"[^:]*$", ""), F.substring(ends, 1, 4), F.lit(":"), F.substring(ends, 5, 4))).otherwise(text)
    halves = F.split(text, "::")
    open_end = F.size(halves) == 2
    head, tail = _hex_groups(F.get(halves, F.lit(0))), F.when(open_end, _hex_groups(F.get(halves, F.lit(1)))).otherwise(F.array().cast("array<string>"))
    gap = F.lit(8) - F.size(head) - F.size(tail)
    zeros = F.when(open_end & (gap > 0), F.array_repeat(F.lit("0"), gap)).otherwise(F.array().cast("array<string>"))
    groups = F.concat(head, zeros, tail)
    valid = (F.size(halves) <= 2) & (F.size(groups) == 8) & (~open_end | (gap > 0)) & F.forall(groups, lambda g: g.rlike("^[0-9a-f]{1,4}$"))
    v6 = F.when(text.contains(":") & valid, F.array_join(F.transform(groups, lambda g: F.lpad(g, 4, "0")), ""))
    return F.coalesce(F.concat(F.lit(IPV4_PREFIX), F.lpad(F.lower(F.hex(v4)), 8, "0")), v6)
