"""Product data in the HTML of a page, read with built-in regular expressions and JSON functions."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.documents import parsed_json

ATTRIBUTE = 'struct<value:string>'
# Fields of the embedded product object that are used.
EMBEDDED_SCHEMA = (
    "product_id string, name string, sku string, attribute_set_id string, attribute_set string, type_id string,"
    " product_type string, product_type_value string, price string, min_price string, max_price string,"
    " min_price_format string, max_price_format string, gold_weight string, none_metal_weight string,"
    " fixed_silver_weight string, material_design string, qty string, collection string, collection_id string,"
    " category string, category_name string, store_code string, gender string,"
    " platinum_palladium_info_in_alloy string, bracelet_without_chain string,"
    " show_popup_quantity_eternity string, visible_contents string, configure_mode string,"
    " included_chain_weight string, product_price string, media_image string, media_video string,"
    " attributes string"
)
COPIED_FIELDS = (
    "sku", "attribute_set_id", "attribute_set", "type_id", "product_type", "product_type_value",
    "price", "min_price", "max_price", "min_price_format", "max_price_format",
    "gold_weight", "none_metal_weight", "fixed_silver_weight", "material_design", "qty",
    "collection", "collection_id", "category", "category_name", "store_code", "gender",
    "platinum_palladium_info_in_alloy", "bracelet_without_chain", "show_popup_quantity_eternity",
    "visible_contents", "configure_mode", "included_chain_weight",
)
LINKED_SCHEMA = (
    "mainEntity struct<name:string,sku:string,category:string,brand:string,offers:string,"
    "additionalProperty:string>"
)
LINKED_NOTE = "Fallback: JSON-LD structured data"
NO_DATA_MESSAGE = "react_data not found, HTML fallback also failed"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _found(text: Column, pattern: str, may_be_empty: bool = False) -> Column:
    """Group 1 of the first match, NULL without one. Only a group that can be empty needs a second look at the text."""
    if may_be_empty:
        return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, 1))
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


@F.pandas_udf(T.StringType())
def _decoded(texts: pd.Series) -> pd.Series:
    """All numeric and named character references; the names are those of the HTML standard."""
    return texts.map(html.unescape, na_action="ignore")


def plain_text(fragment: Column) -> Column:
    """Text of an HTML fragment: tags removed, character references decoded, ends trimmed."""
    text = _decoded(F.regexp_replace(fragment, r"(?s)<!--.*?-->|<[^>]*>", ""))
    return F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def product_name(source: Column | str) -> Column:
    """Open Graph title, else the first span inside an h1, else the first h1."""
    page = _col(source)
    tag = F.coalesce(
        _found(page, r"""(?is)(<meta\b[^>]*\bproperty\s*=\s*["']?og:title["'\s/>][^>]*>)"""),
        _found(page, r"""(?is)(<meta\b[^>]*\bproperty\s*=\s*og:title>)"""),
    )
    title = F.coalesce(_found(tag, r'(?is)\bcontent\s*=\s*"([^"]+)"'), _found(tag, r"(?is)\bcontent\s*=\s*'([^']+)'"))
    span = _found(page, r"(?is)<h1\b[^>]*>(?:(?!</h1>).)*?<span\b[^>]*>(.*?)</span>", True)
    heading = _found(page, r"(?is)<h1\b[^>]*>(.*?)</h1>", True)
    return F.coalesce(plain_text(title), plain_text(span), plain_text(heading))


def embedded_json(html: Column | str) -> Column:
    """Text of the object assigned to `react_data` in a script; NULL when missing or not valid JSON."""
    text = _found(_col(html), r"(?s)var\s+react_data\s*=\s*(\{.*?\});")
    return F.when(parsed_json(text).isNotNull(), text)


def embedded_fields(doc: Column) -> dict[str, Column]:
    """Flat product columns of the embedded object parsed with EMBEDDED_SCHEMA."""
    price = F.from_json(doc["product_price"], "currencyCode string, currentTax string")
    images = F.from_json(doc["media_image"], "images array<struct<large_image_url:string>>")
    videos = F.from_json(doc["media_video"], "videos array<struct<url:string>>")
    attributes = F.from_json(doc["attributes"], f"gender {ATTRIBUTE}, massiv {ATTRIBUTE}")
    return {
        "product_name": doc["name"],
        **{name: doc[name] for name in COPIED_FIELDS},
        "currency_code": price["currencyCode"],
        "tax_rate": price["currentTax"],
        "primary_image_url": F.get(images["images"], F.lit(0))["large_image_url"],
        "primary_video_url": F.get(videos["videos"], F.lit(0))["url"],
        "gender_label": attributes["gender"]["value"],
        "is_solid": attributes["massiv"]["value"],
    }


def linked_json(html: Column | str) -> Column:
    """Text of the structured-data script of a page."""
    tag = r"""<script\b(?=[^>]*\bid\s*=\s*["']structured-data["'])(?=[^>]*\btype\s*=\s*["']application/ld\+json["'])"""
    return _found(_col(html), rf"(?is){tag}[^>]*>(.*?)</script>", True)


def linked_fields(item: Column) -> dict[str, Column]:
    """Product columns of the `mainEntity` parsed with LINKED_SCHEMA."""
    offers = F.from_json(item["offers"], "price string, priceCurrency string, availability string")
    extras = F.from_json(item["additionalProperty"], "array<struct<name:string,value:string>>")
    extras = F.filter(extras, lambda p: (p["name"] != "") & (p["value"] != ""))
    pairs = F.transform(extras, lambda p: F.struct(F.lower(p["name"]).alias("name"), p["value"].alias("value")))
    # A name that occurs twice keeps its last value.
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["name"] == p["name"]),
    )
    return {
        "product_name": item["name"],
        "sku": item["sku"],
        "category_name": item["category"],
        "price": offers["price"],
        "currency_code": offers["priceCurrency"],
        "availability": offers["availability"],
        "brand": F.from_json(item["brand"], "name string")["name"],
        "data_source": F.lit("json_ld_fallback"),
        "note": F.lit(LINKED_NOTE),
        "additional_properties": F.when(F.size(last) > 0, F.map_from_entries(last)),
    }


def linked_is_product(item: Column) -> Column:
    """A product needs a name and a sku."""
    return F.coalesce((item["name"] != "") & (item["sku"] != ""), F.lit(False))
