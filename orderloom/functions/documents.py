"""Schemaless JSON documents: scalar reads, and product options of varying shape."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

OPTION_FIELDS = ("option_id", "option_label", "value_id", "value_label", "quality", "quality_label")
CART_OPTION_FIELDS = ("option_id", "option_label", "value_id", "value_label")
OPTION_TYPE = "array<struct<" + ",".join(f"{f}:string" for f in OPTION_FIELDS) + ">>"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parsed_json(text: Column | str) -> Column:
    """JSON text as a variant, NULL when it is not valid. Of a repeated key the last value counts.

    Spark rejects repeated keys unless the session allows them; the setting is read when the expression is analysed.
    """
    session = SparkSession.getActiveSession()
    if session is not None:
        session.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return F.try_parse_json(_col(text))


def json_scalar(document: Column | str, path: str) -> Column:
    """Scalar at `path` as text; NULL for a missing value, an object or an array."""
    def scalar(value: Column) -> Column:
        kind = F.schema_of_variant(value)
        return F.when(
            ~(kind.startswith("OBJECT") | kind.startswith("ARRAY")), F.try_variant_get(value, "$", "string")
        )

    # an array of one, so that the document is parsed once for kind and text
    return F.transform(F.array(F.try_variant_get(parsed_json(document), path, "variant")), scalar)[0]


def looks_nested(texts: list[Column]) -> Column:
    """TRUE when one of the texts starts like a JSON object or array."""
    return F.exists(F.array(*texts), lambda t: F.coalesce(t.startswith("{") | t.startswith("["), F.lit(False)))


def only_scalar(text: Column, document: Column, path: str) -> Column:
    """`text` read by `from_json` at `path`, or NULL when the document holds an object or array there.

    `from_json` hands nested values over as JSON text. `document` is the parsed document of rows in which
    some text looks like that, and NULL for all other rows, which skip the check.
    """
    kind = F.schema_of_variant(F.try_variant_get(document, path, "variant"))
    return F.when(document.isNull() | ~kind.rlike("^(OBJECT|ARRAY)"), text)


def _array_options(text: Column) -> Column:
    items = F.try_variant_get(parsed_json(text), "$", "array<variant>")
    objects = F.filter(items, lambda v: F.schema_of_variant(v).startswith("OBJECT"))
    return F.transform(
        objects,
        lambda v: F.struct(*[F.try_variant_get(v, f"$.{f}", "string").alias(f) for f in OPTION_FIELDS]),
    )


def _object_options(text: Column) -> Column:
    entries = F.map_entries(F.from_json(text, "map<string,string>"))
    missing = F.lit(None).cast("string")
    return F.transform(
        entries,
        lambda e: F.struct(
            missing.alias("option_id"),
            e["key"].alias("option_label"),
            missing.alias("value_id"),
            F.nullif(e["value"], F.lit("")).alias("value_label"),
            missing.alias("quality"),
            missing.alias("quality_label"),
        ),
    )


def normalize_option(text: Column | str) -> Column:
    """JSON text of an option field as an array of six-field structs.

    An array keeps its objects, an object becomes one row per key, anything else is empty.
    """
    t = F.trim(_col(text))
    empty = F.array().cast(OPTION_TYPE)
    return F.coalesce(
        F.when(t.startswith("["), _array_options(t)).when(t.startswith("{"), _object_options(t)), empty
    )


def array_option(text: Column | str) -> Column:
    """Like `normalize_option`, but an object counts as empty (the strict load rule)."""
    t = F.trim(_col(text))
    return F.coalesce(F.when(t.startswith("["), _array_options(t)), F.array().cast(OPTION_TYPE))


def cart_option(options: Column) -> Column:
    """Options inside a cart line: four fields, ids as numbers."""
    return F.transform(
        options,
        lambda o: F.struct(
            o["option_id"].cast("bigint").alias("option_id"),
            o["option_label"].alias("option_label"),
            o["value_id"].cast("bigint").alias("value_id"),
            o["value_label"].alias("value_label"),
        ),
    )
