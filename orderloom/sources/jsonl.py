"""JSON-lines files: one text column, one parse per row, typed nested columns out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.documents import array_option, cart_option, looks_nested, normalize_option, only_scalar, parsed_json
from orderloom.sources import schemas

EMPTY_AS_BLANK = ("user_id_db", "email_address")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Lines of text or .gz files. A .gz file is one task, so load many files rather than few large ones."""
    return spark.read.text(paths).select(F.col("value").alias("line"))


def not_blank(lines: DataFrame, column: str = "line") -> DataFrame:
    return lines.where(F.trim(F.col(column)) != "")


def _text_schema(table: str) -> T.StructType:
    fields = [n for n in schemas.TABLES[table] if n != "ingested_at"]
    return T.StructType([T.StructField(n, T.StringType()) for n in fields])


def _cart(text: Column, normalise: bool, cast) -> Column:
    raw = F.from_json(
        text, "array<struct<product_id:string,amount:string,price:string,currency:string,option:string>>"
    )
    options = normalize_option if normalise else array_option
    lines = F.transform(
        raw,
        lambda c: F.struct(
            cast(c["product_id"], "bigint").alias("product_id"),
            cast(c["amount"], "bigint").alias("amount"),
            c["price"].alias("price"),
            c["currency"].alias("currency"),
            cart_option(options(c["option"])).alias("option"),
        ),
    )
    return F.coalesce(lines, F.array().cast(schemas.CART))


def parse_lines(
    lines: DataFrame,
    table: str,
    loaded_at: Column | None = None,
    strict: bool = True,
    normalise_options: bool = True,
) -> DataFrame:
    """Typed rows of one raw table from a `line` column.

    `strict` fails the job on malformed JSON or a value that does not fit its type;
    otherwise such values become NULL (use `rejected_lines` to keep the bad lines).
    `normalise_options` turns option objects into arrays; without it they load as empty.
    """
    mode = "FAILFAST" if strict else "PERMISSIVE"

    def cast(c: Column, kind: str) -> Column:
        return c.cast(kind) if strict else c.try_cast(kind)

    line = F.col("line")
    scalars = [
        n for n, k in schemas.TABLES[table].items() if n != "ingested_at" and not k.startswith("array")
    ]
    parsed = (
        not_blank(lines)
        .select(line, F.from_json(line, _text_schema(table), {"mode": mode}).alias("d"))
        .withColumn("v", F.when(looks_nested([F.col(f"d.{n}") for n in scalars]), parsed_json(line)))
    )
    out: list[Column] = []
    for name, kind in schemas.TABLES[table].items():
        raw = F.col(f"d.{name}") if name != "ingested_at" else None
        if name == "ingested_at":
            value = F.current_timestamp() if loaded_at is None else loaded_at
        elif name == "option":
            value = normalize_option(raw) if normalise_options else array_option(raw)
        elif name == "cart_products":
            value = _cart(raw, normalise_options, cast)
        elif kind == "array<string>":
            value = F.coalesce(F.from_json(raw, kind), F.array().cast(kind))
        else:
            text = only_scalar(raw, F.col("v"), f"$.{name}")
            value = text if kind == "string" else cast(text, kind)
            if name in EMPTY_AS_BLANK:
                value = F.coalesce(value, F.lit(""))
        out.append(value.alias(name))
    return parsed.select(*out)


def load_events(lines: DataFrame, **options) -> DataFrame:
    return parse_lines(lines, "events", **options)


def load_products(lines: DataFrame, **options) -> DataFrame:
    return parse_lines(lines, "products", **options)


def load_ip_locations(lines: DataFrame, **options) -> DataFrame:
    return parse_lines(lines, "ip_locations", **options)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """Lines that are not JSON objects."""
    return split_rejected(lines)[1]


def split_rejected(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(lines that are JSON objects, the others); blank lines are in neither. Strict loading is safe on the first."""
    # valid JSON that begins with a brace is an object; the schema of the whole document is not needed for that
    fine = F.coalesce(parsed_json("line").isNotNull() & F.col("line").rlike(r"^\s*\{"), F.lit(False))
    return not_blank(lines).where(fine), not_blank(lines).where(~fine)


def append_rows(rows: DataFrame, path: str) -> None:
    """Append a load to a raw table. What is delivered twice is stored twice; staging keeps the latest."""
    rows.write.mode("append").parquet(path)


def json_array_to_lines(
    spark: SparkSession, path: str, schema: str, keep: Column | None = None
) -> DataFrame:
    """Rows of JSON files that hold one array each, optionally filtered; a file is read by one task."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return rows if keep is None else rows.where(keep)


def field_equals(field: str, value: object) -> Column:
    return F.col(field) == F.lit(value)
