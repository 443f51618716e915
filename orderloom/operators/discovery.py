"""Which fields do JSON documents have, and of which types?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.documents import parsed_json
from orderloom.session import stored

# Names of the JSON kinds, and the column type proposed for a field of one kind.
RECOMMENDED = {
    "bool": "BOOL", "int": "INT64", "float": "FLOAT64", "string": "STRING",
    "array": "ARRAY/REPEATED", "object": "RECORD/STRUCT",
}

# Tokens of JSON text. No quantifier gives back what it took, so long texts need no stack; classes of single characters
# are looked up in a table, ranges are not.
_CONTROL = "".join(f"\\x{n:02x}" for n in range(32))
_STRING = rf'"(?:[^"\\{_CONTROL}]++|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{{4}}))*+"'
_DIGITS = r"(?:(?<=\.)\d{1,18}+|0|[1-9]\d{0,17}+)(?!\d)"
#: Longer documents are their own shape.
SHAPE_CHARS = 1_000_000


def shape(text: Column) -> Column:
    """The document with every text value as "", whole number as 1 and broken number as 1.1 or 1e1: same fields, same kinds.

    Keys, and what is no plain JSON value (whole numbers of more than 18 digits, bad escapes), stay as they are, so
    documents of one shape are all valid or all invalid. Each pass goes on where its last match ended, key by key.
    """
    texts = rf'\G(?<before>(?:[^"]++|{_STRING}\s*+:)*+){_STRING}'
    numbers = rf'\G(?<before>(?:[^"0123456789]++|{_STRING}|\d{{19,}}+)*+){_DIGITS}'
    out = F.regexp_replace(F.regexp_replace(text, texts, '${before}""'), numbers, "${before}1")
    return F.when(F.length(text) <= SHAPE_CHARS, out).otherwise(text)


def _kind(t: Column) -> Column:
    """Name of the kind of a value with the schema `t`."""
    return (
        F.when(t.isNull() | (t == "VOID"), "null")
        .when(t == "BOOLEAN", "bool")
        .when(t == "BIGINT", "int")
        .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), "float")
        .when(t.startswith("ARRAY"), "array")
        .when(t.startswith("OBJECT"), "object")
        .otherwise("string")
    )


def _node(path: Column, value: Column) -> Column:
    """A value with its schema, which is asked for several times and dear for a large value."""
    return F.struct(path.alias("path"), value.alias("value"), F.schema_of_variant(value).alias("type"))


def _members_of(node: Column) -> Column:
    """Key-value pairs of an object node as nodes."""
    dot = F.when(node["path"] == "", F.lit("")).otherwise(F.concat(node["path"], F.lit(".")))
    entries = F.map_entries(F.try_variant_get(node["value"], "$", "map<string,variant>"))
    return F.transform(entries, lambda e: _node(F.concat(dot, e["key"]), e["value"]))


def _items_of(node: Column) -> Column:
    """Members of an array node as nodes."""
    items = F.try_variant_get(node["value"], "$", "array<variant>")
    return F.transform(items, lambda v: _node(F.concat(node["path"], F.lit("[]")), v))


def _only(nodes: Column, kind: str) -> Column:
    return F.filter(nodes, lambda n: _kind(n["type"]) == kind)


def nesting(text: Column) -> Column:
    """How deep brackets are nested in a JSON text, strings aside."""
    marks = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*+"', ""), r"[^\[\]{}]+", "")
    start = F.struct(F.lit(0).alias("level"), F.lit(0).alias("most"))

    def step(s: Column, c: Column) -> Column:
        level = s["level"] + F.when(c.isin("{", "["), 1).when(c.isin("}", "]"), -1).otherwise(0)
        return F.struct(level.alias("level"), F.greatest(s["most"], level).alias("most"))

    return F.aggregate(F.split(marks, ""), start, step)["most"]


def document_fields(lines: DataFrame, line: str = "line", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per field occurrence, at any depth: path, kind and text sample.

    Array members are written as `path[]`, and all of them are looked at. A first pass finds the deepest nesting; a
    document is then parsed once and opened level by level inside its row, and its fields leave it in one explode.
    """
    depth = lines.agg(F.max(nesting(F.col(line)))).first()[0] or 1
    root = F.array(_node(F.lit(""), parsed_json(line)))
    df = lines.select(*carry, _only(root, "object").alias("_open"))
    levels = []
    for n in range(depth):
        fields, inside = f"_fields{n}", f"_inside{n}"
        df = df.withColumn(fields, F.flatten(F.transform("_open", _members_of)))
        df = df.withColumn(inside, F.flatten(F.transform(_only(F.col(fields), "array"), _items_of)))
        df = df.withColumn("_open", F.concat(_only(F.col(fields), "object"), _only(F.col(inside), "object")))
        levels += [F.col(fields), F.filter(inside, lambda v: _kind(v["type"]) != "object")]
    found = df.select(*carry, F.explode(F.concat(*levels)).alias("n")).select(*carry, "n.path", "n.value", _kind(F.col("n.type")).alias("kind"))
    nested = F.concat(F.lit("<"), F.col("kind"), F.lit(">"))
    sample = F.when(F.col("kind").isin("array", "object"), nested).otherwise(
        F.substring(F.coalesce(F.try_variant_get("value", "$", "string"), F.lit("None")), 1, 100)
    )
    return found.select(*carry, "path", "kind", sample.alias("sample"))


def field_kinds(fields: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences of each kind per field."""
    return fields.groupBy(*by, "path", "kind").agg(F.count("*").alias("occurrences"), F.min("sample").alias("sample"))


def field_counts(lines: DataFrame, line: str = "line", carry: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences of each kind per field and `carry`, of all documents, without samples.

    Documents are counted by shape first, and only shapes are opened: exact for any documents, and dear only where
    nearly each of them has a shape of its own.
    """
    shapes = lines.groupBy(*carry, shape(F.col(line)).alias("_shape")).agg(F.count("*").alias("_documents"))
    # dealt by count: opening a shape takes far longer than its size says
    spread = stored(shapes.repartition(lines.sparkSession.sparkContext.defaultParallelism))
    fields = document_fields(spread, "_shape", (*carry, "_documents"))
    return fields.groupBy(*carry, "path", "kind").agg(F.sum("_documents").alias("occurrences"))


def recommended_types(kinds: DataFrame) -> DataFrame:
    """Column type per field: mixed kinds become text, whole and broken numbers a float."""
    seen = kinds.groupBy("path").agg(
        F.sum("occurrences").alias("occurrences"),
        F.array_sort(F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))).alias("kinds"),
    )
    single = None
    for kind, name in RECOMMENDED.items():
        hit = F.col("kinds")[0] == kind
        single = F.when(hit, name) if single is None else single.when(hit, name)
    advice = (
        F.when(F.size("kinds") == 0, "STRING")
        .when(F.size("kinds") == 1, single)
        .when(F.col("kinds") == F.array(F.lit("float"), F.lit("int")), "FLOAT64")
        .otherwise("STRING (mixed types)")
    )
    return seen.select("path", "occurrences", F.array_join("kinds", ",").alias("kinds"), advice.alias("recommended_type"))
