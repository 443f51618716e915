"""What a table's schema holds, nested fields included, and how well the fields are filled."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """A field of any depth. `values` is an array of its values in one row; arrays on the way are opened."""

    path: str
    depth: int
    kind: T.DataType
    nullable: bool
    values: Column

    @property
    def mode(self) -> str:
        return {T.ArrayType: "REPEATED", T.StructType: "RECORD"}.get(type(self.kind), "SCALAR")


def fields(schema: T.StructType) -> Iterator[Field]:
    """All fields, parents first. Members of an array of structs have paths like `items[].price`."""
    for f in schema.fields:
        yield from _walk(f.name, 1, f.dataType, f.nullable, F.array(F.col(f"`{f.name}`")))


def _walk(path: str, depth: int, kind: T.DataType, nullable: bool, values: Column) -> Iterator[Field]:
    yield Field(path, depth, kind, nullable, values)
    while isinstance(kind, T.ArrayType):
        path, kind = f"{path}[]", kind.elementType
        values = F.flatten(F.filter(values, lambda a: a.isNotNull()))
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            yield from _walk(f"{path}.{f.name}", depth + 1, f.dataType, f.nullable, F.transform(values, _member(f.name)))


def _member(name: str) -> Callable[[Column], Column]:
    return lambda struct: struct[name]


def nested_columns(df: DataFrame, table: str) -> DataFrame:
    """(table_name, path, ordinal_position, depth, data_type, field_mode, is_nullable, filled_values, sample), one scan.

    Filled are values that are not null and, of arrays, not empty. The sample is the smallest value of a scalar as text.
    """
    aggregates, described = [], []
    for i, field in enumerate(fields(df.schema), 1):
        scalar = field.mode == "SCALAR"
        filled = F.filter(field.values, (lambda v: F.size(v) > 0) if field.mode == "REPEATED" else (lambda v: v.isNotNull()))
        aggregates.append(F.coalesce(F.sum(F.size(filled)), F.lit(0)).cast("bigint").alias(f"n{i}"))
        if scalar:
            aggregates.append(F.min(F.array_min(F.transform(field.values, lambda v: v.cast("string")))).alias(f"s{i}"))
        described.append(
            F.struct(
                F.lit(table).alias("table_name"), F.lit(field.path).alias("path"), F.lit(i).cast("bigint").alias("ordinal_position"),
                F.lit(field.depth).cast("bigint").alias("depth"), F.lit(field.kind.typeName() if not scalar else field.kind.simpleString()).alias("data_type"),
                F.lit(field.mode).alias("field_mode"), F.lit(field.nullable).alias("is_nullable"),
                F.col(f"n{i}").alias("filled_values"), (F.col(f"s{i}") if scalar else F.lit(None).cast("string")).alias("sample"),
            )
        )
    return df.agg(*aggregates).select(F.explode(F.array(*described)).alias("c")).select("c.*")


def column_summary(df: DataFrame, table: str) -> DataFrame:
    """One row: columns, those that may be null, those that are nested, and fields of any depth. Reads no data."""
    every = list(fields(df.schema))
    top = [f for f in every if f.depth == 1]
    counts = {
        "total_columns": len(top), "nullable_columns": sum(f.nullable for f in top), "non_nullable_columns": sum(not f.nullable for f in top),
        "nested_columns": sum(f.mode != "SCALAR" for f in top), "total_fields": len(every),
    }
    one = df.sparkSession.range(1)
    return one.select(F.lit(table).alias("table_name"), *[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])
