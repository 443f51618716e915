"""Registration of queries, and the conversions that make results comparable across engines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under `name`, with its DuckDB counterpart if there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} exists already")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Whole numbers as bigint, decimals as double, timestamps as text."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(field.name))
    return df.select(*out)


def scratch(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder, for queries that write and read back."""
    return scratch_path(spark, "scratch")
