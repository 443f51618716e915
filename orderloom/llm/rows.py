"""Helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = "__row_key"


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, text) only. Equal keys mean equal rows, so null and repeated ids need no special care."""
    return docs.select(row_key(id_col, text_col).alias(KEY), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col), F.col(text_col))


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts: one number, from which bucket counts are derived."""
    return int(docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0)


def buckets_for(n_bytes: int, bytes_each: int = 16_000_000, least: int = 48) -> int:
    """Hash buckets so that a bucket's share does not grow with the input."""
    return max(least, -(-n_bytes // bytes_each))


def copies(rows: DataFrame) -> DataFrame:
    """(key, copy) of rows whose text another row has as well: copy is true for all but one of equal texts.

    `rows` comes from `keyed`. Counting comes first, so a text that a third of all rows share is one row of the join.
    """
    marked = rows.select(KEY, F.md5(F.col("text").cast("binary")).alias("print"))
    groups = marked.groupBy("print").agg(F.count("*").alias("n"), F.min(KEY).alias("first")).where("n > 1")
    members = marked.where("print is not null").join(groups, "print")
    return members.groupBy(KEY).agg(F.min(F.col(KEY) != F.col("first")).alias("copy"))
