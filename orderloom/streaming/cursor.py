"""Reading a keyed collection in batches, with offsets that are keys.

The collection is anything that can name the next keys and give the rows between two keys: a database cursor, an API, or
files. A micro-batch covers the rows behind one key up to another, cut into key ranges that executors read in parallel.
The checkpoint holds the last key, so a query that is stopped, or fails in a batch, goes on behind the last batch that
was finished; a batch that is repeated has the same two keys and thus the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

Key = int | str


class Collection(Protocol):
    """What a cursor reads. It is sent to executors, so it holds names and settings, no open connection."""

    def next_keys(self, after: Key | None, rows: int, ranges: int) -> list[Key]:
        """Ascending keys that cut the next `rows` rows behind `after` into `ranges` ranges; the last one ends the batch."""

    def rows(self, after: Key | None, upto: Key) -> Iterator[pa.RecordBatch]:
        """Rows with after < key <= upto."""


@dataclass(frozen=True)
class ParquetCollection:
    """Parquet files as a collection. The key is unique; row groups outside a key range are skipped by their statistics."""

    path: str
    key: str
    columns: tuple[str, ...]

    def _behind(self, after: Key | None, upto: Key | None = None) -> ds.Expression | None:
        field = ds.field(self.key)
        low = None if after is None else field > after
        high = None if upto is None else field <= upto
        return high if low is None else low if high is None else low & high

    def next_keys(self, after: Key | None, rows: int, ranges: int) -> list[Key]:
        found: pa.Array | None = None
        for batch in ds.dataset(self.path, format="parquet").to_batches(columns=[self.key], filter=self._behind(after)):
            keys = batch.column(0).drop_null()
            keys = keys if found is None else pa.concat_arrays([found, keys])
            # the smallest `rows` keys so far: never more than a batch of files and a batch of the stream
            found = keys.take(pc.select_k_unstable(keys, k=min(rows, len(keys)), sort_keys=[("", "ascending")]))
        if found is None or not len(found):
            return []
        at = sorted({-(-len(found) * i // ranges) - 1 for i in range(1, ranges + 1)} - {-1})
        return found.take(pa.array(at)).to_pylist()

    def rows(self, after: Key | None, upto: Key) -> Iterator[pa.RecordBatch]:
        yield from ds.dataset(self.path, format="parquet").to_batches(columns=list(self.columns), filter=self._behind(after, upto))


@dataclass
class KeyRange(InputPartition):
    after: Key | None
    upto: Key


class _Reader(DataSourceStreamReader):
    """Offsets are {"key": last key, "cuts": inner cuts of the batch that ends there}."""

    def __init__(self, collection: Collection, rows: int, ranges: int) -> None:
        self.collection, self.batch_rows, self.ranges = collection, rows, ranges
        self.reached: dict | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {"key": None, "cuts": []}

    def latestOffset(self, *_: object) -> dict:  # noqa: N802
        """One batch behind what has been planned so far; the same offset when there is nothing new."""
        reached = self.reached or self.initialOffset()
        keys = self.collection.next_keys(reached["key"], self.batch_rows, self.ranges)
        if keys:
            reached = {"key": keys[-1], "cuts": keys[:-1]}
        self.reached = reached
        return reached

    def partitions(self, start: dict, end: dict) -> list[KeyRange]:
        if self.reached is None:  # a restarted query plans its last batch first
            self.reached = end
        if start["key"] == end["key"]:
            return []
        cuts = [start["key"], *(c for c in end["cuts"] if start["key"] is None or c > start["key"]), end["key"]]
        return [KeyRange(a, b) for a, b in zip(cuts, cuts[1:], strict=False)]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        yield from self.collection.rows(partition.after, partition.upto)


def read_cursor(
    spark: SparkSession, collection: Collection, schema: str, rows_per_batch: int = 100_000, ranges: int = 8, name: str = "keyed_cursor"
) -> DataFrame:
    """A stream over `collection` in batches of `rows_per_batch` rows, each read as `ranges` key ranges.

    `schema` is the DDL of the rows in their order. Start the stream with a processing-time trigger: an available-now
    trigger would end after one batch.
    """

    class Cursor(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def streamReader(self, schema: object) -> DataSourceStreamReader:  # noqa: N802
            return _Reader(collection, rows_per_batch, ranges)

    spark.dataSource.register(Cursor)
    return spark.readStream.format(name).load()


class _Enough(Exception):
    """Ends a run between two batches."""


def drain(stream: DataFrame, target: str, checkpoint: str, most_batches: int | None = None) -> int:
    """Write the rows that there are to `target`, a folder per batch, then stop; run it again for the rest.

    A batch that is repeated overwrites its folder, so every row is there once. `most_batches` ends the run earlier.
    Gives the number of batches that this run has written.
    """
    done = []

    def write(batch: DataFrame, number: int) -> None:
        if len(done) == most_batches:
            raise _Enough
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")
        done.append(number)

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    except StreamingQueryException as e:
        if _Enough.__name__ not in str(e):
            raise
    finally:
        query.stop()
    return len(done)
