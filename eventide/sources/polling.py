"""A polling stream source over a growing table with an increasing key (S9, T7), with Spark-kept offsets.

``KeyedPoll`` is a Python data source: each poll asks for the greatest key, and
a micro-batch reads the rows above the last mark up to it, dealt over tasks by
ranges of the key.  The mark lives in the query's checkpoint, so an interrupted
run repeats its batch and a resumed one goes on behind it.  The table is a
folder of Parquet files that stands in for the database: greatest keys come from
the files' footers, and a task opens only row groups that meet its range.

Defined results: rows with a null key are never seen, and rows that arrive at or
below the mark are missed, as in any poll by key; an empty or missing folder
has no rows yet; extra columns of the files are not read.
"""

from __future__ import annotations

import glob
import os

import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType


class _Range(InputPartition):
    """Keys above ``low`` up to ``high``."""

    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


def _files(path: str) -> list[str]:
    return sorted(glob.glob(os.path.join(path, "*.parquet")))


def _greatest(file: str, key: str) -> int | None:
    meta = pq.read_metadata(file)
    at = meta.schema.to_arrow_schema().names.index(key)
    stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
    return max((s.max for s in stats if s is not None and s.has_min_max), default=None)


class _Reader(DataSourceStreamReader):
    def __init__(self, schema: StructType, path: str, key: str, start: int, tasks: int):
        self.columns, self.path, self.key, self.start, self.tasks = schema.names, path, key, start, tasks

    def initialOffset(self) -> dict:
        return {"mark": self.start}

    def latestOffset(self) -> dict:
        found = [_greatest(f, self.key) for f in _files(self.path)]
        return {"mark": max([self.start, *(k for k in found if k is not None)])}

    def partitions(self, start: dict, end: dict) -> list[_Range]:
        low, high = start["mark"], end["mark"]
        n = max(1, min(self.tasks, high - low))
        cuts = [low + (high - low) * i // n for i in range(n + 1)]
        return [_Range(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]

    def read(self, partition: _Range):
        key = ds.field(self.key)
        files = _files(self.path)
        if files:
            yield from ds.dataset(files, format="parquet").to_batches(
                columns=self.columns, filter=(key > partition.low) & (key <= partition.high))


class KeyedPoll(DataSource):
    """Options: path, key, start (mark before the first poll, default -1) and tasks (of a batch, default 8)."""

    @classmethod
    def name(cls) -> str:
        return "keyed_poll"

    def streamReader(self, schema: StructType) -> _Reader:
        o = self.options
        path = o["path"].removeprefix("file://").removeprefix("file:")
        return _Reader(schema, path, o["key"], int(o.get("start", -1)), int(o.get("tasks", 8)))


def read_polled(spark: SparkSession, path: str, schema: StructType, key: str, tasks: int = 8) -> DataFrame:
    """The table at ``path`` as a stream of rows above the stored mark."""
    spark.dataSource.register(KeyedPoll)
    return (spark.readStream.format("keyed_poll").schema(schema)
            .option("path", path).option("key", key).option("tasks", str(tasks)).load())


def poll(spark: SparkSession, path: str, schema: StructType, key: str, sink: str, checkpoint: str) -> None:
    """Append what arrived since the last run to the Parquet folder ``sink``, then stop."""
    q = (read_polled(spark, path, schema, key).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink))
    q.awaitTermination()
