"""Log tables and position tables that streams write, on plain Parquet."""

from __future__ import annotations

import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType, TimestampType

from ledgerline.operators.merge import latest_by_key, upsert_positions, upsert_rows
from ledgerline.schema import LOG_TABLE, LOG_TABLE_KEY, POSITION, TableColumn, struct_of
from ledgerline.sinks.dated import DATE, with_date
from ledgerline.storage import Folder

#: When a row's batch was written, in nanoseconds: later batches win.
WRITTEN = "_written"
NO_STREAM = "none"


def append_rows(df: DataFrame, path: str) -> None:
    """Append without looking for duplicates."""
    df.write.mode("append").parquet(path)


def _batch_folder(stream: str, batch_id: int) -> str:
    """A stream's number of a micro-batch names its folder: the batch run again replaces it."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", stream):
        raise ValueError(f"stream {stream!r} can't name a folder")
    return f"stream={stream}/batch={batch_id}"


def _overwrite(rows: DataFrame, path: str, by: list[str]) -> None:
    # Static: dates that a batch run again no longer has go as well.
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(path)


class LogTable:
    """A keyed table: a folder for each micro-batch, by date inside; readers take the latest row of a key.

    Writing costs the batch alone and looks at nothing stored. If the first key is a
    timestamp its UTC date is a folder too, so a condition on it prunes the scan of all
    batches. Two streams, or a new checkpoint that counts from 0 again, write to
    different folders. Of batches with the same key the one written last wins.

    A batch is seen as its files appear; one cut off is replaced when it runs again.
    Many small batches are many files: move dates that are complete to a table of
    ``sinks.dated`` (``upsert_dated``) if the stream goes on for long.
    """

    def __init__(
        self, spark: SparkSession, path: str, columns: list[TableColumn] = LOG_TABLE, keys: list[str] = LOG_TABLE_KEY
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = struct_of(columns)
        self.keys = list(keys)
        self.by = [DATE] if isinstance(self.schema[self.keys[0]].dataType, TimestampType) else []

    def upsert(
        self, rows: DataFrame, batch_id: int, order: str | list[str] | None = None, stream: str = NO_STREAM
    ) -> None:
        """Write batch ``batch_id`` of ``stream``; ``order`` picks among rows of one key, if there may be several."""
        folder = _batch_folder(stream, batch_id)
        if order is not None:
            names = [order] if isinstance(order, str) else order
            rows = latest_by_key(rows, self.keys, F.struct(*names))
        rows = rows.select(*self.schema.names)
        if self.by:
            rows = with_date(rows, self.keys[0])
        # Ranges of the key, whose lead is the time: a task has few dates, a time interval few files.
        placed = rows.repartitionByRange(*self.keys).sortWithinPartitions(*self.by, *self.keys)
        _overwrite(placed.withColumn(WRITTEN, F.lit(time.time_ns())), f"{self.path}/{folder}", self.by)

    def read(self, dated: bool = False) -> DataFrame:
        """The latest row of each key; with ``dated`` also the column that prunes, for ``time_range``."""
        shown = [*self.schema.names, *(self.by if dated else [])]
        schema = StructType(list(self.schema.fields)).add(WRITTEN, LongType())
        for name in self.by:
            schema = schema.add(name, "date")
        if not Folder(self.spark, self.path).exists():
            return self.spark.createDataFrame([], schema).select(*shown)
        stored = self.spark.read.schema(schema).parquet(self.path).select(*schema.names)
        # The date follows from the key; as a grouping column it lets conditions reach the scan.
        return latest_by_key(stored, [*self.keys, *self.by], WRITTEN).select(*shown)


class PositionTable:
    """One position per client: each micro-batch writes those its stream has set so far.

    So a stream's newest folder is all it has to say, the one before it is where a
    batch that runs again starts from, and older ones are removed. Of several streams
    that set a client the last one counts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.folder = Folder(spark, self.path)
        self.schema = StructType(list(POSITION.fields)).add(WRITTEN, LongType())

    def _numbers(self, stream: str) -> list[int]:
        """The batches of a stream whose write was completed."""
        numbers = [int(name.partition("=")[2]) for name in self.folder.names(f"stream={stream}")]
        return sorted(n for n in numbers if self.folder.exists(f"{_batch_folder(stream, n)}/_SUCCESS"))

    def _set_by(self, stream: str, before: int | None = None) -> DataFrame | None:
        """What a stream has set, or had before a batch of it."""
        numbers = [n for n in self._numbers(stream) if before is None or n < before]
        if not numbers:
            return None
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{_batch_folder(stream, numbers[-1])}")

    def read(self, before: int | None = None, stream: str = NO_STREAM) -> DataFrame | None:
        """The positions, or what they are without batch ``before`` of ``stream``."""
        streams = [name.partition("=")[2] for name in self.folder.names() if name.startswith("stream=")]
        found = None
        for name in streams:
            part = self._set_by(name, before if name == stream else None)
            if part is not None:
                found = part if found is None else found.unionByName(part)
        return None if found is None else latest_by_key(found, ["client_id"], WRITTEN).drop(WRITTEN)

    def upsert(self, incoming: DataFrame, batch_id: int, stream: str = NO_STREAM) -> None:
        folder = _batch_folder(stream, batch_id)
        incoming = incoming.select(*POSITION.names)
        # Nulls keep what any stream has stored.
        merged = upsert_positions(self.read(batch_id, stream), incoming)
        changed = merged.join(incoming.select("client_id"), "client_id", "left_semi")
        changed = changed.withColumn(WRITTEN, F.lit(time.time_ns()))
        known = upsert_rows(self._set_by(stream, batch_id), changed, ["client_id"], WRITTEN)
        _overwrite(known.select(*self.schema.names), f"{self.path}/{folder}", [])
        # Later ones are there only if the stream was set back; they run again.
        for n in self._numbers(stream):
            if not batch_id - 2 <= n <= batch_id:
                self.folder.remove(_batch_folder(stream, n))
