"""Ordering, rendering and rotation of exported rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.text import render_line
from ledgerline.session import require_utc, stage


def order_by_time(df: DataFrame, time: str = "ts_orig", ties: list[str] | None = None) -> DataFrame:
    """Ascending by time, ties by key so that reruns give the same order."""
    return df.orderBy(time, *(ties or []))


def render_rows(df: DataFrame, columns: list[str] | None = None, keep: list[str] | None = None) -> DataFrame:
    """``line`` (TSV text) and ``line_bytes`` (with its line feed) per row."""
    require_utc(df.sparkSession)
    return df.select(*(keep or []), render_line(df, columns).alias("line")).withColumn(
        "line_bytes", (F.octet_length("line") + 1).cast("bigint")
    )


def _running_bytes(column: str):
    """Bytes before each row inside its partition, batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            sizes = batch.column(column).to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes) + total
            yield batch.append_column("_before", pa.array(ends - sizes, pa.int64()))
            if len(sizes):
                total = int(ends[-1])

    return run


def in_ranges(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Globally sorted: contiguous ranges of ``order``, each sorted inside its task.

    The order should end in a key, so that a value shared by very many rows
    can still be split over tasks.
    """
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def rotate_files(
    df: DataFrame,
    order: list[str],
    limit: int,
    size: str = "line_bytes",
    partitions: int | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add ``file_idx`` (from 1) by total bytes of all rows before, in ``order``.

    A file exceeds ``limit`` by less than one row. The range-sorted rows are
    written once; each partition's total then becomes the next one's offset,
    so no single task sees all rows. The offsets frame has one row per
    partition, which bounds what is broadcast.

    ``prepare`` is a row-wise step (rendering, say) to run after the shuffle:
    range bounds are found by sampling, which would run it a second time.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    ranged = in_ranges(df, order, partitions)
    if prepare is not None:
        ranged = prepare(ranged)
    columns = ranged.columns
    ranged = ranged.withColumn("_range", F.spark_partition_id())
    schema = T.StructType([*ranged.schema.fields, T.StructField("_before", T.LongType())])
    placed = stage(ranged.mapInArrow(_running_bytes(size), schema), "rotate")
    totals = placed.groupBy("_range").agg(F.max(F.col("_before") + F.col(size)).alias("_bytes"))
    offsets = totals.select(
        "_range",
        F.coalesce(
            F.sum("_bytes").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("_offset"),
    )
    whole = placed.join(F.broadcast(offsets), "_range")
    whole = whole.withColumn("bytes_before", F.col("_offset") + F.col("_before"))
    return whole.select(*columns, F.expr(f"bytes_before div {int(limit)} + 1").alias("file_idx"), "bytes_before")
