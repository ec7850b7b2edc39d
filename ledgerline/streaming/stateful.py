"""Stateful stream operators: multiline merge and batching per client.

State is keyed by client, because order is per client. What a client keeps
between triggers is its open entry or its open batch, stored as Arrow blobs;
everything decidable per row (start-line match, wire size) is computed by
Spark expressions before the state is touched. The rows one client brings to a
task are bounded by the trigger (``maxFilesPerTrigger`` and the like).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerline.functions.regex import compile_pattern
from ledgerline.operators.batching import BATCH_BYTES, BATCH_SIZE, SegmentCuts, wire_sizes
from ledgerline.operators.sequence import MAX_LINES

# Control rows a stream may carry in its ``control`` column.
MISMATCH = "mismatch"  # the stream resumes at the expected position
RESTART = "restart"  # the stream resumes at its head, with a reset
GAP = "gap"  # the source recovered: keep what is buffered, send with a reset

MERGE_TIMEOUT_MS = 1_000
BATCH_TIMEOUT_MS = 5_000


def _pack(frame: pd.DataFrame, schema: pa.Schema) -> bytes:
    table = pa.Table.from_pandas(frame, schema=schema, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpack(blob: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(blob).read_all().to_pandas(integer_object_nulls=True)


def _flat(df: DataFrame) -> tuple[DataFrame, dict[str, T.DataType]]:
    """Nested columns as JSON text while they wait in state."""
    nested = {
        f.name: f.dataType
        for f in df.schema.fields
        if isinstance(f.dataType, (T.MapType, T.StructType, T.ArrayType))
    }
    return df.withColumns({n: F.to_json(F.col(n)) for n in nested}), nested


def _nested(df: DataFrame, nested: dict[str, T.DataType]) -> DataFrame:
    return df.withColumns({n: F.from_json(F.col(n), t) for n, t in nested.items()})


def _in_order(rows: Iterator[pd.DataFrame], names: list[str], order: str) -> pd.DataFrame:
    """One trigger's rows of a client in stream order.

    Computed columns reach the processor without their names, so all are named
    by position.
    """
    return pd.concat(list(rows), ignore_index=True).set_axis(names, axis=1).sort_values(
        order, kind="stable", ignore_index=True
    )


def _start_timer(handle: StatefulProcessorHandle, times, timeout_ms: int | None) -> int:
    if timeout_ms is None:
        return -1
    due = times.getCurrentProcessingTimeInMs() + timeout_ms
    handle.registerTimer(due)
    return due


def _time_mode(timeout_ms: int | None) -> str:
    """With timers a query runs until stopped, also under an availableNow trigger."""
    return "None" if timeout_ms is None else "processingTime"


def _between_controls(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, str | None]]:
    """Runs of ordinary rows, each with the control row that ends it."""
    at = np.flatnonzero(frame["_control"].notna().to_numpy())
    begin = 0
    for k in at:
        yield frame.iloc[begin:k], frame["_control"].iloc[k]
        begin = k + 1
    yield frame.iloc[begin:], None


class MergeLines(StatefulProcessor):
    def __init__(self, schema: T.StructType, order: str, message: str, cursor: str, max_messages: int, timeout_ms: int | None):
        self.columns, self.inputs = schema.names, [*schema.names, "_start", "_control"]
        self.arrow = to_arrow_schema(schema)
        self.order, self.message, self.cursor = order, message, cursor
        self.max_messages, self.timeout_ms = max_messages, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getValueState("pending", "entry binary, lines bigint, due bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows, self.inputs, self.order)
        held, lines = None, 0
        if self.pending.exists():
            blob, lines, due = self.pending.get()
            held = _unpack(bytes(blob))
            if due >= 0:
                self.handle.deleteTimer(due)
        out = []
        for part, control in _between_controls(frame):
            if len(part):
                done, held, lines = self._merge(part, held, lines)
                out += done
            if control in (MISMATCH, RESTART):
                held, lines = None, 0
        if held is None:
            self.pending.clear()
        else:
            due = _start_timer(self.handle, timerValues, self.timeout_ms)
            self.pending.update((_pack(held, self.arrow), int(lines), due))
        if out:
            yield pd.concat(out, ignore_index=True)[self.columns]

    def _merge(self, part, held, lines):
        """Entries completed by these rows, and the entry left open."""
        starts = part["_start"].to_numpy(dtype=bool).copy()
        if held is None:
            starts[0] = True
        island = np.cumsum(starts)
        # Position inside the island; the first one may continue the open entry.
        first = np.concatenate(([0], np.flatnonzero(starts)))
        begin = np.where(island > 0, first[island], 0)
        offset = np.arange(len(part)) - begin + np.where(island == 0, lines, 0)
        piece = offset // self.max_messages
        new = np.empty(len(part), dtype=bool)
        new[0] = held is None or starts[0] or piece[0] > (lines - 1) // self.max_messages
        new[1:] = (island[1:] != island[:-1]) | (piece[1:] != piece[:-1])
        bounds = np.append(np.flatnonzero(new), len(part))
        texts, cursors = part[self.message].tolist(), part[self.cursor].tolist()
        done = []
        lead = bounds[0]
        if lead:
            held = held.copy()
            held.loc[0, self.message] = "\n".join([held.loc[0, self.message], *texts[:lead]])
            held.loc[0, self.cursor] = cursors[lead - 1]
            lines += lead
        heads = part.iloc[bounds[:-1]][self.columns].reset_index(drop=True)
        heads[self.message] = ["\n".join(texts[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        heads[self.cursor] = [cursors[b - 1] for b in bounds[1:]]
        if not len(heads):
            return [], held, lines
        if held is not None:
            done.append(held)
        if len(heads) > 1:
            done.append(heads.iloc[:-1])
        left = heads.iloc[[-1]].reset_index(drop=True)
        return done, left, int(bounds[-1] - bounds[-2])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.pending.exists():
            blob, _, due = self.pending.get()
            if due <= expiredTimerInfo.getExpiryTimeInMs():
                self.pending.clear()
                yield _unpack(bytes(blob))[self.columns]

    def close(self) -> None:
        pass


def multiline_stream(
    df: DataFrame,
    start_pattern: str | Column,
    client: str = "client_id",
    order: str = "seqno",
    message: str = "message",
    cursor: str = "cursor",
    max_messages: int = MAX_LINES,
    timeout_ms: int | None = MERGE_TIMEOUT_MS,
    control: str | None = None,
) -> DataFrame:
    """``multiline_merge`` on a stream.

    An open entry is emitted when its client brings no line for ``timeout_ms``
    (None: never, which lets an availableNow trigger end);
    ``drain_entries`` reads the ones still open when the stream has stopped.
    A ``control`` row of a mismatch discards the open entry.
    """
    start = (
        F.rlike(F.col(message), F.lit(compile_pattern(start_pattern).java))
        if isinstance(start_pattern, str)
        else start_pattern
    )
    control_value = F.nullif(F.col(control), F.lit("")) if control else F.lit(None).cast("string")
    flat, nested = _flat(df.drop(control) if control else df)
    schema = flat.schema
    flat_all, _ = _flat(df)
    marked = flat_all.withColumns({"_start": F.coalesce(start, F.lit(False)), "_control": control_value})
    merged = (
        marked.select(*schema.names, "_start", "_control")
        .groupBy(client)
        .transformWithStateInPandas(
            MergeLines(schema, order, message, cursor, max(max_messages, 1), timeout_ms),
            schema, "append", _time_mode(timeout_ms),
        )
    )
    return _nested(merged, nested)


def drain_entries(spark: SparkSession, checkpoint: str, like: DataFrame) -> DataFrame:
    """Entries still open in a stopped ``multiline_stream``.

    ``like`` is any frame with the stream's columns (its schema is used).
    """
    flat, nested = _flat(like)
    return _nested(_read_blobs(spark, checkpoint, "pending", "entry", flat.schema), nested)


def _read_blobs(spark, checkpoint: str, state: str, blob: str, schema: T.StructType) -> DataFrame:
    stored = (
        spark.read.format("statestore")
        .option("path", checkpoint)
        .option("stateVarName", state)
        .load()
    )
    value = "value" if "value" in stored.columns else "list_element"
    arrow = to_arrow_schema(schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for held in batch.column("blob").to_pylist():
                if held is not None:
                    yield from pa.ipc.open_stream(held).read_all().cast(arrow).to_batches()

    return stored.select(F.col(f"{value}.{blob}").alias("blob")).mapInArrow(rows, schema)


SIZE_COLUMNS = ["_size", "_next_size", "_open_size", "_real"]


class FillBatches(StatefulProcessor):
    def __init__(self, schema: T.StructType, order: str, batch_size: int, max_bytes: int, timeout_ms: int | None):
        self.columns, self.inputs = schema.names, [*schema.names, *SIZE_COLUMNS, "_control"]
        self.arrow = to_arrow_schema(schema)
        self.order = order
        self.batch_size, self.max_bytes, self.timeout_ms = batch_size, max_bytes, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState(
            "open", "batch_no bigint, used bigint, real bigint, rows bigint, reset boolean, due bigint"
        )
        self.chunks = handle.getListState("chunks", "rows binary")

    def _load(self):
        if self.open.exists():
            return list(self.open.get())
        return [0, 0, 0, 0, False, -1]

    def _buffered(self) -> list[pd.DataFrame]:
        return [_unpack(bytes(c[0])) for c in self.chunks.get()] if self.chunks.exists() else []

    def _tag(self, frames: list[pd.DataFrame], number: int, reset: bool) -> pd.DataFrame:
        return pd.concat(frames, ignore_index=True)[self.columns].assign(batch_no=number, batch_reset=reset)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = _in_order(rows, self.inputs, self.order)
        number, used, real, count, reset, due = self._load()
        started = count == 0
        for part, control in _between_controls(frame):
            if len(part):
                cuts = SegmentCuts(
                    part["_size"].to_numpy(np.int64), part["_next_size"].to_numpy(np.int64),
                    part["_open_size"].to_numpy(np.int64), part["_real"].to_numpy().astype(np.int64),
                    self.batch_size, self.max_bytes,
                )
                following = cuts.next_cuts()
                begin = 0
                end = cuts.first_cut(used, real) if count else int(following[0])
                while end < cuts.n or (end == cuts.n and self._full(cuts, begin, real if begin == 0 else 0)):
                    frames = (self._buffered() if begin == 0 and count else []) + [part.iloc[begin:end]]
                    yield self._tag(frames, number, reset)
                    if begin == 0 and count:
                        self.chunks.clear()
                    number, reset, count, used, real, started = number + 1, False, 0, 0, 0, True
                    begin = end
                    if begin >= cuts.n:
                        break
                    end = int(following[begin])
                if begin < cuts.n:
                    left = part.iloc[begin:][self.columns]
                    self.chunks.appendValue((_pack(left, self.arrow),))
                    total = int(cuts.size_before[-1] - cuts.size_before[begin])
                    used = (used if count else int(cuts.open_size[begin])) + total
                    real += int(cuts.real_before[-1] - cuts.real_before[begin])
                    count += len(left)
            if control in (MISMATCH, RESTART):
                self.chunks.clear()
                used, real, count, started = 0, 0, 0, True
                reset = control == RESTART
            elif control == GAP:
                reset = True
        if count and started:
            if due >= 0:
                self.handle.deleteTimer(due)
            due = _start_timer(self.handle, timerValues, self.timeout_ms)
        elif not count and due >= 0:
            self.handle.deleteTimer(due)
            due = -1
        self.open.update((number, used, real, count, reset, due))

    def _full(self, cuts: SegmentCuts, begin: int, real: int) -> bool:
        reals = real + int(cuts.real_before[-1] - cuts.real_before[begin])
        return self.batch_size > 0 and reals >= self.batch_size

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        number, used, real, count, reset, due = self._load()
        if not count or due > expiredTimerInfo.getExpiryTimeInMs():
            return
        if not real:
            # Rows without a cursor wait for one that has it.
            due = _start_timer(self.handle, timerValues, self.timeout_ms)
            self.open.update((number, used, real, count, reset, due))
            return
        yield self._tag(self._buffered(), number, reset)
        self.chunks.clear()
        self.open.update((number + 1, 0, 0, 0, False, -1))

    def close(self) -> None:
        pass


def batch_stream(
    df: DataFrame,
    batch_size: int = BATCH_SIZE,
    max_bytes: int = BATCH_BYTES,
    timeout_ms: int | None = BATCH_TIMEOUT_MS,
    client: str = "client_id",
    order: str = "seqno",
    position: str = "position",
    cursor: str = "cursor",
    size: Column | None = None,
    control: str | None = None,
) -> DataFrame:
    """``batch_split`` on a stream: rows leave with ``batch_no`` when their batch closes.

    A batch closes when the next row would overflow it, when it holds
    ``batch_size`` rows, or ``timeout_ms`` after its first row. Control rows
    discard (mismatch, restart) or keep (gap) what is buffered, and decide
    ``batch_reset`` of the next batch. Sizes include the whole record.
    """
    control_value = F.nullif(F.col(control), F.lit("")) if control else F.lit(None).cast("string")
    sized = df.withColumns(
        {
            **{f"_{n}": c for n, c in wire_sizes(client, position, cursor, size).items()},
            "_control": control_value,
        }
    )
    alone = F.col("_size") + 1 + F.col("_next_size") + F.col("_open_size")
    sized = sized.withColumn(
        "_size",
        F.when(
            (alone > max_bytes) & F.col("_control").isNull(),
            F.raise_error("record JSON exceeds maximum batch request size").cast("bigint"),
        ).otherwise(F.col("_size")),
    )
    flat, nested = _flat(sized)
    keep = [c for c in df.columns if c != control]
    schema = T.StructType([flat.schema[c] for c in keep])
    output = T.StructType(
        [*schema.fields, T.StructField("batch_no", T.LongType()), T.StructField("batch_reset", T.BooleanType())]
    )
    batched = flat.select(*keep, *SIZE_COLUMNS, "_control").groupBy(client).transformWithStateInPandas(
        FillBatches(schema, order, batch_size, max_bytes, timeout_ms), output, "append", _time_mode(timeout_ms)
    )
    return _nested(batched, {n: t for n, t in nested.items() if n in keep})


def drain_batches(spark: SparkSession, checkpoint: str, like: DataFrame) -> DataFrame:
    """Rows still waiting in the open batches of a stopped ``batch_stream``."""
    flat, nested = _flat(like)
    return _nested(_read_blobs(spark, checkpoint, "chunks", "rows", flat.schema), nested)
