"""Ordered stream operators over micro-batches, split inside a client.

A micro-batch runs the segmented operators of the library, so a client with most
of its rows is many groups of (client, segment). What goes on over triggers is
carried as small frames, one set per micro-batch: the open entry of each client,
the rows of its open batch, its counters. A micro-batch reads what the one before
it left and writes its output and its own set under its number. If it fails on the
way it runs again from the same set and replaces both, so rows, numbers and
positions come out exactly once.

The steps are functions of frames: (rows, carried) -> (output, carried). Nothing
is triggered while no rows arrive; ``with_ticks`` adds a row a second, so that
what is open leaves by its timeout.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.parse import parse_record
from ledgerline.functions.regex import compile_pattern
from ledgerline.operators.batching import BATCH_BYTES, BATCH_SEGMENT_WIDTH, BATCH_SIZE, batch_split
from ledgerline.operators.filters import nonempty_message, unit_filter
from ledgerline.operators.sequence import MAX_LINES, assign_seqno, join_lines, place_lines, stamp_entries
from ledgerline.operators.streams import SEGMENT_WIDTH, previous_in_stream, running_count
from ledgerline.operators.validate import MISMATCH as REFUSED
from ledgerline.session import stage, working_folder
from ledgerline.storage import Folder
from ledgerline.streaming.stateful import BATCH_TIMEOUT_MS, GAP, MERGE_TIMEOUT_MS, MISMATCH, RESTART

DISCARDING = (MISMATCH, RESTART)


@dataclass(frozen=True)
class Names:
    client: str = "client_id"
    order: str = "seqno"
    message: str = "message"
    cursor: str = "cursor"
    position: str = "position"
    control: str | None = None
    #: Spans of order values that one group holds when merging and when batching.
    width: int = SEGMENT_WIDTH
    batch_width: int = BATCH_SEGMENT_WIDTH


def _split_controls(rows: DataFrame, names: Names) -> tuple[list[str], DataFrame]:
    """The columns that are left, and the rows with their control word in ``_control``."""
    columns = [c for c in rows.columns if c != names.control]
    word = F.nullif(F.col(names.control), F.lit("")) if names.control else F.lit(None).cast("string")
    return columns, rows.select(*columns, word.alias("_control"))


def merge_step(
    rows: DataFrame,
    held: DataFrame | None,
    start: str | Column,
    now: int,
    names: Names = Names(),  # noqa: B008
    max_messages: int = MAX_LINES,
    timeout_ms: int | None = MERGE_TIMEOUT_MS,
) -> tuple[DataFrame, DataFrame]:
    """Merge a micro-batch of lines: the entries it completes, and those left open.

    ``held`` are the entries left open before, each with its number of lines
    (``_n``) and the time of its last one (``_seen``, in ms as ``now``): an open entry
    takes part as one row that stands for its lines. A mismatch or restart among
    the rows discards the entry open there.
    """
    columns, fresh = _split_controls(rows, names)
    begins = F.rlike(F.col(names.message), F.lit(compile_pattern(start).java)) if isinstance(start, str) else start
    mark = F.col("_control").isNotNull()
    fresh = fresh.filter(~F.coalesce(F.col("_control") == GAP, F.lit(False))).withColumns(
        {
            "_start": mark | F.coalesce(begins, F.lit(False)),
            "_n": F.when(mark, 0).otherwise(1).cast("bigint"),
            "_seen": F.lit(now).cast("bigint"),
        }
    )
    if held is not None:
        before = held.withColumns({"_control": F.lit(None).cast("string"), "_start": F.lit(True)})
        fresh = fresh.unionByName(before.select(*fresh.columns))
    placed = place_lines(fresh, names.client, names.order, max(int(max_messages), 1), names.width, counted="_n")
    key = [names.client, "_island", "_part"]
    gone = None
    if names.control:
        placed = stage(placed, "placed")
        ended = placed.filter(F.col("_control").isin(*DISCARDING) & F.col("_ended").isNotNull())
        gone = ended.select(names.client, (F.col("_island") - 1).alias("_island"), F.col("_ended").alias("_part")).distinct()
        placed = placed.filter(F.col("_control").isNull())
    facts = [F.sum("_n").alias("_n"), F.max("_seen").alias("_seen"), F.max("_last").alias("_last")]
    entries = join_lines(placed, columns, names.client, names.order, names.message, names.cursor, facts)
    if gone is not None:
        entries = entries.join(gone, key, "left_anti")
    entries = stage(entries, "entries")
    stays = F.col("_last")
    if timeout_ms is not None:
        stays = stays & (F.lit(now) - F.col("_seen") < timeout_ms)
    return entries.filter(~stays).select(*columns), entries.filter(stays).select(*columns, "_n", "_seen")


COUNTERS = "client_id string, exp_pos string, next_seqno bigint, number bigint, reset boolean, judged bigint"


def stamp_step(entries: DataFrame, counters: DataFrame, base: int = 0, names: Names = Names(), to: str = "seqno") -> tuple[DataFrame, DataFrame]:  # noqa: B008
    """Position and number of each entry, going on from ``counters``; and the counters after.

    A client that is not known yet begins at its head, with a reset.
    """
    known = counters.select(F.col("client_id").alias(names.client), "exp_pos", "next_seqno")
    stamped = stage(stamp_entries(entries, known, base, names.client, names.order, names.cursor, to, names.width), "stamped")
    real = F.nullif(F.col(names.cursor), F.lit(""))
    last = stamped.groupBy(F.col(names.client).alias("client_id")).agg(
        F.max_by(real, F.when(real.isNotNull(), F.col(to))).alias("_pos"), (F.max(to) + 1).alias("_next")
    )
    after = counters.join(last, "client_id", "full_outer").withColumns(
        {
            "exp_pos": F.coalesce("_pos", "exp_pos"),
            "next_seqno": F.coalesce("_next", "next_seqno"),
            "reset": F.coalesce("reset", F.lit(True)),
        }
    )
    return stamped, after.select(*counters.columns)


def batch_step(
    rows: DataFrame,
    waiting: DataFrame | None,
    counters: DataFrame,
    now: int,
    names: Names = Names(),  # noqa: B008
    batch_size: int = BATCH_SIZE,
    max_bytes: int = BATCH_BYTES,
    timeout_ms: int | None = BATCH_TIMEOUT_MS,
    size: Column | None = None,
    eager: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Batch a micro-batch of rows: the rows that leave, those that wait, the counters after.

    Rows that leave have ``batch_no`` (counted from the counters' ``number``) and
    ``batch_reset``. A batch leaves when the next row does not fit, when its first
    row is ``timeout_ms`` old, and when it is full: at once if ``eager``, else with the
    next row, which makes the cuts those of ``batch_split`` whatever the triggers.
    ``waiting`` are the rows of open batches with the time they came (``_seen``).
    A mismatch or restart discards what is open there unless it is full; restarts
    and gaps make the batch after (or the one that is open) a resetting one.
    """
    client, order = names.client, names.order
    columns, fresh = _split_controls(rows, names)
    marked = fresh.withColumn("_seen", F.lit(now).cast("bigint"))
    if waiting is not None:
        marked = marked.unionByName(waiting.select(*columns, "_seen").withColumn("_control", F.lit(None).cast("string")))
    discards = F.coalesce(F.col("_control").isin(*DISCARDING), F.lit(False))
    if names.control:
        marked = stage(running_count(marked, discards, "_epoch", client, order, names.width), "epochs")
    else:
        marked = marked.withColumn("_epoch", F.lit(0).cast("bigint"))
    # The first row of an epoch (between two discards) opens a batch, and its batches count from 0.
    lines = marked.filter(F.col("_control").isNull())
    split = batch_split(
        lines, batch_size, max_bytes, client, order, names.position, names.cursor, size, names.batch_width, epoch="_epoch"
    ).withColumnRenamed("batch_no", "_batch")
    split = stage(split.drop("_control"), "split")
    batches = split.groupBy(F.col(client).alias("client_id"), "_epoch", "_batch").agg(
        F.min(order).alias("_first"), F.max(order).alias("_end"), F.min("_seen").alias("_since"),
        F.count_if(F.coalesce(F.col(names.cursor) != "", F.lit(False))).alias("_reals"),
    )
    ends = batches.groupBy("client_id", "_epoch").agg(F.max("_batch").alias("_final"))
    current = marked.groupBy(F.col(client).alias("client_id")).agg(F.max("_epoch").alias("_current"))
    full = (F.col("_reals") >= batch_size) if batch_size > 0 else F.lit(False)
    past = F.col("_epoch") < F.col("_current")
    old = F.lit(False) if timeout_ms is None else (F.lit(now) - F.col("_since") >= timeout_ms) & (F.col("_reals") > 0)
    leaves = (F.col("_batch") < F.col("_final")) | (full & (past | F.lit(eager))) | (~past & old)
    batches = stage(
        batches.join(ends, ["client_id", "_epoch"]).join(current, "client_id")
        .withColumns({"_full": full, "_leaves": leaves, "_gone": past & ~leaves}),
        "batches",
    )

    flags = counters.filter("reset").select("client_id", F.lit(0).cast("bigint").alias("_epoch"), F.lit(0).cast("bigint").alias("_batch"))
    if names.control:
        flags = flags.unionByName(_flagged(marked, split, batches, names)).distinct()
    key = ["client_id", "_epoch", "_batch"]
    leaving = batches.filter("_leaves").join(flags.withColumn("_flag", F.lit(True)), key, "left").join(
        counters.select("client_id", "number"), "client_id", "left"
    )
    numbered = stage(
        assign_seqno(
            leaving, F.coalesce("number", F.lit(0)), "client_id", "_first", "batch_no", names.width
        ).select(*key, "batch_no", F.coalesce("_flag", F.lit(False)).alias("batch_reset")),
        "leaving",
    )
    open_flags = (
        flags.join(numbered, key, "left_anti").join(current, "client_id", "left")
        .filter(F.col("_epoch") == F.coalesce("_current", F.lit(0))).select("client_id").distinct().withColumn("_flag", F.lit(True))
    )
    counts = numbered.groupBy("client_id").agg((F.max("batch_no") + 1).alias("_number"))
    after = (
        counters.join(counts.join(current.select("client_id"), "client_id", "full_outer"), "client_id", "full_outer")
        .join(open_flags, "client_id", "left")
        .withColumns({"number": F.coalesce("_number", "number", F.lit(0)), "reset": F.coalesce("_flag", F.lit(False))})
        .select(*counters.columns)
    )
    keyed = split.withColumn("_client", F.col(client))
    same = lambda frame: frame.withColumnRenamed("client_id", "_client")
    keyed_by = ["_client", "_epoch", "_batch"]
    closed = keyed.join(same(numbered), keyed_by).select(*columns, "batch_no", "batch_reset")
    still = same(batches.filter("NOT _leaves AND NOT _gone").select(*key))
    return closed, keyed.join(still, keyed_by, "left_semi").select(*columns, "_seen"), after


def _flagged(marked: DataFrame, split: DataFrame, batches: DataFrame, names: Names) -> DataFrame:
    """(client_id, _epoch, _batch) of the batches that restarts and gaps make resetting ones."""
    client, order = names.client, names.order
    first = F.lit(0).cast("bigint").alias("_batch")
    restarts = marked.filter(F.col("_control") == RESTART).select(F.col(client).alias("client_id"), "_epoch", first)
    placed = previous_in_stream(
        marked.select(client, order, "_control", "_epoch"), {"_prev": order}, client, order, F.col("_control").isNull(), names.width
    )
    gaps = placed.filter(F.col("_control") == GAP).select(F.col(client).alias("client_id"), F.col("_epoch").alias("_at"), "_prev")
    held = split.select(F.col(client).alias("client_id"), F.col(order).alias("_prev"), "_epoch", "_batch")
    seen = gaps.join(held, ["client_id", "_prev"], "left").join(
        batches.select("client_id", "_epoch", "_batch", "_end", "_full"), ["client_id", "_epoch", "_batch"], "left"
    )
    # A full batch is closed once its last row is in.
    beyond = (F.col("_full") & (F.col("_end") == F.col("_prev"))).cast("bigint")
    batch = F.when(F.col("_epoch") == F.col("_at"), F.col("_batch") + beyond).otherwise(0)
    return restarts.unionByName(seen.select("client_id", F.col("_at").alias("_epoch"), batch.alias("_batch")))


def feedback_step(
    verdicts: DataFrame | None, counters: DataFrame, held: DataFrame | None, waiting: DataFrame | None, names: Names = Names()  # noqa: B008
) -> tuple[DataFrame, DataFrame | None, DataFrame | None]:
    """Act on verdicts not seen before: counters, open entries and waiting rows after.

    A client whose batch was refused for its position loses what is buffered and
    goes on from the expected position, or with a reset if there is none.
    """
    if verdicts is None:
        return counters, held, waiting
    fresh = verdicts.select("client_id", "arrival", "status", "expected_position").join(
        counters.select("client_id", "judged"), "client_id", "left"
    ).filter(F.col("judged").isNull() | (F.col("arrival") > F.col("judged")))
    refused = F.col("status") == REFUSED
    told = stage(
        fresh.groupBy("client_id").agg(
            F.max("arrival").alias("_judged"),
            F.max_by(F.coalesce("expected_position", F.lit("")), F.when(refused, F.col("arrival"))).alias("_expected"),
        ),
        "told",
    )
    after = counters.join(told, "client_id", "left").withColumns(
        {
            "judged": F.coalesce("_judged", "judged"),
            "exp_pos": F.coalesce("_expected", "exp_pos"),
            "reset": F.coalesce(F.col("_expected") == "", "reset"),
        }
    )
    stopped = told.filter(F.col("_expected").isNotNull()).select(F.col("client_id").alias(names.client))
    drop = lambda frame: None if frame is None else frame.join(stopped, names.client, "left_anti")
    return after.select(*counters.columns), drop(held), drop(waiting)


@dataclass
class CarriedFolder:
    """A stream's folder: its outputs, what is carried and its checkpoint."""

    spark: SparkSession
    path: str

    def __post_init__(self):
        self.folder = Folder(self.spark, self.path)

    def _at(self, name: str, batch_id: int) -> str:
        return f"{self.path}/carried/batch={batch_id}/{name}"

    def carried(self, name: str, batch_id: int) -> DataFrame | None:
        """What micro-batch ``batch_id`` left under that name."""
        if batch_id < 0 or not self.folder.exists(f"carried/batch={batch_id}/{name}"):
            return None
        return self.spark.read.parquet(self._at(name, batch_id))

    def last(self, name: str) -> DataFrame | None:
        """What the newest micro-batch left: what is still open in a stopped stream."""
        numbers = [int(n.partition("=")[2]) for n in self.folder.names("carried")]
        return self.carried(name, max(numbers, default=-1))

    def output(self, name: str, like: DataFrame | None = None) -> DataFrame | None:
        if not self.folder.exists(name):
            return None if like is None else like.limit(0)
        return self.spark.read.option("recursiveFileLookup", "true").parquet(f"{self.path}/{name}")

    def run(
        self,
        rows: DataFrame,
        step: Callable[[DataFrame, Callable[[str], DataFrame | None], int], tuple[dict[str, DataFrame], dict[str, DataFrame]]],
        trigger: dict | None = None,
        between: Callable[[int], None] | None = None,
        clock: Callable[[], int] | None = None,
    ) -> StreamingQuery:
        """Start the stream. ``step`` gives outputs and carried frames, by name.

        ``between`` is called between writing the outputs and what is carried.
        """
        clock = clock or (lambda: int(time.time() * 1000))

        def write(micro: DataFrame, batch_id: int) -> None:
            with working_folder(self.spark, "micro"):
                micro = stage(micro, "rows")
                outputs, left = step(micro, lambda name: self.carried(name, batch_id - 1), clock())
                for name, frame in outputs.items():
                    frame.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={batch_id}")
                if between is not None:
                    between(batch_id)
                for name, frame in left.items():
                    frame.write.mode("overwrite").parquet(self._at(name, batch_id))
            # The set before stays until the next batch: this one may run again.
            self.folder.remove(f"carried/batch={batch_id - 2}")

        return (
            rows.writeStream.foreachBatch(write)
            .option("checkpointLocation", f"{self.path}/checkpoint")
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )


def with_ticks(rows: DataFrame, names: Names = Names()) -> DataFrame:  # noqa: B008
    """The stream with a row a second that belongs to nobody, so that timeouts are looked at."""
    ticks = rows.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    return rows.unionByName(ticks.select(*empty))


def _without_ticks(rows: DataFrame, names: Names) -> DataFrame:
    return rows.filter(F.col(names.client).isNotNull() | F.col(names.order).isNotNull())


def _counters(found: DataFrame | None, spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], COUNTERS) if found is None else found


def merge_lines_stream(
    rows: DataFrame, path: str, start: str | Column, names: Names = Names(), max_messages: int = MAX_LINES,  # noqa: B008
    timeout_ms: int | None = MERGE_TIMEOUT_MS, **options
) -> StreamingQuery:
    """``multiline_merge`` on a stream: entries under ``path``/entries, open ones carried as ``held``."""

    def step(micro, carried, now):
        done, held = merge_step(_without_ticks(micro, names), carried("held"), start, now, names, max_messages, timeout_ms)
        return {"entries": done}, {"held": held}

    return CarriedFolder(rows.sparkSession, path).run(rows, step, **options)


def fill_batches_stream(
    rows: DataFrame, path: str, batch_size: int = BATCH_SIZE, max_bytes: int = BATCH_BYTES, names: Names = Names(),  # noqa: B008
    timeout_ms: int | None = BATCH_TIMEOUT_MS, size: Column | None = None, eager: bool = True, **options
) -> StreamingQuery:
    """``batch_split`` on a stream: rows under ``path``/closed, open batches carried as ``waiting``."""
    spark = rows.sparkSession

    def step(micro, carried, now):
        closed, waiting, counters = batch_step(
            _without_ticks(micro, names), carried("waiting"), _counters(carried("counters"), spark), now, names,
            batch_size, max_bytes, timeout_ms, size, eager,
        )
        return {"closed": closed}, {"waiting": waiting, "counters": counters}

    return CarriedFolder(spark, path).run(rows, step, **options)


@dataclass(frozen=True)
class ClientSettings:
    unit_mask: str = ""
    start_pattern: str = "^"
    message_pattern: str | None = None
    unit_pattern: str | None = None
    no_match: str = "send_raw"
    max_messages: int = MAX_LINES
    base: int = 0
    batch_size: int = BATCH_SIZE
    max_bytes: int = BATCH_BYTES
    merge_timeout_ms: int | None = MERGE_TIMEOUT_MS
    batch_timeout_ms: int | None = BATCH_TIMEOUT_MS
    names: Names = field(default_factory=lambda: Names(order="entry_seq"))


def client_stream(
    rows: DataFrame, path: str, settings: ClientSettings | None = None, verdicts: Callable[[], DataFrame | None] | None = None, **options
) -> StreamingQuery:
    """A client's whole path in one stream: filter, merge, parse, acknowledge, number, batch.

    Rows that leave are under ``path``/closed, with ``seqno``, ``position``,
    ``batch_no`` and ``batch_reset``. ``verdicts`` gives the verdicts there are when a
    micro-batch begins (``client_id, arrival, status, expected_position``; arrivals
    grow per client); each is acted on once, before the client's rows.
    """
    settings = settings or ClientSettings()
    spark, names = rows.sparkSession, settings.names
    batching = Names(names.client, "seqno", names.message, names.cursor, "position", None, names.width, names.batch_width)

    def step(micro, carried, now):
        counters, held, waiting = feedback_step(
            verdicts() if verdicts else None, _counters(carried("counters"), spark), carried("held"), carried("waiting"), names
        )
        kept = nonempty_message(unit_filter(_without_ticks(micro, names), settings.unit_mask))
        merged, held = merge_step(
            kept, held, settings.start_pattern, now, names, settings.max_messages, settings.merge_timeout_ms
        )
        parsed = parse_record(merged, settings.message_pattern, settings.unit_pattern, settings.no_match)
        stamped, counters = stamp_step(parsed, counters, settings.base, names)
        closed, waiting, counters = batch_step(
            stamped, waiting, counters, now, batching, settings.batch_size, settings.max_bytes, settings.batch_timeout_ms
        )
        return {"closed": closed}, {"held": held, "waiting": waiting, "counters": counters}

    return CarriedFolder(spark, path).run(rows, step, **options)
