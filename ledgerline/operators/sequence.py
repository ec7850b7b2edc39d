"""Multiline merge, acknowledged positions, sequence numbers, gap markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.regex import compile_pattern
from ledgerline.operators.streams import (
    SEGMENT,
    SEGMENT_WIDTH,
    along,
    attach,
    before,
    inside,
    previous_in_stream,
    so_far,
    with_segment,
)

MAX_LINES = 1000


def multiline_merge(
    df: DataFrame,
    start_pattern: str | Column | None,
    client: str = "client_id",
    order: str = "seqno",
    message: str = "message",
    cursor: str | None = "cursor",
    max_messages: int = MAX_LINES,
    time: str | None = None,
    timeout_us: int | None = None,
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Join continuation lines to the line that starts their entry.

    An entry begins at a line matching ``start_pattern``, at the client's first
    line, after ``max_messages`` lines, or after ``timeout_us`` without a line.
    A merged row keeps its first line's columns and its last line's cursor.
    """
    if start_pattern is None or (isinstance(start_pattern, str) and not start_pattern.strip()):
        return df
    max_messages = max(int(max_messages), 1)
    if isinstance(start_pattern, str):
        java = compile_pattern(start_pattern.strip()).java
        start = F.rlike(F.col(message), F.lit(java))
    else:
        start = start_pattern
    lines = df.withColumn("_start", F.coalesce(start, F.lit(False)))
    if time is not None and timeout_us is not None:
        lines = previous_in_stream(lines, {"_before": time}, client, order, width=width)
        gap = F.col(time) - F.col("_before") >= F.lit(timeout_us)
        lines = lines.withColumn("_start", F.col("_start") | F.coalesce(gap, F.lit(False))).drop("_before")

    placed = place_lines(lines, client, order, max_messages, width)
    return join_lines(placed, df.columns, client, order, message, cursor).select(*df.columns)


def place_lines(
    lines: DataFrame, client: str, order: str, max_messages: int, width: int = SEGMENT_WIDTH, counted: str | None = None
) -> DataFrame:
    """Add the entry of each line: ``_island`` and ``_part``, and whether it is its client's ``_last``.

    ``_start`` says where an island begins. A row stands for one line, or for
    ``counted`` lines: several for an entry merged before, none for a mark that
    only ends the entry before it. Marks get that entry's part as ``_ended``
    (null if it has no line); its island is the one before theirs.
    """
    window = inside(client, order)
    n = F.lit(1) if counted is None else F.col(counted)
    row = F.row_number().over(window) if counted is None else F.sum(counted).over(so_far(window))
    lines = with_segment(lines, order, width).withColumn("_row", row)
    # Number of the first line of the last start at or before this row, and starts so far.
    started = F.when(F.col("_start"), F.col("_row") - n + 1)

    summary = (
        lines.groupBy(client, SEGMENT)
        .agg(
            F.sum(n).alias("_rows"),
            F.max(started).alias("_last_start"),
            F.count_if("_start").alias("_starts"),
        )
    )
    chain = along(client)
    # Lines of the open entry at the end of a segment: all lines since the
    # last start, which may lie several segments back.
    total = F.sum("_rows").over(so_far(chain))
    summary = summary.withColumn("_total", total).withColumn(
        "_start_at", F.col("_total") - F.col("_rows") + F.col("_last_start") - 1
    )
    everything = chain.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lines_at_end = F.sum("_rows").over(everything) - F.coalesce(F.last("_start_at", ignorenulls=True).over(everything), F.lit(0))
    carried = summary.select(
        client,
        SEGMENT,
        F.coalesce(F.sum("_starts").over(before(chain)), F.lit(0)).alias("_islands"),
        F.coalesce(
            F.col("_total")
            - F.col("_rows")
            - F.coalesce(F.last("_start_at", ignorenulls=True).over(before(chain)), F.lit(0)),
            F.lit(0),
        ).alias("_open"),
        F.sum("_starts").over(everything).alias("_end_island"),
        F.floor((lines_at_end - 1) / F.lit(max_messages)).cast("bigint").alias("_end_part"),
    )

    since = {
        "_since": F.max(started).over(so_far(window)),
        "_island": F.sum(F.col("_start").cast("bigint")).over(so_far(window)),
    }
    if counted is not None:
        since["_since_before"] = F.max(started).over(before(window))
    lines = attach(lines.withColumns(since), carried, client)
    offset = F.when(F.col("_since").isNotNull(), F.col("_row") - F.col("_since")).otherwise(
        F.col("_open") + F.col("_row") - 1
    )
    places = {
        "_island": F.col("_islands") + F.col("_island"),
        "_part": F.floor(offset / F.lit(max_messages)).cast("bigint"),
    }
    if counted is not None:
        held = F.when(F.col("_since_before").isNotNull(), F.col("_row") - F.col("_since_before") + 1).otherwise(
            F.col("_open") + F.col("_row")
        )
        places["_ended"] = F.when((n == 0) & (held > 0), F.floor((held - 1) / F.lit(max_messages)).cast("bigint"))
    lines = lines.withColumns(places)
    return lines.withColumn("_last", (F.col("_island") == F.col("_end_island")) & (F.col("_part") == F.col("_end_part")))


def join_lines(
    placed: DataFrame, columns: list[str], client: str, order: str, message: str, cursor: str | None, extra: list[Column] | None = None
) -> DataFrame:
    """One row per entry: ``columns``, ``_island``, ``_part`` and the ``extra`` aggregates."""
    rest = [c for c in columns if c not in (client, message, cursor)]
    merged = placed.groupBy(client, "_island", "_part").agg(
        F.min_by(F.struct(*rest), order).alias("_head"),
        F.expr(f"listagg(coalesce(`{message}`, ''), '\\n') within group (order by `{order}`)").alias(message),
        *([F.max_by(cursor, order).alias(cursor)] if cursor else []),
        *(extra or []),
    )
    shown = [F.col(name) if name in (client, cursor, message) else F.col("_head")[name].alias(name) for name in columns]
    return merged.select(*shown, *[c for c in merged.columns if c not in (client, cursor, message, "_head")])


def ack_positions(
    df: DataFrame,
    start: str | DataFrame = "",
    client: str = "client_id",
    order: str = "seqno",
    cursor: str = "cursor",
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Stamp each kept entry with the cursor of the previous kept entry.

    Run it after the filters: dropped entries then do not advance positions.
    Rows without a cursor take the current position and do not advance it.
    ``start`` is one position for all, or a positions frame (with ``next_seqno``, of
    the next numbers too).
    """
    return stamp_entries(df, start, 0, client, order, cursor, "_number", width).drop("_number")


def assign_seqno(
    df: DataFrame,
    base: int | Column = 0,
    client: str = "client_id",
    order: str = "seqno",
    to: str = "seqno",
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Consecutive numbers per client from ``base``, in stream order."""
    parts = with_segment(df, order, width)
    counts = parts.groupBy(client, SEGMENT).agg(F.count(F.lit(1)).alias("_rows"))
    carried = counts.select(
        client, SEGMENT, F.coalesce(F.sum("_rows").over(before(along(client))), F.lit(0)).alias("_offset")
    )
    first = base if isinstance(base, Column) else F.lit(base).cast("bigint")
    numbered = attach(
        parts.withColumn("_row", F.row_number().over(inside(client, order))), carried, client
    ).withColumn("_number", first + F.col("_offset") + F.col("_row") - 1)
    kept = [c for c in df.columns if c != to]
    return numbered.select(*kept, F.col("_number").alias(to))


def stamp_entries(
    df: DataFrame,
    start: str | DataFrame = "",
    base: int | Column = 0,
    client: str = "client_id",
    order: str = "seqno",
    cursor: str = "cursor",
    to: str = "seqno",
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """``ack_positions`` and ``assign_seqno`` over one shared window and carry."""
    parts = with_segment(df.drop("position"), order, width)
    real = F.nullif(F.col(cursor), F.lit(""))
    summary = parts.groupBy(client, SEGMENT).agg(
        F.count(F.lit(1)).alias("_rows"), F.max_by(real, F.when(real.isNotNull(), F.col(order))).alias("_last")
    )
    chain = before(along(client))
    held = F.last("_last", ignorenulls=True).over(chain)
    offset = F.coalesce(F.sum("_rows").over(chain), F.lit(0))
    carried = summary.select(client, SEGMENT, offset.alias("_offset"), held.alias("_held"))
    if isinstance(start, DataFrame):
        # One row per segment meets the positions, not every log row.
        numbers = F.col("next_seqno") if "next_seqno" in start.columns else F.lit(None).cast("bigint")
        known = start.select(client, F.col("exp_pos").alias("_known"), numbers.alias("_next"))
        carried = carried.join(known, client, "left")
        carried = carried.withColumn("_held", F.coalesce("_held", "_known", F.lit(""))).drop("_known")
    else:
        carried = carried.withColumn("_held", F.coalesce("_held", F.lit(start)))
    else_first = base if isinstance(base, Column) else F.lit(base).cast("bigint")
    window = inside(client, order)
    stamped = parts.withColumns(
        {
            "_row": F.row_number().over(window),
            "_local": F.last(real, ignorenulls=True).over(before(window)),
        }
    )
    stamped = attach(stamped, carried, client)
    first = F.coalesce("_next", else_first) if "_next" in carried.columns else else_first
    kept = [c for c in df.columns if c not in (to, "position")]
    return stamped.select(
        *kept,
        (first + F.col("_offset") + F.col("_row") - 1).alias(to),
        F.coalesce("_local", "_held").alias("position"),
    )


def gap_markers(
    df: DataFrame,
    text: str,
    tag: str = "LEDGERLINE",
    gap_us: int | None = None,
    is_break: Column | None = None,
    client: str = "client_id",
    order: str = "seqno",
    cursor: str = "cursor",
    time: str = "realtime_ts",
    random_id: bool = False,
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """One synthetic record for every break in a stream.

    A row is the first after a break when ``is_break`` holds for it, or when
    its time is more than ``gap_us`` after the previous row's. The marker sits
    one millisecond after the last good row, takes that row's cursor as its
    position, and has no cursor itself.
    """
    if (gap_us is None) == (is_break is None):
        raise ValueError("give either gap_us or is_break")
    flagged = df.withColumn("_break", is_break if is_break is not None else F.lit(False))
    seen = previous_in_stream(
        flagged, {"_good_cursor": cursor, "_good_time": time, "_good_order": order}, client, order, width=width
    )
    after_gap = F.col("_break") if gap_us is None else F.col(time) - F.col("_good_time") > gap_us
    breaks = seen.filter(after_gap & F.col("_good_order").isNotNull())
    return breaks.select(*marker_columns(df, text, tag, client, order, cursor, time, random_id))


def marker_columns(df, text, tag, client, order, cursor, time, random_id):
    at = F.when(F.col("_good_time") > 0, F.col("_good_time") + 1000)
    shown = F.concat(
        F.replace(F.timestamp_micros(at).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z ")
    )
    digest = F.md5(F.col("_good_cursor"))
    # Version and variant bits as in a random UUID.
    variant = F.element_at(
        F.array(*[F.lit(c) for c in "89ab"]),
        (F.conv(F.substring(digest, 17, 1), 16, 10).cast("int") % 4) + 1,
    )
    stable_id = F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("4"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )
    made = {
        client: F.col(client),
        order: F.coalesce(F.floor(at / 1000).cast("bigint"), F.unix_millis(F.current_timestamp())),
        time: at,
        "priority": F.lit(2),
        "syslog_identifier": F.uuid() if random_id else stable_id,
        "systemd_unit": F.lit(tag),
        "message": F.concat(F.coalesce(shown, F.lit("")), F.lit(f":{tag} ALERT: {text}")),
        "position": F.col("_good_cursor"),
        cursor: F.lit(None).cast("string"),
    }
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [
        (made[n] if n in made else F.lit(None)).cast(types[n]).alias(n) for n in df.columns
    ]
    for name in ("position", "syslog_identifier", "systemd_unit", "priority", "message"):
        if name not in df.columns:
            columns.append(made[name].alias(name))
    columns.append(F.col("_good_order").alias("after_order"))
    return columns


def insert_markers(df: DataFrame, markers: DataFrame, order: str = "seqno") -> DataFrame:
    """The stream with its markers: sort by ``after_order`` and ``synthetic``."""
    return df.withColumns({"after_order": F.col(order), "synthetic": F.lit(False)}).unionByName(
        markers.withColumn("synthetic", F.lit(True)), allowMissingColumns=True
    )
