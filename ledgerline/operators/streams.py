"""Ordered work inside one client's stream, split into bounded segments.

A window partitioned by client puts a whole client into one task, and one
client may hold a large share of all rows. Here a stream is cut into segments
of the order column, so a group is (client, segment). The order column is
unique per client, so a segment never holds more rows than its width. What a
segment needs from the earlier ones is summarised in one row per segment,
carried along the client (few rows), and joined back on (client, segment):
the join reuses the window's own hash partitioning, so the rows themselves
are shuffled once.

The width is a span of order values. For dense numbers it is also the largest
number of rows in a segment; for sparse ones (microseconds, say) a larger width
keeps segments, and so summary rows, from becoming needlessly many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEGMENT = "_segment"
SEGMENT_WIDTH = 1 << 20


def with_segment(df: DataFrame, order: str, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Add the segment. A row without an order has no place in its stream: it fails the query.

    Filter such rows out before (see ``placed``), or number them.
    """
    if width < 1:
        raise ValueError("segment width must be positive")
    segment = F.expr(f"`{order}` div {int(width)}")
    missing = F.raise_error(F.lit(f"a row has no {order}: it has no place in its stream")).cast("bigint")
    return df.withColumn(SEGMENT, F.when(F.col(order).isNull(), missing).otherwise(segment))


def placed(df: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """The rows that have a place in their stream, and those that have none."""
    return df.filter(F.col(order).isNotNull()), df.filter(F.col(order).isNull())


def inside(client: str, order: str):
    """Window over one segment in stream order."""
    return Window.partitionBy(client, SEGMENT).orderBy(order)


def before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def so_far(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def along(client: str):
    """Window over a client's segment summaries."""
    return Window.partitionBy(client).orderBy(SEGMENT)


def attach(df: DataFrame, carried: DataFrame, client: str) -> DataFrame:
    """Give every row the values carried into its segment."""
    return df.join(carried, [client, SEGMENT], "left")


def previous_in_stream(
    df: DataFrame,
    values: dict[str, str],
    client: str = "client_id",
    order: str = "seqno",
    only: Column | None = None,
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Add columns of the previous row of the client's stream.

    ``values`` maps new column names to existing ones. With ``only``, the
    previous row for which it holds is taken.
    """
    parts = with_segment(df, order, width)
    held = F.struct(*[F.col(old).alias(new) for new, old in values.items()])
    if only is not None:
        held = F.when(only, held)
    window = inside(client, order)
    local = F.last(held, ignorenulls=True).over(before(window))

    ordering = F.col(order) if only is None else F.when(only, F.col(order))
    summary = parts.groupBy(client, SEGMENT).agg(F.max_by(held, ordering).alias("_last"))
    carried = summary.select(
        client,
        SEGMENT,
        F.last("_last", ignorenulls=True).over(before(along(client))).alias("_carried"),
    )
    out = attach(parts.withColumn("_local", local), carried, client)
    found = F.coalesce(F.col("_local"), F.col("_carried"))
    return out.select(*df.columns, *[found[new].alias(new) for new in values])


def running_count(
    df: DataFrame, flag: Column, to: str, client: str = "client_id", order: str = "seqno", width: int = SEGMENT_WIDTH
) -> DataFrame:
    """Add how many rows of the client's stream, up to and with this one, have the flag."""
    parts = with_segment(df, order, width)
    counts = parts.groupBy(client, SEGMENT).agg(F.count_if(flag).alias("_flags"))
    carried = counts.select(
        client, SEGMENT, F.coalesce(F.sum("_flags").over(before(along(client))), F.lit(0)).alias("_carried")
    )
    local = F.count_if(flag).over(so_far(inside(client, order)))
    out = attach(parts.withColumn("_local", local), carried, client)
    return out.select(*df.columns, (F.col("_local") + F.col("_carried")).alias(to))
