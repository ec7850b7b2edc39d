"""Position lookups, resumption after a stored position, replay plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.streams import SEGMENT, SEGMENT_WIDTH, attach


def lookup_positions(clients: DataFrame, positions: DataFrame) -> DataFrame:
    """Stored position per client: ``ok``, ``not_found``, or an error for no id."""
    stored = positions.select("client_id", F.col("exp_pos").alias("current_position"), F.lit(True).alias("_found"))
    joined = clients.select("client_id").join(stored, "client_id", "left")
    missing_id = F.coalesce(F.col("client_id"), F.lit("")) == ""
    return joined.select(
        "client_id",
        F.when(missing_id, "error").when(F.col("_found"), "ok").otherwise("not_found").alias("status"),
        F.when(missing_id, F.lit(None)).otherwise(F.col("current_position")).alias("current_position"),
        F.when(missing_id, "client_id is required").alias("message"),
    )


def find_anchors(
    rows: DataFrame, positions: DataFrame, client: str = "client_id", order: str = "seqno", cursor: str = "cursor"
) -> DataFrame:
    """Order value of the row that carries exactly the stored cursor, per client."""
    wanted = positions.select(F.col("client_id").alias(client), F.col("exp_pos").alias(cursor)).filter(
        F.col(cursor) != ""
    )
    found = rows.select(client, cursor, order).join(wanted, [client, cursor])
    return found.groupBy(client).agg(F.max(order).alias("_anchor"))


def _with_anchors(rows: DataFrame, anchors: DataFrame, client: str, order: str, width: int) -> DataFrame:
    """Rows with what ``anchors`` (one row per client) holds for their client, else nulls.

    Anchors are given to the segments of each client first, so that rows are joined
    by (client, segment) and a client with most rows is as many keys as it has segments.
    """
    segment = F.coalesce(F.expr(f"`{order}` div {int(width)}"), F.lit(-1))
    parts = rows.withColumn(SEGMENT, segment)
    held = parts.select(client, SEGMENT).distinct().join(anchors, client)
    return attach(parts, held, client).drop(SEGMENT)


def resume_after(
    rows: DataFrame,
    positions: DataFrame,
    client: str = "client_id",
    order: str = "seqno",
    cursor: str = "cursor",
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """Rows after each client's stored cursor.

    Without a stored position, or when its cursor is not in the data exactly,
    all of the client's rows with ``reset`` true.
    """
    anchors = find_anchors(rows, positions, client, order, cursor)
    return (
        _with_anchors(rows, anchors, client, order, width)
        .filter(F.col("_anchor").isNull() | (F.col(order) > F.col("_anchor")))
        .withColumn("reset", F.col("_anchor").isNull())
        .drop("_anchor")
    )


def replay_plan(
    verdicts: DataFrame,
    rows: DataFrame,
    client: str = "client_id",
    order: str = "seqno",
    cursor: str = "cursor",
    width: int = SEGMENT_WIDTH,
) -> DataFrame:
    """For each client with a position mismatch: where to restart, what to drop.

    Its first mismatch decides. The restart is at the expected position if the
    data has exactly that cursor, else at the head with a reset. Rows buffered
    for later batches are dropped and come again from the restart position.
    """
    first = (
        verdicts.filter(F.col("status") == "position_mismatch")
        .groupBy("client_id")
        .agg(
            F.min("arrival").alias("rejected_arrival"),
            F.min_by("expected_position", "arrival").alias("expected_position"),
        )
    )
    anchors = find_anchors(
        rows, first.select("client_id", F.col("expected_position").alias("exp_pos")), client, order, cursor
    )
    plan = first.join(anchors.withColumnRenamed(client, "client_id"), "client_id", "left")
    plan = plan.select(
        "client_id",
        "rejected_arrival",
        "expected_position",
        F.when(F.col("_anchor").isNotNull(), F.col("expected_position")).alias("restart_position"),
        F.col("_anchor").isNull().alias("reset"),
        F.col("_anchor").alias("restart_after"),
    )
    wanted = plan.select(F.col("client_id").alias(client), "restart_after", F.lit(True).alias("_wanted"))
    counts = (
        _with_anchors(rows, wanted, client, order, width)
        .filter("_wanted")
        .groupBy(client)
        .agg(
            F.count_if(
                F.col("restart_after").isNull() | (F.col(order) > F.col("restart_after"))
            ).alias("replay_rows")
        )
    )
    return plan.join(counts.withColumnRenamed(client, "client_id"), "client_id", "left").withColumn(
        "replay_rows", F.coalesce("replay_rows", F.lit(0))
    )


def drop_buffered(buffered: DataFrame, plan: DataFrame, client: str = "client_id") -> DataFrame:
    """Buffered rows of clients whose stream does not restart."""
    return buffered.join(plan.select(F.col("client_id").alias(client)), client, "left_anti")
