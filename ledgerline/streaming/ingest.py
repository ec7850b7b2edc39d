"""Batches from a stream into the log table, then the positions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ledgerline.plans.pipelines import IngestSettings, serve_batches
from ledgerline.session import stage, working_folder
from ledgerline.sinks.tables import LogTable, PositionTable
from ledgerline.sources.batches import split_batches
from ledgerline.storage import Folder


def ingest_stream(
    parsed: DataFrame,
    table: LogTable,
    positions: PositionTable,
    verdicts: str,
    checkpoint: str,
    settings: IngestSettings | None = None,
    trigger: dict | None = None,
    between: Callable[[int], None] | None = None,
) -> StreamingQuery:
    """Run ``scan_batches(..., streaming=True)`` output into the tables.

    Rows are durable before positions advance. A failure in between leaves the
    old positions; the micro-batch then runs again from the same positions and
    replaces its own rows, so nothing is lost or doubled. Batches are known by
    the id that Spark keeps with the checkpoint and their number, so a new
    checkpoint or a second stream into the same tables adds to them. ``between``
    is called between the two writes.
    """
    spark = parsed.sparkSession

    def write(micro: DataFrame, batch_id: int) -> None:
        stream = Folder(spark, checkpoint).read_json("metadata")["id"]
        with working_folder(spark, "micro"):
            batches = split_batches(stage(micro, "micro"))
            before = positions.read(before=batch_id, stream=stream)
            served = serve_batches(batches.envelopes, batches.records, before, settings)
            table.upsert(served.rows, batch_id, stream=stream)
            if between is not None:
                between(batch_id)
            positions.upsert(served.updates, batch_id, stream=stream)
            for name, frame in (("verdicts", served.verdicts), ("rejects", batches.rejects)):
                frame.write.mode("overwrite").parquet(f"{verdicts}/{name}/stream={stream}/batch={batch_id}")

    return (
        parsed.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
