"""Counts over batches, verdicts and exports; breaks between batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.streams import SEGMENT_WIDTH, previous_in_stream


def position_update(records: DataFrame, by: list[str]) -> DataFrame:
    """Highest number and time per batch or client; null when absent."""
    return records.groupBy(*by).agg(
        F.max("seqno").alias("seqno"),
        F.timestamp_micros(F.max("realtime_ts")).alias("ts_orig"),
        F.current_timestamp().alias("ts_wall"),
    )


def batch_stats(records: DataFrame, by: list[str], message: str = "message") -> DataFrame:
    return records.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.coalesce(F.sum(F.octet_length(message)), F.lit(0)).cast("bigint").alias("message_bytes"),
    )


def export_stats(rotated: DataFrame) -> DataFrame:
    """Rows, files and bytes of the last file, from rows with ``file_idx``."""
    files = rotated.groupBy("file_idx").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("line_bytes").alias("bytes")
    )
    return files.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows_written"),
        F.count(F.lit(1)).alias("files_written"),
        F.coalesce(F.max_by("bytes", "file_idx"), F.lit(0)).cast("bigint").alias("bytes_last_file"),
    )


def verdict_counts(verdicts: DataFrame) -> DataFrame:
    """Batches, records, mismatches and errors per client."""
    return verdicts.groupBy("client_id").agg(
        F.count(F.lit(1)).alias("batches"),
        F.coalesce(F.sum("n_records"), F.lit(0)).cast("bigint").alias("records"),
        F.count_if(F.col("status") == "position_mismatch").alias("mismatches"),
        F.count_if(F.col("status") == "error").alias("errors"),
    )


def continuity_gaps(envelopes: DataFrame, width: int = SEGMENT_WIDTH) -> DataFrame:
    """Batches that do not start where the client's previous batch ended."""
    seen = previous_in_stream(
        envelopes, {"previous_next": "next_position"}, "client_id", "arrival", width=width
    )
    return seen.filter(
        ~F.col("reset")
        & F.col("previous_next").isNotNull()
        & (F.col("current_position") != F.col("previous_next"))
    )
