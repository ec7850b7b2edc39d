"""Batch envelopes from newline-delimited JSON files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.schema import BATCH

# Fixed value: largest decoded batch.
MAX_BATCH_BYTES = 32 * 1024 * 1024
_BROKEN = "_broken"
NO_ARRIVAL = "arrival is required"
REPEATED_ARRIVAL = "arrival is repeated"


@dataclass(frozen=True)
class Batches:
    """Three views of the same lines."""

    envelopes: DataFrame
    records: DataFrame
    rejects: DataFrame


def parse_batches(lines: DataFrame, max_bytes: int = MAX_BATCH_BYTES, value: str = "value") -> DataFrame:
    """One row per line: the batch, or a ``code`` and ``error`` for a refused line."""
    schema = T.StructType([*BATCH.fields, T.StructField(_BROKEN, T.StringType())])
    lines = lines.filter(F.btrim(F.col(value)) != "")
    too_large = F.octet_length(F.col(value)) > max_bytes
    parsed = lines.withColumn(
        "_batch",
        F.when(
            ~too_large,
            F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}),
        ),
    )
    broken = F.col(f"_batch.{_BROKEN}").isNotNull()
    error = (
        F.when(too_large, "request body is too large")
        .when(broken, "invalid JSON")
        # Without it a batch has no place in its client's chain.
        .when(F.col("_batch.arrival").isNull(), NO_ARRIVAL)
    )
    return parsed.select(
        F.col(value).alias("line"),
        F.when(too_large, 413).when(error.isNotNull(), 400).alias("code"),
        error.alias("error"),
        *[F.col(f"_batch.{f.name}").alias(f.name) for f in BATCH.fields],
    ).withColumn("reset", F.coalesce("reset", F.lit(False)))


def batch_records(parsed: DataFrame) -> DataFrame:
    """One row per record with its batch's columns and ``record_index``."""
    exploded = parsed.filter(F.col("code").isNull()).select(
        "client_id", "reset", "current_position", "next_position", "arrival",
        F.posexplode_outer("records").alias("record_index", "record"),
    )
    return exploded.select(*[c for c in exploded.columns if c != "record"], "record.*")


def split_batches(parsed: DataFrame) -> Batches:
    """Envelopes, records and refused lines.

    Batches are told apart by client and arrival: lines that repeat a pair are
    refused, all of them, as their order is not known.
    """
    by = ["client_id", "arrival"]
    sound = parsed.filter(F.col("code").isNull())
    repeated = sound.groupBy(*by).count().filter("count > 1").select(*by)
    accepted = sound.join(repeated, by, "left_anti")
    again = sound.join(repeated, by, "left_semi").select("line", F.lit(400).alias("code"), F.lit(REPEATED_ARRIVAL).alias("error"))
    return Batches(
        envelopes=accepted.select(
            "client_id", "arrival", "reset", "current_position", "next_position",
            F.coalesce(F.size("records"), F.lit(0)).alias("n_records"),
        ),
        records=batch_records(accepted).filter(F.col("record_index").isNotNull()),
        rejects=parsed.filter(F.col("code").isNotNull()).select("line", "code", "error").unionByName(again),
    )


def scan_batches(
    spark: SparkSession, path: str, streaming: bool = False, max_bytes: int = MAX_BATCH_BYTES
) -> DataFrame:
    """Parsed batch lines, plain or gzip; see ``batch_records`` and ``split_batches``."""
    reader = spark.readStream if streaming else spark.read
    return parse_batches(reader.text(path), max_bytes)
