"""The stored log table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.schema import LOG_TABLE, TableColumn, struct_of


def scan_log_table(
    spark: SparkSession, path: str, columns: list[TableColumn] = LOG_TABLE
) -> DataFrame:
    """All declared columns in declared order; Spark prunes what is not used."""
    schema = struct_of(columns)
    return spark.read.schema(schema).parquet(path).select(*schema.names)
