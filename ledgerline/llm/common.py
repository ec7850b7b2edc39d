"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path
from ledgerline.storage import Folder

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Bits of a membership filter: it has at most FILTER_BITS / 64 rows of two longs
#: (1 MiB), however large the data are, so it may be broadcast.
FILTER_BITS = 1 << 22


def query(name: str, oracle: str | None = None):
    """Register a query (and the SQL that gives the same rows) under ``name``."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return add


#: Rows that go to a Python worker at once: texts are long, and a worker and its
#: executor both hold a batch.
ROWS_PER_BATCH = 1000


def prepare(spark: SparkSession) -> None:
    """Session settings that bound the memory of operators with Python functions."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_PER_BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, null texts as empty: other columns can't clash."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def crc_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % divisor


#: Rows of a few numbers and digests that one task writes.
ROWS_PER_TASK = 1 << 18


def tasks_for(spark: SparkSession, rows: int, each: int = ROWS_PER_TASK) -> int:
    """Tasks for so many rows: all cores at least, more as the rows grow."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(rows / each))


#: Rows of a few numbers and digests that one task may hold.
ROWS_IN_ONE = 1 << 16


def together(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in one partition if it has so few rows, else as it is.

    Steps over one partition need no shuffle. Each shuffle takes a thread of the driver,
    kept for a minute, so hundreds of them over next to no rows cost it more memory than
    those over many.
    """
    return df.coalesce(1) if rows <= ROWS_IN_ONE else df


class Workings:
    """Tables written to the shared folder while an operator builds its plan.

    ``drop`` removes those that no later step reads; what the returned frame
    still reads stays for the cluster's clean-up.
    """

    def __init__(self, label: str):
        self.label = label
        self._paths: dict[int, str] = {}

    def stage(self, df: DataFrame, step: str, tasks: int | None = None) -> DataFrame:
        """``df`` written and read back; by at most ``tasks`` tasks, if it is known to be small."""
        spark = df.sparkSession
        df = df if tasks is None else df.coalesce(tasks)
        path = scratch_path(spark, f"{self.label}-{step}")
        df.write.parquet(path)
        stored = spark.read.schema(df.schema).parquet(path)
        self._paths[id(stored)] = path
        return stored

    def stage_counted(self, df: DataFrame, step: str, tasks: int | None = None) -> tuple[DataFrame, int]:
        """As ``stage``, with the number of rows, observed while they are written.

        Tasks that ran twice may count twice: good for sizes, and 0 means none.
        """
        seen = Observation()
        stored = self.stage(df.observe(seen, F.count(F.lit(1)).alias("n")), step, tasks)
        return stored, seen.get["n"]

    def drop(self, *frames: DataFrame) -> None:
        """Remove the tables of frames that ``stage`` returned (and that are still held)."""
        for df in frames:
            Folder(df.sparkSession, self._paths.pop(id(df))).remove("")


def _slot(columns: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def membership(keys: DataFrame, columns: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """A bit table of the hashed keys: (word, mask), at most ``bits / 64`` rows."""
    return (
        keys.select(_slot(columns, bits).alias("s"))
        .select(F.shiftright("s", 6).alias("word"), F.expr("shiftleft(1L, int(s & 63))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("mask"))
    )


def with_maybe(df: DataFrame, columns: list[str], bit_table: DataFrame, name: str, bits: int = FILTER_BITS) -> DataFrame:
    """Add ``name``: false where the key is surely not in the filter, true where it may be.

    The join broadcasts the bit table, whose size has the bound of ``membership``;
    rows stay where they are, so large columns are not shuffled.
    """
    marked = df.withColumn("_slot", _slot(columns, bits)).withColumn("_word", F.shiftright("_slot", 6))
    found = bit_table.select(F.col("word").alias("_word"), F.col("mask").alias("_mask"))
    hit = F.expr("coalesce((shiftright(_mask, int(_slot & 63)) & 1L) = 1L, false)")
    return marked.join(F.broadcast(found), "_word", "left").withColumn(name, hit).drop("_word", "_slot", "_mask")
