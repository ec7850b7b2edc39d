"""Tables in folders by date: reads skip other dates, upserts rewrite only touched ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.merge import latest_by_key
from ledgerline.schema import LOG_TABLE, TableColumn, struct_of
from ledgerline.session import require_utc, stage
from ledgerline.storage import Folder

DATE = "log_date"


def with_date(rows: DataFrame, time: str = "ts_orig", date: str = DATE) -> DataFrame:
    """Add the UTC date of ``time``; a row without a time has no date."""
    require_utc(rows.sparkSession)
    if date in rows.columns:
        raise ValueError(f"column {date!r} is already there")
    return rows.withColumn(date, F.to_date(time))


def _write(dated: DataFrame, path: str, time: str, date: str, mode: str) -> None:
    # Ranges of time, not hashes of dates: a date with most rows is many tasks, a task
    # holds few dates, and files are narrow in time. Times many rows share are split too.
    others = [c for c in dated.columns if c not in (time, date)]
    placed = dated.repartitionByRange(F.col(date), F.col(time), F.xxhash64(*others) if others else F.lit(0))
    writer = placed.sortWithinPartitions(date, time).write.mode(mode).partitionBy(date)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def append_dated(rows: DataFrame, path: str, time: str = "ts_orig", date: str = DATE) -> None:
    """Append to the dates' folders without looking for duplicates."""
    _write(with_date(rows, time, date), path, time, date, "append")


def scan_dated(spark: SparkSession, path: str, columns: list[TableColumn] = LOG_TABLE, date: str = DATE) -> DataFrame:
    """The declared columns, then the date: pass it to ``time_range`` or ``export_query``."""
    names = struct_of(columns).names
    schema = struct_of(columns).add(date, "date")
    return spark.read.schema(schema).parquet(path).select(*names, date)


def upsert_dated(
    rows: DataFrame,
    path: str,
    keys: list[str],
    order: str | list[str],
    time: str = "ts_orig",
    date: str = DATE,
) -> None:
    """Store ``rows``, replacing those of the same key; the last by ``order`` wins.

    ``time`` is one of the keys, so a row replaces rows of its own date only: other
    dates are neither read nor written. Keys are required values. A new table takes
    all columns of ``rows``, one that exists keeps its own.

    Each date is replaced as a whole when the job is done. If it fails in between,
    some dates may hold the new rows and others not yet; running it again gives the
    same table as one run.
    """
    if time not in keys:
        raise ValueError(f"{time} must be one of the keys: without it a row could replace one of another date")
    spark = rows.sparkSession
    names = [order] if isinstance(order, str) else order
    stored = None
    if Folder(spark, path).exists():
        stored = spark.read.parquet(path)
    fresh = with_date(latest_by_key(rows, keys, F.struct(*names)), time, date)
    if stored is not None:
        fresh = fresh.select(*stored.columns)
    fresh = stage(fresh, "dated")
    # One value per day, however many rows: a list of literals prunes the scan.
    dates = [r[0] for r in fresh.select(date).distinct().collect()]
    if None in dates:
        raise ValueError(f"a row has no {time}: it has no place in a table by date")
    if not dates:
        return
    if stored is not None:
        fresh = kept_rows(stored, fresh, dates, keys, date).unionByName(fresh)
    _write(fresh, path, time, date, "overwrite")


def kept_rows(stored: DataFrame, fresh: DataFrame, dates: list, keys: list[str], date: str = DATE) -> DataFrame:
    """Stored rows of the given dates that no fresh row replaces."""
    touched = stored.filter(F.col(date).isin(dates))
    return touched.join(fresh.select(*keys), keys, "left_anti")
