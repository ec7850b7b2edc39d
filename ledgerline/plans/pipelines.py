"""End-to-end pipelines: entries to table, table to TSV, batches to table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.parse import parse_record
from ledgerline.operators.export import render_rows, rotate_files
from ledgerline.operators.filters import in_lists, nonempty_message, time_range, unit_filter
from ledgerline.operators.mapping import (
    LOG_TABLE_MAPPING,
    FieldMapping,
    check_mapping,
    conform_schema,
    map_fields,
)
from ledgerline.operators.merge import latest_by_key, upsert_positions, upsert_rows
from ledgerline.operators.sequence import MAX_LINES, multiline_merge, stamp_entries
from ledgerline.operators.stats import position_update
from ledgerline.operators.validate import (
    OK,
    accepted_positions,
    first_record_errors,
    position_validate,
)
from ledgerline.schema import LOG_TABLE, LOG_TABLE_KEY, TableColumn
from ledgerline.session import stage


@dataclass(frozen=True)
class IngestSettings:
    unit_mask: str = ""
    start_pattern: str | None = None
    message_pattern: str | None = None
    unit_pattern: str | None = None
    no_match: str = "send_raw"
    max_messages: int = MAX_LINES
    #: Time column (microseconds) and the gap in it that ends an entry; no gap rule without both.
    gap_time: str | None = None
    gap_us: int | None = None
    base: int = 0
    mapping: list[FieldMapping] = field(default_factory=lambda: list(LOG_TABLE_MAPPING))
    columns: list[TableColumn] = field(default_factory=lambda: list(LOG_TABLE))
    keys: list[str] = field(default_factory=lambda: list(LOG_TABLE_KEY))


def accept_entries(
    entries: DataFrame, settings: IngestSettings, order: str = "entry_seq", start: str | DataFrame = ""
) -> DataFrame:
    """Filter, merge, parse, number and stamp raw entries.

    Merging and parsing run once: their result is written before the second
    ordered pass, which reads only order and cursor to place its carries.
    """
    kept = nonempty_message(unit_filter(entries, settings.unit_mask))
    merged = multiline_merge(
        kept,
        settings.start_pattern,
        order=order,
        max_messages=settings.max_messages,
        time=settings.gap_time,
        timeout_us=settings.gap_us,
    )
    parsed = parse_record(merged, settings.message_pattern, settings.unit_pattern, settings.no_match)
    return stamp_entries(stage(parsed, "accepted"), start, settings.base, order=order, to="seqno")


def to_table_rows(records: DataFrame, settings: IngestSettings, keep: list[str] | None = None) -> DataFrame:
    """Typed table rows with ``encode_error`` and ``map_error``."""
    check_mapping(settings.mapping, settings.columns, require_all=True)
    mapped = map_fields(records, settings.mapping, settings.columns, keep=keep)
    return conform_schema(mapped, settings.columns, [*(keep or []), "map_error"])


def ingest_batch(
    entries: DataFrame,
    settings: IngestSettings,
    target: DataFrame | None = None,
    order: str = "entry_seq",
    start: str | DataFrame = "",
) -> DataFrame:
    """Raw entries to log table rows, upserted over ``target``.

    A row that does not fit the table fails the query: nothing half-typed is
    stored.
    """
    accepted = accept_entries(entries, settings, order, start)
    rows = to_table_rows(accepted, settings, keep=[order])
    wrong = F.coalesce("map_error", "encode_error")
    first = settings.columns[0].name
    rows = rows.withColumn(
        first, F.when(wrong.isNotNull(), F.raise_error(wrong).cast(rows.schema[first].dataType)).otherwise(F.col(first))
    )
    names = [c.name for c in settings.columns]
    rows = rows.drop("map_error", "encode_error")
    if target is not None:
        # An upsert reads them twice: write them once, so that mapping runs once.
        rows = stage(rows, "fresh")
    return upsert_rows(target, rows, settings.keys, order).select(*names)


@dataclass(frozen=True)
class Ingested:
    """Table rows, and the records that do not fit the table.

    ``rejects`` holds each record's columns and its first fault in ``error``.
    """

    rows: DataFrame
    rejects: DataFrame


def ingest_accepting(
    entries: DataFrame,
    settings: IngestSettings,
    target: DataFrame | None = None,
    order: str = "entry_seq",
    start: str | DataFrame = "",
) -> Ingested:
    """As ``ingest_batch``, but a record that does not fit the table costs only itself.

    Records are mapped once and written with their faults; rows and rejects both
    read that table. Numbers and positions are given before, so they are those of
    a load in which every record fits.
    """
    accepted = accept_entries(entries, settings, order, start)
    record = "_record"
    names = [c.name for c in settings.columns]
    carried = accepted.withColumns({record: F.struct(*accepted.columns), f"_{order}": F.col(order)})
    mapped = to_table_rows(carried, settings, keep=[record, f"_{order}"])
    error = F.coalesce("map_error", "encode_error")
    # Only a rejected record is needed again as it came.
    mapped = mapped.select(*names, f"_{order}", F.when(error.isNotNull(), F.col(record)).alias(record), error.alias("error"))
    mapped = stage(mapped, "mapped")
    fits = mapped.filter(F.col("error").isNull()).select(*names, f"_{order}")
    rejects = mapped.filter(F.col("error").isNotNull()).select(f"{record}.*", "error")
    return Ingested(upsert_rows(target, fits, settings.keys, f"_{order}").select(*names), rejects)


def select_export(
    log: DataFrame,
    start: str,
    end: str,
    filters: list[str] | None = None,
    time: str = "ts_orig",
    date: str | None = None,
) -> DataFrame:
    return in_lists(time_range(log, start, end, time, date), filters or [])


def export_query(
    log: DataFrame,
    start: str,
    end: str,
    filters: list[str] | None = None,
    time: str = "ts_orig",
    ties: list[str] | None = None,
    limit: int = 200 * 1024 * 1024,
    date: str | None = None,
) -> DataFrame:
    """An interval of the log table as sorted TSV lines with file numbers.

    Sorting and numbering happen in ``rotate_files``: one range shuffle. ``date``
    names the column by which a table of ``sinks.dated`` is partitioned: only the
    interval's dates are read, and lines don't show it.
    """
    chosen = select_export(log, start, end, filters, time, date)
    columns = [c for c in log.columns if c != date]
    return rotate_files(
        chosen, [time, *(ties or [])], limit, prepare=lambda rows: render_rows(rows, columns)
    )


@dataclass(frozen=True)
class ServedBatches:
    """What a run of batches leaves: verdicts, rows to write, positions.

    ``updates`` are the positions of clients with an accepted batch;
    ``positions`` is everything stored before with these applied.
    """

    verdicts: DataFrame
    rows: DataFrame
    updates: DataFrame
    positions: DataFrame


def serve_batches(
    envelopes: DataFrame,
    records: DataFrame,
    positions: DataFrame | None = None,
    settings: IngestSettings | None = None,
) -> ServedBatches:
    """Judge batches, and derive the accepted rows and new positions.

    ``records`` carries ``client_id, arrival, record_index`` and the record's
    columns; (client_id, arrival) is unique, as ``split_batches`` sees to. Every record is mapped before judging, as one bad record rejects
    its batch.
    """
    settings = settings or IngestSettings()
    by = ["client_id", "arrival"]
    # What the record itself says keeps its own names, apart from table columns.
    own = {name: f"_record_{name}" for name in (*by, "record_index", "message", "seqno", "realtime_ts")}
    named = records.withColumns({kept: F.col(name) for name, kept in own.items()})
    mapped = to_table_rows(named, settings, keep=list(own.values()))
    # Judging needs every record mapped, writing needs the mapped rows again.
    mapped = stage(mapped, "mapped")
    facts = mapped.select(*[F.col(kept).alias(name) for name, kept in own.items()], "map_error", "encode_error")
    errors = first_record_errors(facts, by)
    verdicts = position_validate(
        envelopes.select("client_id", "arrival", "reset", "current_position", "next_position").join(
            errors, by, "left"
        ),
        positions,
    )
    verdicts = stage(verdicts, "verdicts")
    accepted = verdicts.filter(F.col("status") == OK).select(*[F.col(name).alias(own[name]) for name in by])
    rows = mapped.join(accepted, [own[name] for name in by], "left_semi")
    names = [c.name for c in settings.columns]
    ordering = [own[name] for name in ("arrival", "record_index", "client_id")]
    latest = latest_by_key(rows.select(*names, *ordering), settings.keys, F.struct(*ordering)).select(*names)
    updated = accepted_positions(verdicts, position_update(facts, by).drop("ts_wall"))
    return ServedBatches(verdicts, latest, updated, upsert_positions(positions, updated))
