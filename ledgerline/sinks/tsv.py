"""Size-rotated TSV files, plain or zstd, published when all are written."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ledgerline.operators.export import in_ranges, render_rows, rotate_files

# Size limits, compressed-size check interval, file name form.
PLAIN_LIMIT = 200 * 1024 * 1024
ZSTD_LIMIT = 10 * 1024 * 1024
CHECK_EVERY = 1024 * 1024
FORMAT = "ledgerline_tsv"


def export_prefix(raw: str) -> str:
    """A plain local file name; path parts are cut off."""
    prefix = raw.strip().rstrip("/").rsplit("/", 1)[-1]
    if prefix in ("", ".", "..") or "\\" in prefix:
        raise ValueError("output prefix must be a non-empty local file name")
    return prefix


def _open_fs(path: str):
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path.removeprefix("file:")


def _manifest(prefix: str, run: str) -> str:
    return f"{prefix}-{run}.manifest"


def _staging(folder: str, prefix: str, run: str) -> str:
    return f"{folder}/.{prefix}-{run}"


def _exists(fs, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


def _drop_folder(folder: str) -> None:
    fs, root = _open_fs(folder)
    if _exists(fs, root):
        fs.delete_dir(root)


@dataclass(frozen=True)
class ExportStats:
    """What an export wrote: rows, files and the size of the last file."""

    rows_written: int
    files_written: int
    bytes_last_file: int


@dataclass
class TaskFiles(WriterCommitMessage):
    partition: int
    files: list[tuple[str, int, int]]


class _PlainFile:
    def __init__(self, fs, path: str):
        self.path, self.rows, self.size = path, 0, 0
        self._out = fs.open_output_stream(path)

    def room(self, limit: int) -> int:
        """Bytes to write before the size must be looked at."""
        return max(1, limit - self.size)

    def write(self, lines: bytes, rows: int) -> None:
        self._out.write(lines)
        self.size += len(lines)
        self.rows += rows

    def close(self) -> None:
        self._out.close()


class _ZstdFile(_PlainFile):
    """Compressed size is known after a flush, so it is looked at now and then."""

    def __init__(self, fs, path: str):
        import zstandard

        super().__init__(fs, path)
        self._coder = zstandard.ZstdCompressor().compressobj()
        self._flush_kind = zstandard.COMPRESSOBJ_FLUSH_BLOCK
        self._unchecked = 0

    def _put(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def room(self, limit: int) -> int:
        return CHECK_EVERY - self._unchecked

    def write(self, lines: bytes, rows: int) -> None:
        self._put(self._coder.compress(lines))
        self._unchecked += len(lines)
        self.rows += rows
        if self._unchecked >= CHECK_EVERY:
            self._put(self._coder.flush(self._flush_kind))
            self._unchecked = 0

    def close(self) -> None:
        self._put(self._coder.flush())
        self._out.close()


class TsvWriter(DataSourceArrowWriter):
    """Tasks write into a staging folder; ``commit`` numbers their files in a manifest.

    Earlier files of the prefix stay until then, so a failed run loses nothing.
    ``finish_exports`` gives the files their names.
    """

    def __init__(self, options: dict[str, str]):
        self.folder = options["path"].rstrip("/")
        self.prefix = options["prefix"]
        self.zstd = options.get("zstd", "false") == "true"
        self.limit = int(options["limit"])
        self.by_index = options.get("byindex", "false") == "true"
        self.run = options["run"]
        self.staging = _staging(self.folder, self.prefix, self.run)

    def write(self, batches: Iterator[pa.RecordBatch]) -> TaskFiles:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        fs, root = _open_fs(self.staging)
        fs.create_dir(root, recursive=True)
        make = _ZstdFile if self.zstd else _PlainFile
        attempt = uuid.uuid4().hex
        done: list[tuple[str, int, int]] = []
        current, index = None, None

        def finish(file):
            file.close()
            done.append((file.path, file.rows, file.size))

        for batch in batches:
            # A batch is cut into slices: one write for each, not one for each row.
            lines = batch.column("line")
            ends = np.cumsum(pc.binary_length(lines.cast(pa.binary())).to_numpy(zero_copy_only=False) + 1)
            indexes = batch.column("file_idx").to_numpy(zero_copy_only=False) if self.by_index else None
            begin, rows = 0, batch.num_rows
            while begin < rows:
                if current is not None and self.by_index and indexes[begin] != index:
                    finish(current)
                    current = None
                if current is None:
                    current = make(fs, f"{root}/{partition:08d}-{len(done):08d}-{attempt}")
                    index = indexes[begin] if self.by_index else None
                if self.by_index:
                    end = int(np.searchsorted(indexes, index, "right"))
                else:
                    before = ends[begin - 1] if begin else 0
                    end = min(rows, int(np.searchsorted(ends, before + current.room(self.limit))) + 1)
                part = lines.slice(begin, end - begin).to_pylist()
                current.write("\n".join([*part, ""]).encode(), end - begin)
                begin = end
                if not self.by_index and current.size >= self.limit:
                    finish(current)
                    current = None
        if current is not None:
            finish(current)
        return TaskFiles(partition, done)

    def commit(self, messages: list[TaskFiles | None]) -> None:
        """Write the manifest: from here on the export counts, whatever happens to this run."""
        fs, folder = _open_fs(self.folder)
        fs.create_dir(folder, recursive=True)
        ending = ".tsv.zst" if self.zstd else ".tsv"
        tasks = sorted((m for m in messages if m is not None), key=lambda m: m.partition)
        files = [file for task in tasks for file in task.files]
        lines = [
            json.dumps({"number": n, "staged": path, "name": f"{self.prefix}_{n:06d}{ending}", "rows": rows, "bytes": size})
            for n, (path, rows, size) in enumerate(files, 1)
        ]
        # A manifest takes its name once it is whole; half of one is never read.
        beside = f"{folder}/.{self.prefix}-{self.run}"
        with fs.open_output_stream(f"{beside}.part") as out:
            out.write("\n".join([*lines, ""]).encode())
        fs.move(f"{beside}.part", f"{folder}/{_manifest(self.prefix, self.run)}")

    def abort(self, messages) -> None:
        _drop_folder(self.staging)


class TsvSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "line string"

    def writer(self, schema, overwrite: bool) -> TsvWriter:
        return TsvWriter(dict(self.options))


def _resolved(spark, path: str) -> str:
    """The path with its scheme, as the rest of Spark resolves it; through mounts to where they lead."""
    at, below = spark._jvm.org.apache.hadoop.fs.Path(path), ""
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    at = fs.makeQualified(at)
    if at.toUri().getScheme() == "viewfs":
        while not fs.exists(at):
            at, below = at.getParent(), f"/{at.getName()}{below}"
        at = fs.resolvePath(at)
    full = at.toString().rstrip("/") + below
    return "/" + full.removeprefix("file:").lstrip("/") if full.startswith("file:") else full


def _qualified(spark, path: str) -> str:
    """The resolved path, which executors write to themselves.

    On a cluster a local folder has to be in one that the session shares: the
    checkpoint folder or the warehouse.
    """
    full = _resolved(spark, path)
    if full.startswith("/") and not (spark.conf.get("spark.master", "") or "").startswith("local"):
        roots = filter(None, (spark.conf.get(f"spark.{name}.dir", None) for name in ("checkpoint", "sql.warehouse")))
        if not any(f"{full}/".startswith(f"{_resolved(spark, root)}/") for root in roots):
            raise ValueError(f"{path} is a local folder: executors of a cluster can't share it")
    return full


def _save(lines: DataFrame, path: str, prefix: str, limit: int, zstd: bool, by_index: bool) -> ExportStats:
    spark = lines.sparkSession
    prefix = export_prefix(prefix)
    # An export that was cut off while its files got their names comes first: it is older.
    finish_exports(spark, path, prefix)
    spark.dataSource.register(TsvSource)
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
    lines.write.format(FORMAT).mode("append").options(
        path=_qualified(spark, path),
        prefix=prefix,
        limit=str(limit),
        zstd=str(zstd).lower(),
        byindex=str(by_index).lower(),
        run=run,
    ).save()
    return finish_exports(spark, path, prefix)[run]


MANIFEST = "number long, staged string, name string, rows long, bytes long"


def _in_tasks(rows: DataFrame, files: int, action) -> None:
    """``action(batches)`` over file rows, spread over the session's cores."""
    width = max(1, min(files, rows.sparkSession.sparkContext.defaultParallelism))
    rows.repartition(width).mapInArrow(action, "done long").agg(F.sum("done")).collect()


def _clear(folder: str):
    """Remove files of the last export: all that are not the new export's own."""

    def clear(batches):
        fs, root = _open_fs(folder)
        for batch in batches:
            for name, staged in zip(batch.column("name").to_pylist(), batch.column("staged").to_pylist()):
                # Without a staged twin the file of that name has been placed already.
                if (staged is None or _exists(fs, staged)) and _exists(fs, f"{root}/{name}"):
                    fs.delete_file(f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"done": [batch.num_rows]})

    return clear


def _place(folder: str):
    """Give staged files their names; a file that a task before has placed stays."""

    def place(batches):
        fs, root = _open_fs(folder)
        for batch in batches:
            for name, staged in zip(batch.column("name").to_pylist(), batch.column("staged").to_pylist()):
                if _exists(fs, staged):
                    try:
                        fs.move(staged, f"{root}/{name}")
                    except OSError:
                        # Another attempt of this task may have been faster.
                        if _exists(fs, staged):
                            raise
                if not _exists(fs, f"{root}/{name}"):
                    raise FileNotFoundError(f"{name} is neither staged nor placed")
            yield pa.RecordBatch.from_pydict({"done": [batch.num_rows]})

    return place


def finish_exports(spark, path: str, prefix: str) -> dict[str, ExportStats]:
    """Give the files of written exports their names, oldest first; statistics by run.

    While an export's manifest is in the folder, its files may still carry other
    names and old files may still be there. Tasks place the files, each on its own
    and as often as need be, so this also completes an export whose driver was lost.
    """
    folder = _qualified(spark, path)
    fs, root = _open_fs(folder)
    if not _exists(fs, root):
        return {}
    prefix = export_prefix(prefix)

    def listed() -> list[str]:
        return [i.base_name for i in fs.get_file_info(pafs.FileSelector(root)) if i.type == pafs.FileType.File]

    pending = re.compile(re.escape(prefix) + r"-([0-9]{20}-[0-9a-f]{32})\.manifest")
    ours = re.compile(re.escape(prefix) + r"_[0-9]{6,}\.tsv(\.zst)?")
    done = {}
    for run in sorted(m[1] for m in map(pending.fullmatch, listed()) if m):
        manifest = f"{folder}/{_manifest(prefix, run)}"
        files = spark.read.schema(MANIFEST).json(f"file://{manifest}" if manifest.startswith("/") else manifest)
        facts = files.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("files"),
            F.coalesce(F.max_by("bytes", "number"), F.lit(0)).alias("last"),
        ).first()
        there = [n for n in listed() if ours.fullmatch(n)]
        if there:
            old = spark.createDataFrame([(n,) for n in there], "name string").join(files, "name", "left")
            _in_tasks(old.select("name", "staged"), len(there), _clear(folder))
        _in_tasks(files.select("name", "staged"), facts.files, _place(folder))
        _drop_folder(_staging(folder, prefix, run))
        fs.delete_file(f"{root}/{_manifest(prefix, run)}")
        done[run] = ExportStats(facts.rows, facts.files, facts.last)
    return done


def write_tsv(
    df: DataFrame,
    path: str,
    prefix: str,
    order: list[str],
    columns: list[str] | None = None,
    limit: int = PLAIN_LIMIT,
    zstd: bool = False,
    rotation: str = "task",
    partitions: int | None = None,
) -> ExportStats:
    """Write rows in ``order`` to ``<prefix>_<NNNNNN>.tsv`` files.

    One range shuffle sorts the rows; every task renders, rotates and writes
    its range on its own, and files are numbered in range order. A file closes
    once it reaches the limit. With ``rotation='global'`` the cuts follow the
    running total over all rows instead (``rotate_files``): no short file at a
    range's end, for one more pass over the data. Returns what was written.
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    if rotation not in ("task", "global"):
        raise ValueError("rotation must be task or global")
    if rotation == "global" and zstd:
        raise ValueError("compressed sizes are only known while writing: use rotation='task'")
    columns = columns or df.columns
    if rotation == "global":
        placed = rotate_files(
            df, order, limit, partitions=partitions, prepare=lambda rows: render_rows(rows, columns)
        )
        # Whole files per task: the running total is also the order inside a file.
        lines = placed.repartitionByRange(partitions, "file_idx") if partitions else placed.repartitionByRange("file_idx")
        lines = lines.sortWithinPartitions("file_idx", "bytes_before").select("line", "file_idx")
        return _save(lines, path, prefix, limit, False, True)
    lines = render_rows(in_ranges(df, order, partitions), columns).select("line")
    return _save(lines, path, prefix, limit, zstd, False)


def write_tsv_zstd(
    df: DataFrame,
    path: str,
    prefix: str,
    order: list[str],
    columns: list[str] | None = None,
    limit: int = ZSTD_LIMIT,
    partitions: int | None = None,
) -> ExportStats:
    """As ``write_tsv``, compressed; the limit counts compressed bytes."""
    return write_tsv(df, path, prefix, order, columns, limit, zstd=True, partitions=partitions)


def read_tsv_zstd(spark, path: str, columns: list[str]) -> DataFrame:
    """Rows of zstd exports, decompressed file by file in tasks."""
    import zstandard

    def rows(batches):
        for batch in batches:
            for content in batch.column("content").to_pylist():
                with zstandard.ZstdDecompressor().stream_reader(content, read_across_frames=True) as reader:
                    held = b""
                    while block := reader.read(CHECK_EVERY):
                        *lines, held = (held + block).split(b"\n")
                        if lines:
                            yield pa.RecordBatch.from_pydict({"line": [l.decode() for l in lines]})

    files = spark.read.format("binaryFile").load(path).select("content")
    cells = F.split("line", "\t")
    return files.mapInArrow(rows, "line string").select(*[cells[i].alias(c) for i, c in enumerate(columns)])
