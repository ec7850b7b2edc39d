"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def build_session(app: str = "ledgerline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library relies on (UTC, AQE, RocksDB state)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> None:
    """Runtime settings the library relies on, for a session made elsewhere."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    path on one machine is not visible to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not (spark.conf.get("spark.master", "") or "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    fallback = tempfile.mkdtemp(prefix="ledgerline-")
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


_WORKING: ContextVar[str | None] = ContextVar("working", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; never reused, so never overwritten."""
    root = _WORKING.get() or f"{shared_dir(spark)}/ledgerline"
    return f"{root}/{label}-{uuid.uuid4().hex}"


@contextmanager
def working_folder(spark: SparkSession, label: str):
    """Everything staged inside goes to one folder, which is removed at the end.

    For work whose results are written somewhere else before the end.
    """
    from ledgerline.storage import Folder

    path = scratch_path(spark, label)
    token = _WORKING.set(path)
    try:
        yield path
    finally:
        _WORKING.reset(token)
        Folder(spark, path).remove("")


def stage(df, label: str):
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage durably: a lost executor costs a re-read, not a recompute,
    and later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00", "GMT"):
        raise ValueError(f"timestamps are rendered in UTC; session time zone is {zone}")
