"""Key-based upserts as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: list[str], order: str | Column) -> DataFrame:
    """One row per key, the last by ``order``.

    Aggregated before the shuffle, so many copies of one key collapse where
    they are read.
    """
    rest = [c for c in df.columns if c not in keys]
    ordering = F.col(order) if isinstance(order, str) else order
    if not rest:
        return df.distinct()
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), ordering).alias("_row"))
    return last.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def upsert_rows(
    target: DataFrame | None, incoming: DataFrame, keys: list[str], order: str | list[str]
) -> DataFrame:
    """Target with incoming rows replacing those of the same key.

    Inside ``incoming`` the last row by ``order`` wins, so replaying a batch
    changes nothing. Key columns are required values. Target rows are only
    probed against the incoming keys: they are not re-sorted or re-aggregated.
    """
    names = [order] if isinstance(order, str) else order
    extra = [c for c in names if target is not None and c not in target.columns]
    fresh = latest_by_key(incoming, keys, F.struct(*names)).drop(*extra)
    if target is None:
        return fresh
    kept = target.join(fresh.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh.select(*target.columns))


def upsert_positions(stored: DataFrame | None, incoming: DataFrame) -> DataFrame:
    """Stored positions with incoming ones applied, one row per client.

    ``exp_pos`` and ``ts_wall`` are replaced; a null ``seqno`` or ``ts_orig``
    keeps the stored value.
    """
    if stored is None:
        return incoming.select("client_id", "exp_pos", "ts_wall", "seqno", "ts_orig")
    old, new = stored.alias("old"), incoming.alias("new")
    joined = old.join(new, F.col("old.client_id") == F.col("new.client_id"), "full_outer")
    replaced = F.col("new.client_id").isNotNull()

    def pick(name: str, merge: bool) -> Column:
        fresh = F.coalesce(f"new.{name}", f"old.{name}") if merge else F.col(f"new.{name}")
        return F.when(replaced, fresh).otherwise(F.col(f"old.{name}")).alias(name)

    return joined.select(
        F.coalesce("new.client_id", "old.client_id").alias("client_id"),
        pick("exp_pos", False),
        pick("ts_wall", False),
        pick("seqno", True),
        pick("ts_orig", True),
    )


def latest_position(versions: DataFrame, version: str = "version") -> DataFrame:
    """One position row per client out of several stored versions."""
    return latest_by_key(versions, ["client_id"], version).drop(version)
