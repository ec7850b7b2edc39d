"""Checks on batches: record errors and the chain of positions per client.

Whether a batch is accepted depends on the last accepted one, so the chain is
sequential. It is still computed in segments: a segment's effect on the state
is a small map (state in -> state out), maps fold into those of many segments in
a tree (``fold``), and each segment then judges its own batches from the state
carried into it. Only
envelopes take part; records never do.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.fold import FAN, states_before
from ledgerline.operators.streams import SEGMENT, with_segment
from ledgerline.session import stage

CHAIN_WIDTH = 1 << 18

# Statuses, messages and the codes they map to.
OK, MISMATCH, ERROR = "ok", "position_mismatch", "error"
NO_CLIENT = "client_id is required"
NO_NEXT = "next_position is required"
NO_CURRENT = "current_position is required when reset is false"
NO_STORED = "missing current_position or reset required"
NO_MESSAGE = "record must include message"
STORAGE_ERROR = "internal storage error"


def first_record_errors(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``record_error`` of every batch with a bad record: its first one.

    ``map_error`` and ``encode_error`` columns count when present. An encoding
    failure only shows once all records map, and as a storage error.
    """
    by = by or ["client_id", "arrival"]
    reason = F.when(F.coalesce(F.col("message"), F.lit("")) == "", F.lit(NO_MESSAGE))
    if "map_error" in records.columns:
        reason = F.coalesce(reason, F.col("map_error"))
    at = F.when(reason.isNotNull(), F.col("record_index"))
    text = F.concat(F.lit("invalid records["), F.col("record_index").cast("string"), F.lit("]: "), reason)
    aggregates = [F.min_by(text, at).alias("_invalid")]
    bad = reason.isNotNull()
    if "encode_error" in records.columns:
        bad = bad | F.col("encode_error").isNotNull()
        aggregates.append(F.count_if(F.col("encode_error").isNotNull()).alias("_encode"))
    out = records.filter(bad).groupBy(*by).agg(*aggregates)
    message = F.col("_invalid")
    if "encode_error" in records.columns:
        message = F.coalesce(message, F.when(F.col("_encode") > 0, F.lit(STORAGE_ERROR)))
    return out.select(*by, message.alias("record_error"))


def validate_records(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Records of fully valid batches: one bad record rejects its whole batch."""
    by = by or ["client_id", "arrival"]
    return records.join(first_record_errors(records, by), by, "left_anti")


def status_code(status: Column, message: Column) -> Column:
    bad_request = message.isin(NO_CLIENT, NO_NEXT, NO_CURRENT, NO_STORED) | F.startswith(message, F.lit("invalid"))
    return (
        F.when(status == OK, 200)
        .when(status == MISMATCH, 409)
        .when(F.coalesce(bad_request, F.lit(False)), 400)
        .otherwise(500)
    )


def _effects(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """A segment's map of states, built from its last batch backwards.

    Rows are (state in, state out); a null state in stands for every state, as
    once a reset is reached the state before no longer matters.
    """
    rows = rows.sort_values("arrival", kind="stable")
    effect: dict[str, str] = {}
    constant = None
    for reset, current, after in zip(
        rows["reset"].tolist()[::-1], rows["current_position"].tolist()[::-1], rows["next_position"].tolist()[::-1]
    ):
        out = constant if constant is not None else effect.get(after, after)
        out = effect.get(after, out) if constant is not None else out
        if reset:
            effect, constant = {}, out
        else:
            effect[current] = out
    pairs = list(effect.items()) + ([(None, constant)] if constant is not None else [])
    out = pd.DataFrame(pairs, columns=["state_in", "state_out"], dtype=object)
    return out.assign(client=key[0], segment=key[1])[["client", "segment", "state_in", "state_out"]]


EFFECT = "client string, segment bigint, state_in string, state_out string"


def _lookup(table: pd.DataFrame) -> tuple[dict, dict]:
    """A map as a dictionary, and the state that all others lead to, if any (under None).

    A row without a state out says only that the segment is there.
    """
    effect, constant = {}, {}
    for before, after in zip(table["state_in"], table["state_out"]):
        if not pd.isna(after):
            (constant if pd.isna(before) else effect)[None if pd.isna(before) else before] = after
    return effect, constant


def fold_effects(tables: list[pd.DataFrame]) -> pd.DataFrame:
    """The map of consecutive segments. A state that a segment doesn't know passes it."""
    whole, rest = _lookup(tables[0])
    for table in tables[1:]:
        effect, constant = _lookup(table)
        after = lambda state: effect.get(state, constant.get(None, state))  # noqa: B023, E731
        if not rest:
            # States unknown so far reach this segment unchanged.
            whole = {**{k: after(k) for k in effect}, **{k: after(v) for k, v in whole.items()}}
            rest = constant
        else:
            whole = {k: after(v) for k, v in whole.items()}
            rest = {None: after(rest[None])}
    pairs = [*whole.items(), *rest.items()] or [(None, None)]
    return pd.DataFrame(pairs, columns=["state_in", "state_out"], dtype=object)


def _pass(state: tuple | None, table: pd.DataFrame) -> tuple:
    """A client's state after a segment."""
    now = None if state is None else state[0]
    effect, constant = _lookup(table)
    return (constant.get(None) if now is None else effect.get(now, constant.get(None, now)),)


STATE = "state string"


def _judge(key: tuple, rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
    """Status of each batch of a segment from the state carried into it."""
    rows = rows.sort_values("arrival", kind="stable", ignore_index=True)
    state = states["state"].iloc[0] if len(states) else None
    state = None if pd.isna(state) else state
    result = []
    for arrival, reset, current, after, wrong in zip(
        rows["arrival"], rows["reset"], rows["current_position"], rows["next_position"], rows["record_error"]
    ):
        wrong = None if pd.isna(wrong) else wrong
        if not reset and state is None:
            result.append((arrival, ERROR, None, None, NO_STORED))
        elif not reset and current != state:
            result.append((arrival, MISMATCH, None, state, None))
        elif wrong is not None:
            result.append((arrival, ERROR, None, None, wrong))
        else:
            state = after
            result.append((arrival, OK, after, None, None))
    out = pd.DataFrame(
        result, columns=["arrival", "status", "next_position", "expected_position", "message"]
    )
    return out.assign(client_id=key[0])[
        ["client_id", "arrival", "status", "next_position", "expected_position", "message"]
    ]


JUDGED = (
    "client_id string, arrival bigint, status string, next_position string, "
    "expected_position string, message string"
)


def position_validate(
    envelopes: DataFrame, positions: DataFrame | None = None, width: int = CHAIN_WIDTH, fan: int = FAN
) -> DataFrame:
    """A verdict per batch: status, code, positions and message.

    ``envelopes`` has ``client_id, arrival, reset, current_position,
    next_position`` and optionally ``record_error``; ``positions`` holds the
    positions stored before. A batch with errors leaves the position as it was.
    """
    if "record_error" not in envelopes.columns:
        envelopes = envelopes.withColumn("record_error", F.lit(None).cast("string"))
    narrow = envelopes.select(
        "client_id", "arrival", F.coalesce("reset", F.lit(False)).alias("reset"),
        "current_position", "next_position", "record_error",
    )
    # Envelopes are read several times below and are small: write them once,
    # so that whatever made them (mapping all records, say) runs once.
    narrow = stage(narrow, "envelopes")

    def empty(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) == ""

    malformed = (
        F.when(empty("client_id"), NO_CLIENT)
        .when(empty("next_position"), NO_NEXT)
        .when(~F.col("reset") & empty("current_position"), NO_CURRENT)
    )
    null_text = F.lit(None).cast("string")
    refused = narrow.filter(malformed.isNotNull()).select(
        "client_id", "arrival", F.lit(ERROR).alias("status"), null_text.alias("next_position"),
        null_text.alias("expected_position"), malformed.alias("message"),
    )
    chained = with_segment(narrow.filter(malformed.isNull()), "arrival", width).withColumnRenamed(
        SEGMENT, "segment"
    )
    effects = (
        chained.filter(F.col("record_error").isNull())
        .select("client_id", "segment", "arrival", "reset", "current_position", "next_position")
        .groupBy("client_id", "segment")
        .applyInPandas(_effects, EFFECT)
    )
    effects = stage(effects, "effects")
    stored = None if positions is None else positions.select(F.col("client_id").alias("client"), F.col("exp_pos").alias("state"))
    # Only states that some segment leaves, or that are stored, can enter one.
    reachable = effects.select("client", F.col("state_out").alias("state_in"))
    if stored is not None:
        reachable = reachable.unionByName(stored.select("client", F.col("state").alias("state_in")))
    useful = effects.filter(F.col("state_in").isNotNull()).join(
        reachable.distinct(), ["client", "state_in"], "left_semi"
    )
    constants = effects.filter(F.col("state_in").isNull())
    every = chained.select(F.col("client_id").alias("client"), "segment").distinct().select(
        "client", "segment", null_text.alias("state_in"), null_text.alias("state_out")
    )
    maps = stage(useful.select(*every.columns).unionByName(constants).unionByName(every), "maps")
    states = states_before(maps, fold_effects, _pass, stored, STATE, [], "maps", fan)
    judged = (
        chained.groupBy("client_id", "segment")
        .cogroup(states.withColumnRenamed("client", "client_id").groupBy("client_id", "segment"))
        .applyInPandas(_judge, JUDGED)
    )
    return judged.unionByName(refused).select(
        "client_id", "arrival", "status", status_code(F.col("status"), F.col("message")).alias("code"),
        "next_position", "expected_position", "message",
    )


def accepted_positions(verdicts: DataFrame, updates: DataFrame) -> DataFrame:
    """The position row each client ends with: its last accepted batch's.

    ``updates`` holds the record maxima per batch (``position_update``); numbers
    come from the last accepted batch that has them.
    """
    accepted = verdicts.filter(F.col("status") == OK).join(updates, ["client_id", "arrival"], "left")

    def last_known(name: str) -> Column:
        return F.max_by(name, F.when(F.col(name).isNotNull(), F.col("arrival"))).alias(name)

    return accepted.groupBy("client_id").agg(
        F.max_by("next_position", "arrival").alias("exp_pos"),
        F.current_timestamp().alias("ts_wall"),
        last_known("seqno"),
        last_known("ts_orig"),
    )
