"""States carried along a client's segments, by a tree of folded segment maps.

What a segment does to a state is a small table (its map). Maps of neighbouring
segments fold into one, ``FAN`` at a time and again, until a client has at most
``FAN`` of them. Then states go down the same tree: each group gets the state
before its first map and gives the state before each of them. A task holds the
maps of ``FAN`` neighbours at most, however many segments a client has.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import stage

FAN = 16


def _in_order(rows: pd.DataFrame, by: list[str]) -> list[tuple[int, pd.DataFrame]]:
    rows = rows.sort_values(by, kind="stable", ignore_index=True)
    return [(int(segment), table.reset_index(drop=True)) for segment, table in rows.groupby("segment", sort=False)]


def states_before(
    leaves: DataFrame,
    fold: Callable[[list[pd.DataFrame]], pd.DataFrame],
    step: Callable[[tuple | None, pd.DataFrame], tuple | None],
    start: DataFrame | None,
    state: str,
    by: list[str],
    label: str,
    fan: int = FAN,
) -> DataFrame:
    """(client, segment, state columns): the state before each segment.

    ``leaves`` is a stored frame with ``client, segment`` and the rows of each
    segment's map, in the order of ``by``. ``fold`` makes one map of several that
    follow each other; ``step`` takes a state (None: not known yet) over a map.
    ``start`` has the state before a client's first segment, ``state`` the schema
    of a state.
    """
    bits = fan.bit_length() - 1
    if fan != 1 << bits or bits < 1:
        raise ValueError("the fan must be a power of two")
    names = [column.split()[0] for column in state.split(",")]
    schema = leaves.schema

    def folded(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tables = [table for _, table in _in_order(rows, ["segment", *by])]
        whole = fold(tables) if len(tables) > 1 else tables[0]
        return whole.assign(client=key[0], segment=key[1])[schema.names]

    def walk(key: tuple, rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        now = tuple(None if pd.isna(v) else v for v in states[names].iloc[0]) if len(states) else None
        if now is not None and all(v is None for v in now):
            now = None
        out = []
        for segment, table in _in_order(rows, ["segment", *by]):
            out.append((key[0], segment, *(now if now is not None else [None] * len(names))))
            now = step(now, table)
        # Object columns keep whole numbers beside nulls.
        return pd.DataFrame(out, columns=["client", "segment", *names], dtype=object)

    levels = [leaves]
    low, high = leaves.agg(F.min("segment"), F.max("segment")).first()
    while low is not None and high - low >= fan:
        nodes = levels[-1].withColumn("node", F.shiftright("segment", bits)).groupBy("client", "node")
        levels.append(stage(nodes.applyInPandas(folded, schema), f"{label}-fold"))
        low, high = low >> bits, high >> bits
    if start is None:
        start = leaves.select("client").limit(0).selectExpr("client", *[f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in state.split(",")])
    made = f"client string, segment bigint, {state}"
    states = levels[-1].groupBy("client").cogroup(start.groupBy("client")).applyInPandas(walk, made)
    for level in levels[-2::-1]:
        nodes = level.withColumn("node", F.shiftright("segment", bits)).groupBy("client", "node")
        above = states.withColumnRenamed("segment", "node").groupBy("client", "node")
        states = nodes.cogroup(above).applyInPandas(walk, made)
    return states
