"""Cut a client's stream into batches bounded in records and in JSON bytes.

The cut is next-fit: a batch closes when the next row would overflow it, so
every cut depends on the one before. To keep one large client from being one
task, the work is split by segment:

1. per segment, for each row that could be the segment's first cut, where the
   chain of cuts from there ends (row pointers, doubled until they settle);
2. these maps of cuts fold into maps of many segments, in a tree (``fold``), and
   carry the open batch over it: a map has a row for each row that may be the
   first cut, so at most one batch's worth, however many segments it spans;
3. per segment, the actual cuts for the carried state.

Only order and sizes go through Python; full rows meet the cuts in a window.

A stream may fall into epochs, at whose first rows a batch ends in any case. They
are cuts like others: a segment is one group however many epochs it holds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.fields import (
    CURRENT_POSITION_BYTES,
    ENVELOPE_BYTES,
    json_text_bytes,
    record_json_bytes,
)
from ledgerline.operators.fold import FAN, states_before
from ledgerline.operators.streams import SEGMENT, with_segment
from ledgerline.session import stage

# Default batch limits.
BATCH_SIZE = 50_000
BATCH_BYTES = 15 * 1024 * 1024
# Four million rows of three numbers fit a Python worker easily.
BATCH_SEGMENT_WIDTH = 1 << 22


class FirstCuts:
    """Where the first cut falls, for any state carried into a stretch of rows.

    A state is ``(used, real)``: bytes of the open batch including its
    envelope, and its number of cursor-bearing rows. ``reach`` is what a row
    brings the stretch to, with its cursor as the batch's last. Epochs never fall.
    """

    def __init__(self, reach, real, max_rows, max_bytes, epochs=None):
        self.n = len(reach)
        self.epochs = np.zeros(self.n, np.int64) if epochs is None else epochs
        self.max_rows, self.max_bytes = max_rows, max_bytes
        self.reach = reach
        self.peak = np.maximum.accumulate(reach) if self.n else reach
        self.real_rows = np.flatnonzero(real)

    def _first_over(self, limits, floors):
        """First row at or after each floor whose reach exceeds the limit."""
        found = np.searchsorted(self.peak, limits, side="right")
        for k in np.flatnonzero((found < floors) & (floors < self.n)):
            over = np.flatnonzero(self.reach[floors[k] :] > limits[k])
            found[k] = floors[k] + over[0] if len(over) else self.n
        return np.where(floors >= self.n, self.n, np.maximum(found, np.minimum(floors, self.n)))

    def _row_of_real(self, ordinals):
        padded = np.append(self.real_rows, self.n)
        return padded[np.minimum(ordinals, len(self.real_rows))]

    def _break(self, limits, reals_before, floors, start_reals):
        by_bytes = self._first_over(limits, floors)
        if self.max_rows <= 0:
            return by_bytes
        by_count = self._row_of_real(np.maximum(start_reals + self.max_rows - reals_before, 0))
        return np.minimum(by_bytes, by_count)

    def first_cuts(self, used, real, epoch=None):
        """The first cut for each of many states; ``n`` where there is none.

        ``epoch`` is the one that all of them are in: that of the first row, if not given.
        """
        floors = np.where(real > 0, 0, int(self._row_of_real(np.array([0]))[0]) + 1)
        cuts = self._break(self.max_bytes - used, real, floors, np.zeros_like(real))
        epoch = self.epochs[0] if epoch is None else epoch
        return np.minimum(cuts, np.searchsorted(self.epochs, epoch, "right"))

    def first_cut(self, used: int, real: int, epoch: int | None = None) -> int:
        return int(self.first_cuts(np.array([used], np.int64), np.array([real], np.int64), epoch)[0])


class SegmentCuts(FirstCuts):
    """Next-fit over one segment's rows, for any state carried into it."""

    def __init__(self, size, next_size, open_size, real, max_rows, max_bytes, epochs=None):
        self.open_size = open_size
        self.size_before = np.concatenate(([0], np.cumsum(size + 1)))
        self.real_before = np.concatenate(([0], np.cumsum(real)))
        super().__init__(self.size_before[1:] + next_size, real, max_rows, max_bytes, epochs)

    def next_cuts(self):
        rows = np.arange(self.n)
        before = self.real_before[:-1]
        floors = self._row_of_real(before) + 1
        limits = self.max_bytes - self.open_size + self.size_before[:-1]
        cuts = self._break(limits, np.zeros_like(rows), np.maximum(floors, rows + 1), before)
        return np.minimum(cuts, np.searchsorted(self.epochs, self.epochs, "right"))

    def chains(self):
        """For each row as a batch start: the last start and the number of cuts after it."""
        following = self.next_cuts()
        rows = np.arange(self.n)
        pointer = np.where(following < self.n, following, rows)
        hops = (following < self.n).astype(np.int64)
        while True:
            further = pointer[pointer]
            if np.array_equal(further, pointer):
                return pointer, hops
            hops = hops + hops[pointer]
            pointer = further

    def state_after(self, start):
        """State at the segment's end when the last batch starts at ``start``."""
        return (
            self.open_size[start] + self.size_before[-1] - self.size_before[start],
            self.real_before[-1] - self.real_before[start],
        )


def _cuts_of(rows: pd.DataFrame, max_rows: int, max_bytes: int) -> tuple[pd.DataFrame, SegmentCuts]:
    rows = rows.sort_values(["order", "epoch"], kind="stable", ignore_index=True)
    cuts = SegmentCuts(
        rows["size"].to_numpy(),
        rows["next_size"].to_numpy(),
        rows["open_size"].to_numpy(),
        rows["real"].to_numpy().astype(np.int64),
        max_rows,
        max_bytes,
        rows["epoch"].to_numpy(),
    )
    return rows, cuts


def _candidates(max_rows: int, max_bytes: int):
    """Rows that may be a segment's first cut, with the state their chain leaves."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, cuts = _cuts_of(rows, max_rows, max_bytes)
        last_possible = min(cuts.first_cut(0, 0), cuts.n - 1)
        take = np.arange(last_possible + 1)
        last, hops = cuts.chains()
        used, real = cuts.state_after(last[take])
        # A chain that enters a later epoch counts from where the last epoch begins.
        epoch, ends_in = cuts.epochs[take], cuts.epochs[-1]
        fresh = epoch != ends_in
        hops = np.where(fresh, hops[np.searchsorted(cuts.epochs, ends_in, "left")], hops[take])
        return pd.DataFrame(
            {
                "client": key[0],
                "segment": key[1],
                "row": take,
                "n_rows": cuts.n,
                "reach": cuts.reach[take],
                "real": (cuts.real_before[1:] - cuts.real_before[:-1])[take],
                "hops": hops,
                "used_after": used,
                "real_after": real,
                "size_total": cuts.size_before[-1],
                "real_total": cuts.real_before[-1],
                "epoch": epoch,
                "fresh": fresh,
                "epoch_after": ends_in,
            }
        )

    return run


CANDIDATE = (
    "client string, segment bigint, row bigint, n_rows bigint, reach bigint, real bigint, "
    "hops bigint, used_after bigint, real_after bigint, size_total bigint, real_total bigint, "
    "epoch bigint, fresh boolean, epoch_after bigint"
)


def fold_cuts(tables: list[pd.DataFrame], max_rows: int, max_bytes: int) -> pd.DataFrame:
    """The map of consecutive segments: their candidates, as one stretch of rows."""
    whole = tables[0]
    for after in tables[1:]:
        whole = _joined(whole, after, max_rows, max_bytes)
    return whole


def _first_cuts(table: pd.DataFrame, max_rows: int, max_bytes: int) -> FirstCuts:
    return FirstCuts(table["reach"].to_numpy(), table["real"].to_numpy(), max_rows, max_bytes, table["epoch"].to_numpy())


def _joined(a: pd.DataFrame, b: pd.DataFrame, max_rows: int, max_bytes: int) -> pd.DataFrame:
    used, real = a["used_after"].to_numpy(), a["real_after"].to_numpy()
    epoch = int(a["epoch_after"].iloc[0])
    cut = _first_cuts(b, max_rows, max_bytes).first_cuts(used, real, epoch)
    # Without a cut in ``b`` its rows join the open batch.
    inside, at = cut < len(b), np.minimum(cut, len(b) - 1)
    fresh = inside & (b["fresh"].to_numpy()[at] | (b["epoch"].to_numpy()[at] != epoch))
    hops = np.where(fresh, 0, a["hops"].to_numpy() + inside) + np.where(inside, b["hops"].to_numpy()[at], 0)
    size_b, real_b = int(b["size_total"].iloc[0]), int(b["real_total"].iloc[0])
    rows = a.assign(
        hops=hops,
        fresh=a["fresh"].to_numpy() | fresh,
        used_after=np.where(inside, b["used_after"].to_numpy()[at], used + size_b),
        real_after=np.where(inside, b["real_after"].to_numpy()[at], real + real_b),
    )
    size_a, real_a, n_a = int(a["size_total"].iloc[0]), int(a["real_total"].iloc[0]), int(a["n_rows"].iloc[0])
    if len(a) == n_a:
        # Some state passes ``a`` without a cut: the first one may be in ``b``.
        rows = pd.concat([rows, b.assign(reach=b["reach"] + size_a)], ignore_index=True)
        last = _first_cuts(rows, max_rows, max_bytes).first_cut(0, 0)
        rows = rows.iloc[: last + 1]
    return rows.assign(
        row=np.arange(len(rows)), n_rows=n_a + int(b["n_rows"].iloc[0]), size_total=size_a + size_b, real_total=real_a + real_b,
        epoch_after=int(b["epoch_after"].iloc[0]),
    )


def _step(max_rows: int, max_bytes: int):
    def step(state, table: pd.DataFrame):
        used, real, number, epoch = state if state is not None else (None, 0, 0, None)
        if used is None:
            # The first row opens the batch of that number.
            cut, number = 0, int(number) - 1
        else:
            used, real = int(used), int(real)
            cut = _first_cuts(table, max_rows, max_bytes).first_cut(used, real, epoch)
        head = table.iloc[0]
        after = int(head["epoch_after"])
        if cut == len(table):
            return used + int(head["size_total"]), real + int(head["real_total"]), int(number), after
        at = table.iloc[cut]
        fresh = at["fresh"] or (epoch is not None and at["epoch"] != epoch)
        return int(at["used_after"]), int(at["real_after"]), (0 if fresh else int(number) + 1) + int(at["hops"]), after

    return step


#: The open batch: its bytes (null: none is open yet), its rows with a cursor, its number.
STATE = "used bigint, real bigint, number bigint"
_CARRIED = f"{STATE}, epoch bigint"


def _starts(max_rows: int, max_bytes: int):
    """The batch starts of one segment, given the state carried into it."""

    def run(key: tuple, rows: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        rows, cuts = _cuts_of(rows, max_rows, max_bytes)
        state = states.iloc[0]
        number = 0 if pd.isna(state["number"]) else int(state["number"])
        epochs = cuts.epochs.tolist()
        epoch = epochs[0] if pd.isna(state["epoch"]) else int(state["epoch"])
        if pd.isna(state["used"]):
            cut, opened = 0, []
            number -= 1
        else:
            cut = cuts.first_cut(int(state["used"]), int(state["real"]), epoch)
            # The carried batch opens the segment.
            opened = [(None, number, epoch)]
        following = cuts.next_cuts().tolist()
        order = rows["order"].tolist()
        while cut < cuts.n:
            number = number + 1 if epochs[cut] == epoch else 0
            epoch = epochs[cut]
            opened.append((order[cut], number, epoch))
            cut = following[cut]
        out = pd.DataFrame(opened, columns=["order", "batch_no", "epoch"]).astype({"order": "Int64"})
        return out.assign(client=key[0], segment=key[1])[["client", "segment", "order", "batch_no", "epoch"]]

    return run


START = "client string, segment bigint, order bigint, batch_no bigint, epoch bigint"


def wire_sizes(client: str, position: str, cursor: str, size: Column | None = None) -> dict[str, Column]:
    """The three numbers next-fit needs from a row, and whether it bears a cursor."""
    position_text = F.coalesce(F.col(position), F.lit(""))
    cursor_text = F.coalesce(F.nullif(F.col(cursor), F.lit("")), position_text)
    opening = F.when(position_text != "", json_text_bytes(position_text) + CURRENT_POSITION_BYTES).otherwise(0)
    # One less than the brackets: every record after the first adds a comma.
    return {
        "size": size if size is not None else record_json_bytes(),
        "next_size": json_text_bytes(cursor_text).cast("bigint"),
        "open_size": (opening + json_text_bytes(F.col(client)) + ENVELOPE_BYTES + 1).cast("bigint"),
        "real": F.coalesce(F.col(cursor) != "", F.lit(False)),
    }


def batch_split(
    df: DataFrame,
    batch_size: int = BATCH_SIZE,
    max_bytes: int = BATCH_BYTES,
    client: str = "client_id",
    order: str = "seqno",
    position: str = "position",
    cursor: str = "cursor",
    size: Column | None = None,
    width: int = BATCH_SEGMENT_WIDTH,
    start: DataFrame | None = None,
    fan: int = FAN,
    epoch: str | None = None,
) -> DataFrame:
    """Add ``batch_no``, counted from 0 per client.

    A batch holds at most ``batch_size`` rows with a cursor and ``max_bytes``
    of JSON. Rows without a cursor ride along and never fill a batch alone: a
    trailing batch of only such rows is still pending (``batch_envelopes``
    leaves it out). A single row over the limit fails the query. ``start``
    (client and ``STATE``) continues batches that are open already. ``epoch`` names a
    number that never falls along a stream: where it grows a batch begins, and
    batches are counted from 0 again.
    """
    sizes = wire_sizes(client, position, cursor, size)
    narrow = with_segment(
        df.select(
            F.col(client).alias("client"), F.col(order).alias("order"), *[c.alias(n) for n, c in sizes.items()],
            (F.col(epoch) if epoch else F.lit(0)).cast("bigint").alias("epoch"),
        ),
        "order",
        width,
    ).withColumnRenamed(SEGMENT, "segment")
    alone = F.col("size") + 1 + F.col("next_size") + F.col("open_size")
    narrow = narrow.withColumn(
        "size",
        F.when(
            alone > max_bytes,
            F.raise_error(
                F.concat(
                    F.lit("record JSON exceeds maximum batch request size: "), alone.cast("string"),
                    F.lit(f" bytes (limit {max_bytes})"),
                )
            ).cast("bigint"),
        ).otherwise(F.col("size")),
    )
    grouped = narrow.groupBy("client", "segment")
    maps = stage(grouped.applyInPandas(_candidates(batch_size, max_bytes), CANDIDATE), "cuts")
    if start is not None:
        start = start.withColumn("epoch", F.lit(None).cast("bigint"))
    states = states_before(
        maps, lambda tables: fold_cuts(tables, batch_size, max_bytes), _step(batch_size, max_bytes), start, _CARRIED, ["row"], "cuts", fan
    )
    starts = grouped.cogroup(states.groupBy("client", "segment")).applyInPandas(
        _starts(batch_size, max_bytes), START
    )
    # Rows and starts meet in one window: the last start at or before a row.
    marks = starts.select(
        F.col("client").alias(client),
        F.col("segment").alias(SEGMENT),
        F.col("order").alias(order),
        F.col("batch_no").alias("batch_no"),
        *([F.col("epoch").alias(epoch)] if epoch else []),
        F.lit(False).alias("_is_row"),
    )
    rows = with_segment(df, order, width).withColumn("_is_row", F.lit(True))
    window = Window.partitionBy(client, SEGMENT).orderBy(F.col(order).asc_nulls_first(), *([epoch] if epoch else []), "_is_row")
    together = rows.unionByName(marks, allowMissingColumns=True)
    return (
        together.withColumn("batch_no", F.last("batch_no", ignorenulls=True).over(window))
        .filter("_is_row")
        .select(*df.columns, "batch_no")
    )


def ordered_list(order: Column, item: Column) -> Column:
    """Aggregate of a group's items in order; items may hold maps."""

    def by_order(a: Column, b: Column) -> Column:
        return F.when(a["o"] < b["o"], -1).when(a["o"] > b["o"], 1).otherwise(0)

    pairs = F.collect_list(F.struct(order.alias("o"), item.alias("r")))
    return F.transform(F.array_sort(pairs, by_order), lambda x: x["r"])


def batch_envelopes(
    df: DataFrame,
    client: str = "client_id",
    order: str = "seqno",
    position: str = "position",
    cursor: str = "cursor",
    records: Column | None = None,
) -> DataFrame:
    """One row per finished batch: positions, record count, time and number maxima.

    With ``records`` (a struct per row) the records are collected in order; a
    batch is bounded by its limits, so the array is too.
    """
    real = F.nullif(F.col(cursor), F.lit(""))
    aggregates = [
        F.min_by(position, order).alias("current_position"),
        F.max_by(real, F.when(real.isNotNull(), F.col(order))).alias("next_position"),
        F.count(F.lit(1)).alias("n_records"),
    ]
    if records is not None:
        aggregates.append(
            ordered_list(F.col(order), records).alias("_records")
        )
    out = df.groupBy(client, "batch_no").agg(*aggregates).filter(F.col("next_position").isNotNull())
    if records is not None:
        out = out.withColumnRenamed("_records", "records")
    return out

