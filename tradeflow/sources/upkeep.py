"""Upkeep of a store of trades: rewriting days of the archive, deleting what is obsolete."""

from __future__ import annotations

import time
from typing import TYPE_CHECKING

from pyspark.sql import functions as F

from tradeflow.functions.time import day_of

if TYPE_CHECKING:
    from tradeflow.sources.store import TradeStore

FILE_BYTES = 256 << 20
_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def compact(store: TradeStore, before: int, file_bytes: int = FILE_BYTES) -> dict[str, int]:
    """Rewrite the archived days that ended by ``before`` (epoch ms) and lie in several
    pieces, in files of about ``file_bytes`` of shuffled rows, sorted by key.

    Equal rows stay equal in number; the rows' run becomes this one. Adaptive execution
    merges small partitions and splits large ones, so a large day is written by many
    tasks. Readers see a day's old pieces until this is committed.
    """
    state = store.state()
    closed = {day for day in state.pieces if len(day) == 10 and day < day_of(before)}
    days = sorted(day for day in closed if state.pieces[day] > 1 or day in state.bases)
    if not days:
        return {"run": state.run, "days": 0}
    run = store.begin(state)
    rows = store.cold_rows(state, [f"{store.cold_path}/day={day}" for day in days]).hint("rebalance", "day")
    place = {"tier": F.lit("cold"), "day": F.col("day"), "run": F.lit(run).cast("bigint")}
    rows = rows.withColumns(place).sortWithinPartitions(*place, "symbol", "ts")
    conf, advised = store.spark.conf, store.spark.conf.get(_SIZE, None)
    conf.set(_SIZE, str(file_bytes))
    try:
        store.write(rows, store.moves_path, *place)
    finally:
        conf.unset(_SIZE) if advised is None else conf.set(_SIZE, advised)
    pieces = {day: n for day, n in state.pieces.items() if day not in closed}
    store.commit(state, pieces=pieces, bases=state.bases | dict.fromkeys(days, run))
    return {"run": run, "days": len(days)}


def vacuum(store: TradeStore, older_than_s: float = 0) -> None:
    """Delete what runs committed at least ``older_than_s`` seconds ago have made
    obsolete. A read that began before must have ended by then."""
    states = store.states()
    for state in [s for s in states if s.at_ms <= 1000 * (time.time() - older_than_s)][-1:]:
        for folder in store.found(f"{store.hot_path}/writer=*/epoch=*"):
            writer, epoch = (x.split("=", 1)[1] for x in folder.rsplit("/", 2)[1:])
            if int(epoch) <= state.writers.get(writer, -1):
                store.drop(folder)
        left = state.run if state.left is None else state.left
        obsolete = [(f"{store.moves_path}/tier=hot/day=none", left), (store.state_path, state.run)]
        # Earlier vacuums have cleared the days of earlier runs.
        new = [(day, run) for day, run in state.bases.items() if run >= states[0].run]
        for path, first in [*obsolete, *((f"{store.cold_path}/day={day}", run) for day, run in new)]:
            for folder in store.found(f"{path}/run=*"):
                if int(folder.rsplit("=", 1)[1]) < first:
                    store.drop(folder)
