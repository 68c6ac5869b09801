"""Hot and cold trades under one root folder, as partitioned Parquet.

The hot table is keyed by ``(symbol, ts)`` and the last write wins. A move takes all
hot rows older than a cutoff to cold; compaction rewrites the days of cold::

    hot/writer=W/epoch=E/                  one append, distinct keys
    moves/tier=cold/day=D/run=N/           rows of day D that run N archived or rewrote
    moves/tier=hot/day=none/run=N/         rows that move N left hot
    state/run=N/                           run N is committed: one row

Every write overwrites its own partitions only (dynamic partition overwrite), so an
epoch that a stream runs again replaces itself. A run's row of state commits it: the
last epoch of each writer that moves have taken, the run whose hot rows are left, and
the run from which a compacted day is valid. All are tests on partition columns.

Any number of writers append, each in the order of its epochs; one job at a time moves
and compacts.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql import types as T

from tradeflow.functions.time import bound, day_of
from tradeflow.operators.latest import latest_per_key
from tradeflow.operators.trades import older_than
from tradeflow.schemas import TRADES
from tradeflow.sources import upkeep
from tradeflow.sources.upkeep import FILE_BYTES

KEY = ["symbol", "ts"]
VALUES = ["price", "volume", "at"]

_AT = T.StructField("at", T.LongType())  # when the append began, ns
_HOT = T.StructType([*TRADES.fields, _AT]).add("writer", "string").add("epoch", "long")
_LEFT = T.StructType([*TRADES.fields, _AT])
_COLD = T.StructType([*TRADES.fields]).add("day", "string").add("run", "long")
_NUMBERS = T.MapType(T.StringType(), T.LongType())
# Of a run: the run that holds the rows left hot; the last epoch taken of each writer;
# the pieces of each day since it was compacted; the run from which a day is valid.
_STATE = T.StructType().add("left", "long").add("writers", _NUMBERS).add("pieces", _NUMBERS)
_STATE = _STATE.add("bases", _NUMBERS).add("at_ms", "long").add("run", "long")


def _known(values: dict[str, int], name: str) -> Column:
    """The value for the name in a column, -1 where there is none."""
    if not values:
        return F.lit(-1).cast("bigint")
    pairs = [F.lit(x) for name_value in values.items() for x in name_value]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(name)).cast("bigint"), F.lit(-1))


class TradeStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.hot_path, self.moves_path, self.state_path = (f"{self.root}/{x}" for x in ("hot", "moves", "state"))
        self.cold_path = f"{self.moves_path}/tier=cold"
        self.writer, self.epoch = f"batch-{uuid.uuid4().hex}", 0
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in (self.hot_path, self.cold_path, self.state_path):
            self._files.mkdirs(path(folder))

    def found(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        return [s.getPath().toString() for s in self._files.globStatus(path) or []]

    def drop(self, folder: str) -> None:
        self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(folder), True)

    def write(self, rows: DataFrame, path: str, *partitions: str) -> None:
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partitions).parquet(path)

    def states(self) -> list[Row]:
        """Committed runs, first one first; ``vacuum`` keeps them few."""
        # A vacuum may delete old rows meanwhile, never the last one.
        rows = self.spark.read.schema(_STATE).option("ignoreMissingFiles", True).parquet(self.state_path)
        return sorted(rows.collect(), key=lambda s: s.run)

    def state(self) -> Row:
        return (self.states() or [Row(left=None, writers={}, pieces={}, bases={}, at_ms=0, run=0)])[-1]

    def commit(self, state: Row, **changes) -> None:
        row = {**state.asDict(), "run": state.run + 1, "at_ms": time.time_ns() // 1_000_000, **changes}
        rows = self.spark.createDataFrame([tuple(row[f] for f in _STATE.names)], _STATE)
        self.write(rows.coalesce(1), self.state_path, "run")

    def append(
        self, trades: DataFrame, order: list[str] | None = None, writer: str | None = None, epoch: int = 0
    ) -> dict[str, int]:
        """Write trades ``symbol, ts (timestamp), price, volume`` over the table.

        Within one call the row with the greatest ``order`` wins, and across calls the
        one that began later. Rows without a full key cannot be stored and are counted.
        A named writer numbers its calls by ``epoch``, upwards: an epoch that comes
        again replaces itself, and has no effect once a move has taken it.
        """
        if writer is None:
            writer, epoch, self.epoch = self.writer, self.epoch, self.epoch + 1
        if not re.fullmatch(r"[\w.-]+", writer):
            raise ValueError(f"a writer's name has letters, digits, _, . and - only: {writer}")
        keyed, seen = F.col("symbol").isNotNull() & F.col("ts").isNotNull(), Observation()
        counts = [F.count(F.lit(1)).alias("rows"), F.count_if(~keyed).alias("without_key")]
        unique = latest_per_key(trades.observe(seen, *counts).filter(keyed), KEY, order or [], VALUES[:2])
        own = {"at": F.lit(time.time_ns()), "writer": F.lit(writer), "epoch": F.lit(epoch).cast("bigint")}
        # A read of few symbols opens few files. The ranges are sampled from the
        # shuffle of the aggregate, so the trades are not read again.
        rows = unique.withColumns(own).select(*_HOT.names).repartitionByRange(*KEY)
        self.write(rows.sortWithinPartitions("writer", "epoch", *KEY), self.hot_path, "writer", "epoch")
        return dict(seen.get)

    def _appended(self, state: Row) -> DataFrame:
        rows = self.spark.read.schema(_HOT).parquet(self.hot_path)
        return rows.filter(F.col("epoch") > _known(state.writers, "writer"))

    def _latest(self, appended: DataFrame, state: Row, by_day: bool = False) -> DataFrame:
        """Latest row per key of what the last move left hot and of later appends.

        With ``by_day`` the rows come range partitioned by day and key. Copies of a key
        share a range, so no second shuffle is needed to find the latest, and a hot
        symbol is cut by time. Each append has distinct keys, so no pile of copies
        can build up.
        """
        rows, keys = appended.select(*_LEFT.names), KEY
        if state.left is not None:
            left = f"{self.moves_path}/tier=hot/day=none/run={state.left}"
            rows = rows.unionByName(self.spark.read.schema(_LEFT).parquet(left))
        if by_day:
            keys = ["day", *KEY]
            rows = rows.withColumn("day", F.to_date("ts")).repartitionByRange(*keys)
        return latest_per_key(rows, keys, ["at"], VALUES)

    def read_hot(self) -> DataFrame:
        """The hot table as of now: the latest row of each key."""
        state = self.state()
        return self._latest(self._appended(state), state).select(*TRADES.names)

    def cold_rows(self, state: Row, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], _COLD)
        rows = self.spark.read.schema(_COLD).option("basePath", self.cold_path).parquet(*folders)
        return rows.filter((F.col("run") <= state.run) & (F.col("run") >= _known(state.bases, "day")))

    def read_cold(self, start_ms: int | None = None, end_ms: int | None = None) -> DataFrame:
        """Archived rows as of now, with the run that wrote them there.

        With bounds, ``start_ms <= ts < end_ms``, the files of other days are not listed.
        """
        folders, time_type = [self.cold_path], T.TimestampType()
        if start_ms is not None or end_ms is not None:
            first, last = (None if ms is None else day_of(ms) for ms in (start_ms, end_ms))
            folders = [
                f for f in self.found(f"{self.cold_path}/day=*") for day in [f.rsplit("day=", 1)[1]]
                # A year beyond four digits is not compared.
                if len(day) > 10 or ((not first or first <= day) and (not last or day <= last))
            ]
        rows = self.cold_rows(self.state(), folders)
        if start_ms is not None:
            rows = rows.filter(F.col("ts") >= bound(start_ms, time_type))
        if end_ms is not None:
            rows = rows.filter(F.col("ts") < bound(end_ms, time_type))
        return rows.select(*TRADES.names, "run")

    def cold_partitions(self) -> list[tuple[str, int]]:
        """Day and run of the folders that hold the archive as of now."""
        state, names = self.state(), [f.rsplit("/", 2)[1:] for f in self.found(f"{self.cold_path}/day=*/run=*")]
        found = [(day.removeprefix("day="), int(run.removeprefix("run="))) for day, run in names]
        return sorted((day, run) for day, run in found if state.bases.get(day, 0) <= run <= state.run)

    def begin(self, state: Row) -> int:
        """The number of a new run; what one that died has left under it goes."""
        for folder in self.found(f"{self.moves_path}/tier=*/day=*/run={state.run + 1}"):
            self.drop(folder)
        return state.run + 1

    def move(self, cutoff: int) -> dict[str, int]:
        """Take all hot rows with ``ts`` before ``cutoff`` (epoch ms) to cold.

        Rows that come in while this runs are not taken and stay hot.
        """
        state = self.state()
        run, appended, taken = self.begin(state), self._appended(state), {}
        # The epochs that the rows above are read from; the listing is theirs.
        for name, epoch in re.findall(r"/writer=([^/]+)/epoch=(\d+)/", "\n".join(appended.inputFiles())):
            taken[name] = max(int(epoch), taken.get(name, -1), state.writers.get(name, -1))
        # A batch without epochs here was taken and vacuumed, and never comes again.
        kept = {w: e for w, e in state.writers.items() if not w.startswith("batch-")}
        latest, seen = self._latest(appended, state, by_day=True), Observation()
        cold = older_than(latest, cutoff)
        counts = [F.count_if(cold).alias("moved"), F.count_if(~cold).alias("left")]
        place = {
            "tier": F.when(cold, F.lit("cold")).otherwise(F.lit("hot")),
            "day": F.when(cold, F.col("day").cast("string")).otherwise(F.lit("none")),
            "run": F.lit(run).cast("bigint"),
        }
        rows = latest.observe(seen, *counts).withColumns(place).sortWithinPartitions(*place, *KEY)
        self.write(rows, self.moves_path, *place)
        days = [f.rsplit("/", 2)[1].removeprefix("day=") for f in self.found(f"{self.cold_path}/day=*/run={run}")]
        pieces = state.pieces | {day: state.pieces.get(day, 0) + 1 for day in days}
        self.commit(state, left=run if seen.get["left"] else None, writers=kept | taken, pieces=pieces)
        return {"run": run, **seen.get}

    def compact(self, before: int, file_bytes: int = FILE_BYTES) -> dict[str, int]:
        return upkeep.compact(self, before, file_bytes)

    def vacuum(self, older_than_s: float = 0) -> None:
        upkeep.vacuum(self, older_than_s)
