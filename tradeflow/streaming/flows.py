"""Message folder to flat trades, message folder to hot table, timed moves."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tradeflow.constants import DAY_MS, MOVE_SECONDS, REFRESH_SECONDS, RETENTION_SECONDS
from tradeflow.functions.time import cutoff_ms, epoch_ms_to_timestamp
from tradeflow.operators.latest import arrival
from tradeflow.operators.messages import flatten
from tradeflow.operators.trades import enrich, with_previous_price
from tradeflow.session import drop_tables, pin
from tradeflow.sources.store import TradeStore

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_flat_trades(
    messages: DataFrame, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Flatten a message stream into a Parquet folder, each tick exactly once."""
    return (
        flatten(messages)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def hot_sink(root: str) -> Callable[[DataFrame, int], None]:
    """A per-batch function that appends to the hot table.

    Within a batch the later arrival wins: landing, message, place in it. The
    id of the query lives in its checkpoint, so a batch that is run again after
    a restart overwrites its own epoch, and a query with a new checkpoint is a new
    writer.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        writer = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        rank = arrival(F.col("at"), F.col("no"), F.col("pos"))
        trades = batch.withColumns({"ts": epoch_ms_to_timestamp(F.col("ts")), "rank": rank})
        TradeStore(spark, root).append(trades, ["rank"], writer, epoch)

    return write


def start_hot_trades(
    messages: DataFrame, root: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Flatten a message stream and upsert it into the hot table under ``root``."""
    return (
        flatten(messages, keep=("at", "no", "pos"))
        .writeStream.foreachBatch(hot_sink(root))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def _every(
    spark: SparkSession, seconds: float, checkpoint: str, act: Callable[[SparkSession], None]
) -> StreamingQuery:
    """Run ``act`` once per interval; the stream's rows only serve as a clock."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return (
        ticks.writeStream.foreachBatch(lambda batch, _: act(batch.sparkSession))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )


def start_moves(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    every_s: float = MOVE_SECONDS,
    delay_s: int = MOVE_SECONDS,
    clock: Callable[[], float] = time.time,
    retention_s: float = RETENTION_SECONDS,
) -> StreamingQuery:
    """Move rows older than ``delay_s`` to cold, once per ``every_s``, and compact the
    archived days once a day.

    Files that a move made obsolete are deleted ``retention_s`` after it, so a read
    may take that long.
    """
    days: list[int] = []

    def move(session: SparkSession) -> None:
        store, cutoff = TradeStore(session, root), cutoff_ms(round(clock() * 1000), delay_s)
        store.vacuum(retention_s)
        store.move(cutoff)
        if days != [cutoff // DAY_MS]:
            store.compact(cutoff)
            days[:] = [cutoff // DAY_MS]

    return _every(spark, every_s, checkpoint, move)


def write_epoch(rows: DataFrame, path: str, epoch: int) -> None:
    """Stores a batch's rows as its own partition, which a batch run again overwrites."""
    rows = rows.withColumn("epoch", F.lit(epoch).cast("bigint"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("epoch").parquet(path)


def enrich_sink(path: str, stocks: Callable[[SparkSession], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A per-batch function that stores the trades with the facts on their stocks.

    ``stocks`` is asked once for each batch, so facts may change between batches; a
    trade keeps those of its time.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        write_epoch(enrich(batch, stocks(batch.sparkSession)), path, epoch)

    return write


def lag_sink(root: str) -> Callable[[DataFrame, int], None]:
    """A per-batch function that stores the trades with the previous price of their
    symbol, across batches, under ``root/priced``.

    The last trade of each symbol is the state: one row per symbol under
    ``root/last/epoch=E``, read by the batch after E. It takes part in that batch as a
    trade like the others, in the order of ``with_previous_price``, so a hot symbol is
    cut into slices here too. A late trade, which is before the last one of earlier
    batches, finds its previous price in its own batch only.
    """
    values = ["ts", "price", "volume"]

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        trades = batch.select("symbol", *values).withColumn("held", F.lit(False))
        if epoch > 0:
            kind = batch.select("symbol", *values).schema.add("epoch", "long")
            last = spark.read.schema(kind).parquet(f"{root}/last").filter(F.col("epoch") == epoch - 1)
            trades = trades.unionByName(last.drop("epoch").withColumn("held", F.lit(True)))
        trades = pin(trades, "lag-batch")
        write_epoch(with_previous_price(trades).filter("NOT held").drop("held"), f"{root}/priced", epoch)
        newest = F.max(F.struct(*values)).alias("_last")
        latest = trades.groupBy("symbol").agg(newest).select("symbol", "_last.*")
        write_epoch(latest, f"{root}/last", epoch)
        drop_tables(spark, [f"{root}/last/epoch={epoch - 2}"])  # no batch reads it again

    return write


def start_sink(
    messages: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, **trigger
) -> StreamingQuery:
    """Flatten a message stream and hand its batches to ``sink``."""
    return (
        flatten(messages)
        .writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "0 seconds"}))
        .start()
    )


def start_live_trades(
    messages: DataFrame,
    show: Callable[[DataFrame, int], None],
    checkpoint: str,
    keep: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Hand the keys of the hot table that a batch has changed to ``show``, with the
    latest values, from keyed state instead of the stored table.

    The last arrival of a key wins, whatever batch it comes in. The state lies in
    RocksDB and its checkpoint, so a restart goes on where it was. With ``keep``, as
    ``"10 minutes"``, keys that much older than the newest leave the state, and trades
    that come later than that are not shown; without it the state has every key.
    """
    spark = messages.sparkSession
    rank = arrival(F.col("at"), F.col("no"), F.col("pos"))
    ticks = flatten(messages, keep=("at", "no", "pos")).filter("symbol IS NOT NULL AND ts IS NOT NULL")
    ticks = ticks.withColumns({"ts": epoch_ms_to_timestamp(F.col("ts")), "rank": rank})
    if keep is not None:
        ticks = ticks.withWatermark("ts", keep)
    latest = ticks.groupBy("symbol", "ts").agg(*[F.max_by(v, "rank").alias(v) for v in ("price", "volume")])
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        return (
            latest.writeStream.outputMode("update")
            .foreachBatch(show)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": f"{REFRESH_SECONDS} seconds"}))
            .start()
        )
    finally:
        spark.conf.unset(STATE_STORE) if before is None else spark.conf.set(STATE_STORE, before)


def start_refresh(
    spark: SparkSession,
    root: str,
    checkpoint: str,
    show: Callable[[DataFrame], None],
    every_s: float = REFRESH_SECONDS,
) -> StreamingQuery:
    """Hand the hot table to ``show`` once per ``every_s``, for charts."""
    return _every(
        spark, every_s, checkpoint, lambda session: show(TradeStore(session, root).read_hot())
    )
