"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeflow.constants import DAY_MS, SUBSCRIPTION_LIMIT
from tradeflow.functions.time import (
    cutoff_ms,
    epoch_ms_to_ntz,
    now_ms,
    ntz_to_epoch_ms,
    ntz_to_epoch_ms_rounded,
    timestamp_to_ntz,
)
from tradeflow.operators import editor, forecast, messages as msg, trades as tr, universe as uni
from tradeflow.operators.latest import latest_per_key
from tradeflow.plans.tables import (
    customer_pages,
    index_pages,
    stocks,
    table,
    timed_trades,
    trades,
)
from tradeflow.session import configure, pin, work_folder
from tradeflow.sources import messages as folders, tables
from tradeflow.sources.html import cell_columns, html_table
from tradeflow.sources.store import TradeStore
from tradeflow.streaming.flows import (
    enrich_sink,
    lag_sink,
    start_flat_trades,
    start_hot_trades,
    start_live_trades,
    start_refresh,
    start_sink,
    write_epoch,
)

CUTOFF_MS = 1705276800000  # 2024-01-15 00:00 UTC
SERIES_END_MS = 1706000000000
REQUESTS = (10, 1200, -5)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(configure(spark), sf_dir)

    run.__name__, run.__doc__ = f.__name__, f.__doc__
    QUERIES[f.__name__] = run
    return run


def _zone_less(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ts", timestamp_to_ntz(F.col("ts")))


# Messages


@query
def trades_flatten(spark, sf_dir):
    """Message texts parsed and flattened to trades."""
    texts = msg.encode(msg.pack_messages(trades(spark, sf_dir)))
    return msg.flatten(msg.parse(texts))


@query
def message_roundtrip(spark, sf_dir):
    """Trades landed as message files and read back."""
    folder = work_folder(spark, "landing")
    folders.land_messages(msg.pack_messages(trades(spark, sf_dir)), folder)
    return msg.flatten(folders.read_messages(spark, folder), only_type="trade")


@query
def epoch_ms(spark, sf_dir):
    """Timestamps to epoch ms, truncated and rounded, and back."""
    ms = ntz_to_epoch_ms(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        ms.alias("ms"),
        ntz_to_epoch_ms_rounded(F.col("ts")).alias("ms_rounded"),
        epoch_ms_to_ntz(ms).alias("ts_ms"),
    )


@query
def event_ages(spark, sf_dir):
    """Ages against the present, as far as they do not depend on it: two times of one
    query have the same present, and all events lie before it."""
    ms = ntz_to_epoch_ms(F.col("ts"))
    later = ntz_to_epoch_ms(F.col("ts") + F.expr("INTERVAL 5 SECONDS"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        ((now_ms() - ms) - (now_ms() - later)).cast("bigint").alias("apart"),
        (now_ms() > ms).alias("past"),
    )


# Streams


@query
def stream_documents(spark, sf_dir):
    """As ``stream_trades``, from files of one document each, which may have lines."""
    folder = work_folder(spark, "stream-documents")
    folders.land_messages(msg.pack_messages(trades(spark, sf_dir)), f"{folder}/in", per_file=1)
    source = folders.stream_messages(spark, f"{folder}/in")
    start_flat_trades(
        source, f"{folder}/out", f"{folder}/checkpoint", availableNow=True
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query
def chart_refresh(spark, sf_dir):
    """The hot table as a chart's refresh sees it."""
    folder, shown = work_folder(spark, "refresh"), threading.Event()
    TradeStore(spark, f"{folder}/store").append(timed_trades(spark, sf_dir))

    def show(hot: DataFrame) -> None:
        if not shown.is_set():
            hot.write.parquet(f"{folder}/out")
            shown.set()

    refresh = start_refresh(spark, f"{folder}/store", f"{folder}/checkpoint", show, every_s=1)
    try:
        while not shown.wait(1) and refresh.isActive:
            pass
    finally:
        refresh.stop()
    return _zone_less(spark.read.parquet(f"{folder}/out"))


@query
def stream_trades(spark, sf_dir):
    """A message folder streamed into flat trades."""
    folder = work_folder(spark, "stream-trades")
    folders.land_messages(msg.pack_messages(trades(spark, sf_dir)), f"{folder}/in")
    source = folders.stream_messages(spark, f"{folder}/in", multi_line=False)
    start_flat_trades(
        source, f"{folder}/out", f"{folder}/checkpoint", availableNow=True
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@query
def stream_hot_upsert(spark, sf_dir):
    """Messages streamed into the hot table, with later corrections.

    The first run writes every trade at a price that is one too high, the second
    one, from the same checkpoint, corrects the trades of volume 50 and more.
    """
    folder = work_folder(spark, "stream-hot")
    exact = trades(spark, sf_dir)
    early = exact.withColumn("price", F.col("price") + 1)
    late = exact.filter(F.col("volume") >= 50)
    for part in (early, late):
        folders.land_messages(msg.pack_messages(part), f"{folder}/in")
        source = folders.stream_messages(spark, f"{folder}/in", False, clean_source="off")
        start_hot_trades(
            source, f"{folder}/store", f"{folder}/checkpoint", availableNow=True
        ).awaitTermination()
    return _zone_less(TradeStore(spark, f"{folder}/store").read_hot())


@query
def stream_hot_arrival(spark, sf_dir):
    """Corrections that one micro-batch sees together with what they correct.

    The first landing has every trade at a price that is one too high. The second
    one has the trades of volume 50 and more twice, first two too high, then exact.
    """
    folder = work_folder(spark, "stream-arrival")
    exact = trades(spark, sf_dir)
    late = exact.filter(F.col("volume") >= 50)
    wrong = msg.pack_messages(late.withColumn("price", F.col("price") + 2))
    early = msg.pack_messages(exact.withColumn("price", F.col("price") + 1))
    folders.land_messages(early, f"{folder}/in")
    folders.land_messages(wrong.union(msg.pack_messages(late)), f"{folder}/in")
    source = folders.stream_messages(spark, f"{folder}/in", False, clean_source="off")
    start_hot_trades(
        source, f"{folder}/store", f"{folder}/checkpoint", availableNow=True
    ).awaitTermination()
    return _zone_less(TradeStore(spark, f"{folder}/store").read_hot())


def _landed(spark: SparkSession, folder: str, parts: list[DataFrame], start) -> None:
    """Lands the parts one after the other, each followed by a run of the stream that
    ``start`` makes, from the same checkpoint."""
    for part in parts:
        folders.land_messages(msg.pack_messages(part), f"{folder}/in")
        start(folders.stream_messages(spark, f"{folder}/in", False, clean_source="off")).awaitTermination()


@query
def stream_live(spark, sf_dir):
    """The hot table put together from the changes that keyed state hands to a chart:
    first every trade at a price that is one too high, then corrections."""
    folder, exact = work_folder(spark, "stream-live"), trades(spark, sf_dir)
    parts = [exact.withColumn("price", F.col("price") + 1), exact.filter(F.col("volume") >= 50)]
    show = lambda batch, epoch: write_epoch(batch, f"{folder}/changes", epoch)
    _landed(spark, folder, parts, lambda m: start_live_trades(m, show, f"{folder}/checkpoint", availableNow=True))
    changes = spark.read.parquet(f"{folder}/changes")
    return _zone_less(latest_per_key(changes, ["symbol", "ts"], ["epoch"], ["price", "volume"]))


@query
def stream_enriched(spark, sf_dir):
    """Trades with the facts on their stock, joined batch by batch."""
    folder, rows = work_folder(spark, "stream-enriched"), trades(spark, sf_dir)
    late = F.coalesce(F.col("volume") >= 50, F.lit(False))
    tables.overwrite_parquet(stocks(spark, sf_dir), f"{folder}/stocks")
    sink = enrich_sink(f"{folder}/out", lambda session: session.read.parquet(f"{folder}/stocks"))
    start = lambda m: start_sink(m, sink, f"{folder}/checkpoint", availableNow=True)
    _landed(spark, folder, [rows.filter(~late), rows.filter(late)], start)
    return spark.read.parquet(f"{folder}/out").drop("epoch")


@query
def stream_lag1(spark, sf_dir):
    """Trades with the previous price of the symbol, over three batches in the order
    of time, with the last trade of each symbol as state."""
    folder, rows = work_folder(spark, "stream-lag"), trades(spark, sf_dir)
    cuts = [CUTOFF_MS - 7 * DAY_MS, CUTOFF_MS]
    number = sum((F.coalesce(F.col("ts") >= c, F.lit(False)).cast("int") for c in cuts), F.lit(0))
    sink = lag_sink(folder)
    start = lambda m: start_sink(m, sink, f"{folder}/checkpoint", availableNow=True)
    _landed(spark, folder, [rows.filter(number == i) for i in range(3)], start)
    return spark.read.parquet(f"{folder}/priced").drop("epoch")


# Hot and cold trades


@query
def hot_upsert(spark, sf_dir):
    """Keyed appends: key (event type, hour), the latest event wins."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.date_trunc("hour", "ts").cast("timestamp").alias("ts"),
        F.col("value").cast("decimal(10,4)").alias("price"),
        F.get_json_object("props", "$.k").cast("int").alias("volume"),
        "event_id",
    )
    middle = (rows.agg(F.max("event_id")).first()[0] or 0) // 2
    store = TradeStore(spark, work_folder(spark, "hot-upsert"))
    store.append(rows.filter(F.col("event_id") <= middle), ["event_id"])
    store.append(rows.filter(F.col("event_id") > middle), ["event_id"])
    return _zone_less(store.read_hot())


@query
def latest_event(spark, sf_dir):
    """The latest event of each user and type, as one aggregate."""
    rows = table(spark, sf_dir, "events")
    return latest_per_key(rows, ["user_id", "event_type"], ["event_id"], ["value", "ts"])


def _moved(spark: SparkSession, sf_dir: str) -> TradeStore:
    store = TradeStore(spark, work_folder(spark, "archive"))
    store.append(timed_trades(spark, sf_dir))
    delay_s = 60
    store.move(cutoff_ms(CUTOFF_MS + 1000 * delay_s, delay_s))
    return store


@query
def archive_cold(spark, sf_dir):
    """Trades older than the cutoff, after a move."""
    return _zone_less(_moved(spark, sf_dir).read_cold()).drop("run")


@query
def archive_hot_left(spark, sf_dir):
    """Trades a move leaves in the hot table."""
    return _zone_less(_moved(spark, sf_dir).read_hot())


def _moved_in_steps(spark: SparkSession, sf_dir: str) -> TradeStore:
    """Three appends by the remainder of the volume, each followed by a move to a later
    cutoff, so most days lie in three pieces; then the days before the last cutoff but
    one are compacted, and one more append comes with late trades for them."""
    store, rows = TradeStore(spark, work_folder(spark, "archive")), timed_trades(spark, sf_dir)
    rest = F.coalesce(F.pmod("volume", F.lit(4)), F.lit(0))
    for part in range(3):
        store.append(rows.filter(rest == part))
        store.move(CUTOFF_MS - (2 - part) * DAY_MS)
    store.compact(CUTOFF_MS - DAY_MS)
    store.append(rows.filter(rest == 3))
    store.move(CUTOFF_MS)
    return store


@query
def archive_compacted(spark, sf_dir):
    """Archived trades after moves, a compaction of closed days, and late trades."""
    return _zone_less(_moved_in_steps(spark, sf_dir).read_cold()).drop("run")


@query
def archive_recompacted(spark, sf_dir):
    """The same after another compaction and a vacuum of what was replaced."""
    store = _moved_in_steps(spark, sf_dir)
    store.compact(CUTOFF_MS)
    store.vacuum()
    return _zone_less(store.read_cold()).drop("run")


@query
def archive_table(spark, sf_dir):
    """Ten days of the external table over the archive, by its partitions."""
    store = _moved_in_steps(spark, sf_dir)
    name = "archive_" + store.root[-32:]
    tables.sync_archive_table(spark, name, store)
    store.compact(CUTOFF_MS)
    tables.sync_archive_table(spark, name, store)
    rows = spark.sql(
        f"SELECT symbol, ts, price, volume FROM {name} WHERE day >= :first AND day < :last",
        args={"first": "2024-01-05", "last": "2024-01-15"},
    )
    rows = pin(rows, "archive-rows")  # the catalog is asked for partitions when they are read
    tables.drop_table(spark, name)
    return _zone_less(rows)


@query
def hot_symbols(spark, sf_dir):
    return tr.symbols(trades(spark, sf_dir))


# Stock universe


@query
def universe_union(spark, sf_dir):
    return stocks(spark, sf_dir)


@query
def universe_reload(spark, sf_dir):
    """A stocks folder written, then overwritten."""
    folder = work_folder(spark, "stocks")
    rows = stocks(spark, sf_dir)
    tables.overwrite_parquet(rows.filter(F.col("Index") == "NASDAQ"), folder)
    tables.overwrite_parquet(rows, folder)
    return spark.read.parquet(folder)


@query
def universe_table_scan(spark, sf_dir):
    """An external table over a stocks folder, selected as a whole."""
    folder = work_folder(spark, "stocks")
    tables.overwrite_parquet(stocks(spark, sf_dir), folder)
    name = "stocks_" + folder[-32:]
    tables.create_stocks_table(spark, name, folder)
    rows = tables.scan_table(spark, name)
    tables.drop_table(spark, name)  # the rows are bound to the files
    return rows


@query
def stock_picker(spark, sf_dir):
    return uni.pick_stocks(stocks(spark, sf_dir), "NASDAQ")


@query
def stock_picker_none(spark, sf_dir):
    return uni.pick_stocks(stocks(spark, sf_dir), None)


@query
def index_list(spark, sf_dir):
    return uni.index_names(stocks(spark, sf_dir))


@query
def universe_counts(spark, sf_dir):
    return uni.universe_counts(stocks(spark, sf_dir))


@query
def top_symbols(spark, sf_dir):
    return uni.first_symbols(stocks(spark, sf_dir))


@query
def subscribe_messages(spark, sf_dir):
    """Subscribe messages for the first 50 symbols, the provider's limit."""
    return msg.subscriptions(uni.first_symbols(stocks(spark, sf_dir), SUBSCRIPTION_LIMIT))


@query
def html_table_rows(spark, sf_dir):
    """Stocks read from the second table of HTML pages."""
    rows = html_table(customer_pages(spark, sf_dir), "html", "page_id", index=1)
    return cell_columns(rows, "Ticker", "Company", "GICS Sector").withColumnsRenamed(
        {"Ticker": "Symbol", "Company": "Security", "GICS Sector": "Sector"}
    )


@query
def universe_from_pages(spark, sf_dir):
    """The universe read from the pages of both indexes."""
    return uni.universe_from_pages(index_pages(spark, sf_dir))


# Series


@query
def series_range(spark, sf_dir):
    """Values of some ids strictly inside a time range."""
    rows = table(spark, sf_dir, "events")
    return tr.series(rows, "user_id", "value", "ts", [7, 8], CUTOFF_MS, SERIES_END_MS)


def _hot_series(spark, sf_dir, column):
    """One symbol's series from the hot table."""
    store = TradeStore(spark, work_folder(spark, "series"))
    store.append(timed_trades(spark, sf_dir))
    hot = store.read_hot()
    rows = tr.series(hot, "symbol", column, "ts", ["U7"], 0, SERIES_END_MS, alias=f"U7 {column}")
    return rows.withColumn("time", timestamp_to_ntz(F.col("time")))


@query
def series_price(spark, sf_dir):
    return _hot_series(spark, sf_dir, "price")


@query
def series_volume(spark, sf_dir):
    return _hot_series(spark, sf_dir, "volume")


@query
def series_archive(spark, sf_dir):
    """Series of two symbols from the days of the archive that can hold them."""
    start, end = CUTOFF_MS - 10 * DAY_MS, CUTOFF_MS - 5 * DAY_MS
    cold = _moved(spark, sf_dir).read_cold(start, end)
    rows = tr.series(cold, "symbol", "price", "ts", ["U7", "U8"], start, end)
    return rows.withColumn("time", timestamp_to_ntz(F.col("time")))


EDITOR = """
SELECT symbol, CAST(sum(price) AS DOUBLE) / count(price) AS mean, date_trunc('DAY', ts) AS day,
       max(price) AS high, min(price) AS low, sum(volume) AS volume, count(*) AS trades
FROM trades
WHERE ts > $__timeFrom AND ts < $__timeTo AND volume >= :least -- not '$__timeTo
GROUP BY symbol, date_trunc('DAY', ts)
"""


@query
def editor_days(spark, sf_dir):
    """A dashboard's own SQL over the hot table: figures of each symbol and day."""
    store = TradeStore(spark, work_folder(spark, "editor"))
    store.append(timed_trades(spark, sf_dir))
    bounds = (CUTOFF_MS - 5 * DAY_MS, CUTOFF_MS + 7)
    rows = editor.run_sql(spark, EDITOR, {"trades": store.read_hot()}, *bounds, {"least": 20})
    mean = F.round(F.round("mean", 11), 6).alias("mean")
    return rows.select("symbol", mean, timestamp_to_ntz(F.col("day")).alias("day"), "high", "low", "volume", "trades")


@query
def editor_series(spark, sf_dir):
    """Chart points of an editor's query, from events with a time without zone."""
    text = """SELECT event_type, count(*), max(ts), min(user_id) FROM events
        WHERE ts > $__timeFrom AND ts < $__timeTo AND user_id IN (7, 8, :other) GROUP BY event_type"""
    given = {"events": table(spark, sf_dir, "events")}
    rows = editor.run_sql(spark, text, given, CUTOFF_MS, SERIES_END_MS, {"other": 9}, "timestamp_ntz")
    return editor.chart_points(rows)


@query
def trades_enriched(spark, sf_dir):
    """Trades with security, sector and indexes of their stock."""
    return tr.enrich(trades(spark, sf_dir), stocks(spark, sf_dir))


# Forecast


def _rounded(rows: DataFrame) -> DataFrame:
    """Six places. A tree's means are off in the last bits, which the first
    rounding takes away, so that a mean half way between two places goes up as
    it does in exact arithmetic."""
    return rows.withColumn("prediction", F.round(F.round("prediction", 11), 6))


def _requests(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v,) for v in REQUESTS], "volume int")


@query
def forecast_exact(spark, sf_dir):
    """Customer keys as requested volumes, answered from the leaf means."""
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("int").alias("volume"))
    return _rounded(forecast.nearest_leaf(forecast.leaves(trades(spark, sf_dir)), asked))


@query
def forecast_leaves(spark, sf_dir):
    means = forecast.leaves(trades(spark, sf_dir))
    return means.select(
        "volume", F.round("mean", 6).alias("mean"), F.col("weight").cast("bigint").alias("trades")
    )


@query
def forecast_batch(spark, sf_dir):
    """The trades' leaves, applied to the trades."""
    rows = trades(spark, sf_dir)
    return _rounded(forecast.fit_predict(rows, rows))


@query
def forecast_points(spark, sf_dir):
    """The trades' leaves, applied to single requests."""
    return _rounded(forecast.fit_predict(trades(spark, sf_dir), _requests(spark)))


@query
def forecast_saved_model(spark, sf_dir):
    """A tree saved, loaded and applied to the trades."""
    rows = trades(spark, sf_dir)
    folder = work_folder(spark, "model")
    forecast.save(forecast.fit_tree(rows), folder)
    return _rounded(forecast.predict(forecast.load(folder), rows.select("symbol", "ts", "volume")))


@query
def forecast_fractions(spark, sf_dir):
    """Leaves of fractional volumes, of which there are about as many as trades,
    saved, loaded and applied to prices of parts."""
    rows = table(spark, sf_dir, "events").select(
        F.col("value").cast("double").alias("volume"),
        F.get_json_object("props", "$.k").cast("int").alias("price"),
    )
    folder = work_folder(spark, "leaves")
    forecast.save_leaves(forecast.leaves(rows), folder)
    asked = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_retailprice").cast("double") / 10).alias("volume")
    )
    return _rounded(forecast.nearest_leaf(forecast.load_leaves(spark, folder), asked))


@query
def forecast_lag1(spark, sf_dir):
    """Trades with the previous price of the symbol."""
    return tr.with_previous_price(trades(spark, sf_dir))


@query
def csv_training_scan(spark, sf_dir):
    """Training rows written to CSV and read back with inferred types."""
    folder = work_folder(spark, "training")
    tables.write_training(trades(spark, sf_dir), folder)
    return tables.read_training(spark, folder)
