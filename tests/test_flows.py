"""Sinks and state across batches, restarts and replays."""

from decimal import Decimal as D

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tradeflow.operators import messages as msg
from tradeflow.operators.trades import with_previous_price
from tradeflow.sources import messages as folders
from tradeflow.sources.store import TradeStore
from tradeflow.streaming.flows import enrich_sink, lag_sink, start_hot_trades, start_live_trades, start_sink, write_epoch

TICKS = "symbol string, ts bigint, price decimal(10,4), volume int"


@pytest.fixture
def stream(spark, tmp_path):
    """Lands ticks, then runs the stream that a function makes until it is done."""

    def run(start, *ticks):
        if ticks:
            frame = spark.createDataFrame([(s, t, D(p), v) for s, t, p, v in ticks], TICKS)
            folders.land_messages(msg.pack_messages(frame.coalesce(1)), str(tmp_path / "in"))
        source = folders.stream_messages(spark, str(tmp_path / "in"), False, clean_source="off")
        start(source).awaitTermination()

    return run


def forget(tmp_path, epoch):
    """The last batch's commit is lost, so a restart runs it again."""
    for name in (f"{epoch}", f".{epoch}.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)


def test_live_state_equals_the_hot_table(spark, stream, tmp_path):
    shown, batches = {}, []

    def show(batch, epoch):
        found = [tuple(r) for r in batch.withColumn("ts", F.unix_millis("ts")).select("symbol", "ts", "price", "volume").collect()]
        batches.append((epoch, len(found)))
        shown.update({r[:2]: r[2:] for r in found})

    def live(source):
        return start_live_trades(source, show, str(tmp_path / "checkpoint"), availableNow=True)

    def hot(source):
        return start_hot_trades(source, str(tmp_path / "store"), str(tmp_path / "hot"), availableNow=True)

    for ticks in ([("A", 1, 1, 1), ("A", 1, 5, 5), ("B", 1, 1, 1)], [("A", 1, 2, 2), (None, 1, 1, 1)], [("C", 7, 1, 1)]):
        stream(live, *ticks)  # each call is a restart from the checkpoint
        stream(hot)
        stored = TradeStore(spark, str(tmp_path / "store")).read_hot().withColumn("ts", F.unix_millis("ts"))
        assert rows(stored, "symbol", "ts", "price", "volume") == sorted((*k, *v) for k, v in shown.items())
    assert batches == [(0, 2), (1, 1), (2, 1)]
    assert (tmp_path / "checkpoint" / "state").exists()


def test_old_keys_leave_the_live_state(spark, stream, tmp_path):
    seen = []

    def live(source):
        show = lambda batch, _: seen.append(rows(batch, "symbol", "price"))
        return start_live_trades(source, show, str(tmp_path / "checkpoint"), keep="1 second", availableNow=True)

    stream(live, ("A", 1_000, 1, 1), ("B", 100_000, 1, 1))
    stream(live, ("B", 100_500, 2, 2))
    stream(live, ("A", 1_000, 3, 3), ("B", 100_500, 3, 3))
    assert [x for x in seen if x] == [[("A", 1), ("B", 1)], [("B", 2)], [("B", 3)]]


def test_facts_may_change_between_batches(spark, stream, tmp_path):
    facts = {"now": [("A", "old", "s", "i")]}
    sink = enrich_sink(
        str(tmp_path / "out"), lambda s: s.createDataFrame(facts["now"], "Symbol string, Security string, Sector string, Index string")
    )
    start = lambda source: start_sink(source, sink, str(tmp_path / "checkpoint"), availableNow=True)
    stream(start, ("A", 1, 1, 1), ("B", 1, 1, 1))
    facts["now"] = [("A", "new", "s", "i")]
    stream(start, ("A", 2, 1, 1))
    got = rows(spark.read.parquet(str(tmp_path / "out")), "symbol", "ts", "security")
    assert got == [("A", 1, "old"), ("A", 2, "new"), ("B", 1, None)]


def test_previous_price_across_batches_and_a_replay(spark, stream, tmp_path):
    parts = [
        [("A", 1, 1, 1), ("A", 2, 2, 1), ("B", 1, 9, 1)],
        [("C", 5, 4, 1)],
        [("A", 7, 3, 1), ("B", 8, 8, 1), ("A", 9, 5, 1)],
    ]
    start = lambda source: start_sink(source, lag_sink(str(tmp_path)), str(tmp_path / "checkpoint"), availableNow=True)
    for ticks in parts:
        stream(start, *ticks)
    every = spark.createDataFrame([(s, t, D(p), v) for ticks in parts for s, t, p, v in ticks], TICKS)
    names = ["symbol", "ts", "price", "price_lag1"]
    expected = rows(with_previous_price(every), *names)
    assert rows(spark.read.parquet(str(tmp_path / "priced")), *names) == expected
    forget(tmp_path, 2)
    stream(start)
    assert rows(spark.read.parquet(str(tmp_path / "priced")), *names) == expected


def test_a_late_trade_has_its_own_batch_only(spark, stream, tmp_path):
    start = lambda source: start_sink(source, lag_sink(str(tmp_path)), str(tmp_path / "checkpoint"), availableNow=True)
    stream(start, ("A", 10, 1, 1), ("A", 20, 2, 1))
    stream(start, ("A", 15, 3, 1), ("A", 30, 4, 1), ("A", 16, 5, 1))
    got = rows(spark.read.parquet(str(tmp_path / "priced")).filter("epoch = 1"), "ts", "price_lag1")
    assert got == [(15, None), (16, D(3)), (30, D(2))]
    stream(start, ("A", 40, 6, 1))
    assert rows(spark.read.parquet(str(tmp_path / "priced")).filter("epoch = 2"), "ts", "price_lag1") == [(40, D(4))]


def test_an_epoch_overwrites_itself(spark, tmp_path):
    path = str(tmp_path / "out")
    for epoch, n in ((0, 3), (1, 2), (1, 5)):
        write_epoch(spark.range(n), path, epoch)
    assert rows(spark.read.parquet(path).groupBy("epoch").count()) == [(0, 3), (1, 5)]
