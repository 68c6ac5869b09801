import datetime
import random
import time
from decimal import Decimal as D

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tradeflow.constants import DAY_MS
from tradeflow.operators import messages as msg
from tradeflow.operators.latest import arrival
from tradeflow.sources import messages as folders
from tradeflow.sources.store import TradeStore
from tradeflow.streaming.flows import hot_sink, start_hot_trades, start_moves, start_refresh


def at(ms):
    return datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=ms)


def frame(spark, *ticks, extra=""):
    """Ticks as (symbol, ms, price, volume, ..)."""
    schema = f"symbol string, ts bigint, price decimal(10,4), volume int{extra}"
    data = [(s, t, None if p is None else D(p), v, *x) for s, t, p, v, *x in ticks]
    return spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_millis("ts"))


def content(df):
    ms = F.unix_millis("ts").alias("ts")
    return [(s, t, float(p), v) for s, t, p, v in rows(df, "symbol", ms, "price", "volume")]


@pytest.fixture
def store(spark, tmp_path):
    return TradeStore(spark, str(tmp_path / "store"))


def test_empty_store(store):
    assert content(store.read_hot()) == []
    assert content(store.read_cold()) == []
    moved = store.move(1000)
    assert (moved["moved"], moved["left"]) == (0, 0)
    assert content(store.read_hot()) == []


def test_later_append_wins(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1), ("B", 1, 1, 1)))
    store.append(frame(spark, ("A", 1, 2, 2), ("A", 2, 3, 3)))
    assert content(store.read_hot()) == [("A", 1, 2, 2), ("A", 2, 3, 3), ("B", 1, 1, 1)]


def test_a_later_smaller_or_null_value_wins(spark, store):
    store.append(frame(spark, ("A", 1, 5, 5)))
    store.append(frame(spark, ("A", 1, 4, None)))
    assert content(store.read_hot()) == [("A", 1, 4, None)]


def test_order_within_one_append(spark, store):
    ticks = [("A", 1, 9, 1, "f1", 7), ("A", 1, 5, 2, "f2", 0), ("A", 1, 3, 3, "f2", 1)]
    store.append(frame(spark, *ticks, extra=", file string, pos int"), ["file", "pos"])
    assert content(store.read_hot()) == [("A", 1, 3, 3)]


def test_rows_without_key_are_counted(spark, store):
    seen = store.append(frame(spark, ("A", 1, 1, 1), (None, 1, 1, 1), ("A", None, 1, 1)))
    assert seen == {"rows": 3, "without_key": 2}
    assert content(store.read_hot()) == [("A", 1, 1, 1)]


def test_same_batch_twice(spark, store):
    batch = frame(spark, ("A", 1, 1, 1), ("B", 2, 2, 2))
    store.append(batch)
    before = content(store.read_hot())
    store.append(batch)
    assert content(store.read_hot()) == before


def test_a_replayed_epoch_replaces_itself(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1), ("B", 1, 1, 1)), writer="w", epoch=0)
    store.append(frame(spark, ("C", 1, 1, 1)), writer="w", epoch=1)
    store.append(frame(spark, ("A", 1, 2, 2)), writer="w", epoch=0)
    assert content(store.read_hot()) == [("A", 1, 2, 2), ("C", 1, 1, 1)]
    assert len(store.found(f"{store.hot_path}/writer=*/epoch=*")) == 2


def test_a_replay_after_a_move_has_no_effect(spark, store):
    batch = frame(spark, ("A", 1, 1, 1))
    store.append(batch, writer="w", epoch=0)
    store.move(1000)
    store.append(batch, writer="w", epoch=0)
    assert content(store.read_hot()) == []
    store.vacuum()
    store.append(batch, writer="w", epoch=0)
    assert content(store.read_hot()) == []
    store.append(batch, writer="other", epoch=0)
    assert content(store.read_hot()) == [("A", 1, 1, 1)]
    with pytest.raises(ValueError):
        store.append(batch, writer="a/b")


def test_move_splits_at_the_cutoff(spark, store):
    ticks = [(s, t, t, 1) for s in "AB" for t in (1, 999, 1000, 1001)]
    store.append(frame(spark, *ticks))
    moved = store.move(1000)
    assert moved == {"run": 1, "moved": 4, "left": 4}
    cold, hot = content(store.read_cold()), content(store.read_hot())
    assert {t for _, t, _, _ in cold} == {1, 999}
    assert {t for _, t, _, _ in hot} == {1000, 1001}
    assert sorted(cold + hot) == sorted((s, t, float(p), v) for s, t, p, v in ticks)


def test_second_move_with_the_same_cutoff(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1), ("A", 2000, 1, 1)))
    store.move(1000)
    cold, hot = content(store.read_cold()), content(store.read_hot())
    assert store.move(1000)["moved"] == 0
    assert (content(store.read_cold()), content(store.read_hot())) == (cold, hot)


def test_late_row_goes_cold_with_the_next_move(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1)))
    store.move(1000)
    store.append(frame(spark, ("A", 2, 2, 2)))
    assert content(store.read_hot()) == [("A", 2, 2, 2)]
    store.move(1000)
    assert content(store.read_cold()) == [("A", 1, 1, 1), ("A", 2, 2, 2)]
    assert content(store.read_hot()) == []
    assert rows(store.read_cold(), "run") == [(1,), (2,)]


def test_upsert_over_rows_left_by_a_move(spark, store):
    store.append(frame(spark, ("A", 5000, 1, 1), ("B", 5000, 1, 1)))
    store.move(1000)
    store.append(frame(spark, ("A", 5000, 2, 2)))
    assert content(store.read_hot()) == [("A", 5000, 2, 2), ("B", 5000, 1, 1)]
    store.move(6000)
    assert content(store.read_cold()) == [("A", 5000, 2, 2), ("B", 5000, 1, 1)]


def test_a_dead_move_is_not_seen_and_is_replaced(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1), ("A", 2000, 1, 1)))
    for tier, day in (("cold", "1970-01-01"), ("cold", "1970-01-02"), ("hot", "none")):
        dead = f"{store.moves_path}/tier={tier}/day={day}/run=1"
        frame(spark, ("X", 1, 1, 1)).write.parquet(dead)
    assert content(store.read_cold()) == []
    assert len(content(store.read_hot())) == 2
    store.move(1000)
    assert content(store.read_cold()) == [("A", 1, 1, 1)]
    assert content(store.read_cold(0, 10**9)) == [("A", 1, 1, 1)]
    assert content(store.read_hot()) == [("A", 2000, 1, 1)]


def test_a_dead_append_is_not_seen(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1)))
    frame(spark, ("X", 1, 1, 1)).write.parquet(f"{store.hot_path}/.spark-staging-1/writer=w/epoch=9")
    assert content(store.read_hot()) == [("A", 1, 1, 1)]
    assert store.move(0)["left"] == 1
    store.append(frame(spark, ("B", 1, 1, 1)))
    assert content(store.read_hot()) == [("A", 1, 1, 1), ("B", 1, 1, 1)]


def test_an_open_read_is_a_snapshot(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1)))
    before = store.read_hot()
    store.append(frame(spark, ("A", 1, 2, 2)))
    store.move(1000)
    assert content(before) == [("A", 1, 1, 1)]


def test_vacuum_keeps_the_content(spark, store):
    for t in (1, 2000, 3000):
        store.append(frame(spark, ("A", t, t, 1)))
        store.move(1000)
    store.append(frame(spark, ("A", 4000, 1, 1)))
    before = content(store.read_hot()), content(store.read_cold())
    store.vacuum()
    assert (content(store.read_hot()), content(store.read_cold())) == before
    assert len(store.found(f"{store.hot_path}/writer=*/epoch=*")) == 1
    store.append(frame(spark, ("A", 5000, 1, 1)))
    store.move(4500)
    store.vacuum()
    assert content(store.read_hot()) == [("A", 5000, 1, 1)]
    assert len(content(store.read_cold())) == 4


def test_move_needs_one_shuffle(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1)))
    store.append(frame(spark, ("A", 1, 2, 1)))
    state = store.state()
    latest = store._latest(store._appended(state), state, by_day=True)
    assert plan(latest).count("rangepartitioning") == 1
    assert "Aggregate" in plan(latest)
    assert "hashpartitioning" not in plan(latest)


def test_key_and_time_reach_the_scan(spark, store):
    for price in (1, 2):
        store.append(frame(spark, ("A", 1, price, 1)))
    text = plan(store.read_hot().filter("symbol = 'A' and ts > timestamp'1969-01-01'"))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "EqualTo(symbol,A)" in pushed and "GreaterThan(ts" in pushed
    assert "hashpartitioning(symbol" in text


def test_stream_upserts_across_epochs_and_restarts(spark, tmp_path):
    folder, root = str(tmp_path / "in"), str(tmp_path / "store")

    def land(*ticks):
        df = frame(spark, *ticks).withColumn("ts", F.unix_millis("ts"))
        folders.land_messages(msg.pack_messages(df.coalesce(1)), folder)

    def run():
        source = folders.stream_messages(spark, folder, False, clean_source="off")
        start_hot_trades(
            source, root, str(tmp_path / "checkpoint"), availableNow=True
        ).awaitTermination()
        return content(TradeStore(spark, root).read_hot())

    land(("A", 1, 1, 1), ("A", 1, 7, 7), ("B", 1, 1, 1))
    assert run() == [("A", 1, 7, 7), ("B", 1, 1, 1)]
    land(("A", 1, 3, 3), (None, 1, 1, 1))
    assert run() == [("A", 1, 3, 3), ("B", 1, 1, 1)]
    assert run() == [("A", 1, 3, 3), ("B", 1, 1, 1)]


def test_stream_replay_after_a_lost_commit(spark, tmp_path):
    """The batch is written, its commit is lost, a move runs, the stream restarts."""
    folder, root = str(tmp_path / "in"), str(tmp_path / "store")
    df = frame(spark, ("A", 1, 1, 1)).withColumn("ts", F.unix_millis("ts"))
    folders.land_messages(msg.pack_messages(df), folder)

    def run():
        source = folders.stream_messages(spark, folder, False, clean_source="off")
        start_hot_trades(
            source, root, str(tmp_path / "checkpoint"), availableNow=True
        ).awaitTermination()

    run()
    for name in ("0", ".0.crc"):
        (tmp_path / "checkpoint" / "commits" / name).unlink(missing_ok=True)
    store = TradeStore(spark, root)
    store.move(1000)
    run()
    assert content(store.read_hot()) == []
    assert content(store.read_cold()) == [("A", 1, 1, 1)]


def test_timed_moves(spark, store, tmp_path):
    store.append(frame(spark, ("A", 1_000, 1, 1), ("A", 100_000, 1, 1)))
    query = start_moves(
        spark, store.root, str(tmp_path / "checkpoint"), every_s=1, clock=lambda: 120.0
    )
    try:
        for _ in range(60):
            if content(store.read_cold()):
                break
            query.awaitTermination(0.5)
    finally:
        query.stop()
    assert content(store.read_cold()) == [("A", 1_000, 1, 1)]
    assert content(store.read_hot()) == [("A", 100_000, 1, 1)]


def test_batches_without_any_key_or_row(spark, store):
    assert store.append(frame(spark, (None, 1, 1, 1)))["without_key"] == 1
    assert store.append(frame(spark, ("A", 1, 1, 1)).filter("false")).get("rows", 0) == 0
    assert content(store.read_hot()) == []
    store.append(frame(spark, ("A", 1, 1, 1)))
    assert content(store.read_hot()) == [("A", 1, 1, 1)]


def test_time_bounds_leave_out_other_days(spark, store):
    day = DAY_MS
    store.append(frame(spark, *[("A", i * day // 2, i, 1) for i in range(10)]))
    store.move(100 * day)
    part = store.read_cold(day, 2 * day)
    assert [t for _, t, _, _ in content(part)] == [day, day + day // 2]
    assert [t for _, t, _, _ in content(store.read_cold(4 * day))] == [4 * day, 4 * day + day // 2]
    assert len(content(store.read_cold(None, day + 1))) == 3
    days = {name.split("day=")[1][:10] for name in part.inputFiles()}
    assert days == {"1970-01-02", "1970-01-03"}


def test_refresh_sees_new_rows(spark, store, tmp_path):
    shown = []

    def show(hot):
        shown.append(content(hot.filter("symbol = 'A'")))
        store.append(frame(spark, ("A", 1000 + len(shown), 1, 1), ("B", 1, 1, 1)))

    query = start_refresh(spark, store.root, str(tmp_path / "checkpoint"), show, every_s=0.5)
    try:
        for _ in range(60):
            if len(shown) > 2:
                break
            query.awaitTermination(0.5)
    finally:
        query.stop()
    assert [len(x) for x in shown[:3]] == [0, 1, 2]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_history_against_a_model(spark, store, seed):
    """Appends, moves, compactions and vacuums in any order against a plain dictionary."""
    rng = random.Random(seed)
    hot, cold = {}, []
    for step in range(14):
        kind = rng.choice(["append", "append", "move", "compact", "vacuum"])
        if kind == "append":
            batch = [
                (rng.choice("AB"), rng.randrange(12), rng.randrange(9), step, i)
                for i in range(rng.randrange(1, 8))
            ]
            store.append(frame(spark, *batch, extra=", i int"), ["i"])
            hot.update({(s, t): (float(p), v) for s, t, p, v, _ in batch})
        elif kind == "move":
            cutoff = rng.randrange(14)
            moved = store.move(cutoff)
            old = {k: v for k, v in hot.items() if k[1] < cutoff}
            hot = {k: v for k, v in hot.items() if k not in old}
            cold += [(*k, *v) for k, v in old.items()]
            assert (moved["moved"], moved["left"]) == (len(old), len(hot))
        elif kind == "compact":
            store.compact(2 * 86_400_000)
        else:
            store.vacuum()
        assert content(store.read_hot()) == sorted((*k, *v) for k, v in hot.items())
        assert content(store.read_cold()) == sorted(cold)


def test_writers_do_not_harm_each_other(spark, store, monkeypatch):
    """A writer that began first commits after another one and a move."""
    other = TradeStore(spark, store.root)
    began = time.time_ns()
    other.append(frame(spark, ("B", 1, 2, 2), ("A", 5000, 2, 2)), writer="b", epoch=0)
    other.move(1000)
    with monkeypatch.context() as slow:
        slow.setattr("tradeflow.sources.store.time.time_ns", lambda: began)
        store.append(frame(spark, ("A", 1, 1, 1), ("A", 5000, 1, 1)), writer="a", epoch=0)
    assert content(store.read_hot()) == [("A", 1, 1, 1), ("A", 5000, 2, 2)]
    other.move(1000)
    assert content(store.read_hot()) == [("A", 5000, 2, 2)]
    assert content(store.read_cold()) == [("A", 1, 1, 1), ("B", 1, 2, 2)]


def days_of(spark, *days):
    """One trade an hour of two symbols on these days since 1970."""
    return frame(spark, *[(s, DAY_MS * d + 3_600_000 * h, d, h) for s in "AB" for d in days for h in range(24)])


def test_compaction_keeps_the_content(spark, store):
    for part in ((0, 1), (0, 1, 2), (1,)):
        store.append(days_of(spark, *part).withColumn("ts", F.col("ts") + F.make_dt_interval(secs=F.lit(len(part)))))
        store.move(3 * DAY_MS)
    before, pieces = content(store.read_cold()), store.cold_partitions()
    assert pieces == [("1970-01-01", 1), ("1970-01-01", 2), ("1970-01-02", 1), ("1970-01-02", 2), ("1970-01-02", 3), ("1970-01-03", 2)]
    open_read = store.read_cold()
    assert store.compact(2 * DAY_MS) == {"run": 4, "days": 2}
    after = [("1970-01-01", 4), ("1970-01-02", 4), ("1970-01-03", 2)]
    assert content(store.read_cold()) == before and store.cold_partitions() == after
    assert content(open_read) == before
    assert store.compact(2 * DAY_MS) == {"run": 4, "days": 0}
    store.vacuum()
    assert content(store.read_cold()) == before
    assert len(store.found(f"{store.cold_path}/day=*/run=*")) == 3
    # A late row opens its day again; hot rows stay what they were.
    store.append(frame(spark, ("C", 5, 1, 1), ("C", 9 * DAY_MS, 1, 1)))
    store.move(3 * DAY_MS)
    assert store.compact(10 * DAY_MS) == {"run": 6, "days": 1}
    store.vacuum()
    assert content(store.read_cold()) == sorted([*before, ("C", 5, 1, 1)])
    assert content(store.read_hot()) == [("C", 9 * DAY_MS, 1, 1)]
    assert store.cold_partitions() == [("1970-01-01", 6), ("1970-01-02", 4), ("1970-01-03", 2)]


def test_a_dead_compaction_is_not_seen_and_is_replaced(spark, store):
    for t in (1, 2):
        store.append(frame(spark, ("A", t, 1, 1)))
        store.move(1000)
    frame(spark, ("X", 1, 1, 1)).write.parquet(f"{store.cold_path}/day=1970-01-01/run=3")
    assert content(store.read_cold()) == [("A", 1, 1, 1), ("A", 2, 1, 1)]
    assert store.compact(DAY_MS)["days"] == 1
    assert content(store.read_cold()) == [("A", 1, 1, 1), ("A", 2, 1, 1)]
    assert store.cold_partitions() == [("1970-01-01", 3)]


def test_compaction_bounds_files_by_size(spark, store):
    """A large day takes several files, small ones one each."""
    place = {"tier": F.lit("cold"), "day": F.to_date("ts").cast("string"), "run": F.lit(1).cast("bigint")}
    big = spark.range(0, 60_000, 1, 12).selectExpr(
        "concat('S', id % 500) AS symbol", "timestamp_millis(id * 1000) AS ts",
        "CAST(xxhash64(id) % 1000000 / 10000 AS decimal(10,4)) AS price", "CAST(id AS int) AS volume",
    )
    rows_ = big.unionByName(days_of(spark, 3, 4).repartition(3))
    store.write(rows_.withColumns(place), store.moves_path, *place)
    store.commit(store.state(), pieces={f"1970-01-0{d}": 12 for d in (1, 4, 5)})
    before, size = content(store.read_cold()), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    settings = {"spark.sql.files.maxPartitionBytes": "10000", "spark.sql.files.openCostInBytes": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        assert store.compact(9 * DAY_MS, file_bytes=200_000)["days"] == 3
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert content(store.read_cold()) == before and spark.conf.get(size, None) is None
    count = {day: len(store.found(f"{store.cold_path}/day={day}/run={run}/*.parquet")) for day, run in store.cold_partitions()}
    assert count["1970-01-04"] == count["1970-01-05"] == 1
    assert 3 <= count["1970-01-01"] <= 12


def test_state_and_folders_do_not_grow_with_appends(spark, store):
    for i in range(4):
        store.append(frame(spark, ("A", i, 1, 1)))
        store.append(frame(spark, ("B", i, 1, 1)), writer="w", epoch=i)
        store.move(1000)
        store.vacuum()
    assert store.found(f"{store.hot_path}/writer=*/epoch=*") == []
    assert len(store.states()) == 1 and store.state().writers.keys() == {"w", store.writer}
    store.move(1000)
    assert store.state().writers == {"w": 3}


def test_vacuum_waits_for_readers(spark, store):
    store.append(frame(spark, ("A", 1, 1, 1)), writer="a", epoch=0)
    store.append(frame(spark, ("A", 2, 1, 1)), writer="a", epoch=1)
    store.move(1000)
    store.vacuum(older_than_s=600)
    assert len(store.found(f"{store.hot_path}/writer=*/epoch=*")) == 2
    store.vacuum()
    assert store.found(f"{store.hot_path}/writer=*/epoch=*") == [] and content(store.read_hot()) == []


def test_a_symbol_lies_in_few_files(spark, store):
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        store.append(frame(spark, *[(f"S{i % 40:02}", i, 1, 1) for i in range(400)]))
    finally:
        spark.conf.unset(coalesce)
    files = spark.read.parquet(store.hot_path).select("symbol", F.input_file_name().alias("file")).distinct()
    assert files.select("file").distinct().count() >= 3
    assert files.filter("symbol = 'S07'").count() <= 2


def test_places_of_a_long_message(spark, store):
    """Two million ticks of one message: the last one of a key wins."""
    ticks = spark.range(0, 2_000_000, 1, 4).selectExpr(
        "'A' AS symbol", "id % 2 AS ts", "CAST(1 AS decimal(10,4)) AS price", "CAST(id AS int) AS volume",
        "1700000000000 AS at", "7L AS no", "CAST(id AS int) AS pos",
    )
    hot_sink(store.root)(ticks, 0)
    assert content(store.read_hot()) == [("A", 0, 1.0, 1_999_998), ("A", 1, 1.0, 1_999_999)]


def test_arrival_orders_landing_message_and_place(spark):
    values = [(0, 0, 0), (0, 0, 1_999_999), (0, 1, 0), (0, (1 << 33) - 1, 5), (0, 1 << 33, 0), (0, (1 << 52) - 1, 1), (1, 0, 0), (9 * 10**12, 1 << 51, 10**9 - 1)]
    frame_ = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, at bigint, no bigint, pos int")
    got = frame_.select("i", arrival(F.col("at"), F.col("no"), F.col("pos")).alias("rank")).orderBy("rank").collect()
    assert [r.i for r in got] == list(range(len(values)))
    assert len({r["rank"] for r in got}) == len(values)
