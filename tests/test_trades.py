import datetime
import random
from decimal import Decimal as D

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tradeflow.functions import time as ft
from tradeflow.operators import trades as tr, universe as uni
from tradeflow.operators.latest import latest_per_key
from tradeflow.schemas import STOCKS

TRADES = "price decimal(10,4), symbol string, ts bigint, volume int"


def test_times(spark):
    df = spark.sql("select timestamp_ntz'2024-01-15 00:00:00.0015' n, 1705276800001L m")
    row = df.select(
        ft.ntz_to_epoch_ms(F.col("n")),
        ft.ntz_to_epoch_ms_rounded(F.col("n")),
        ft.epoch_ms_to_ntz(F.col("m")),
        ft.timestamp_to_ntz(ft.epoch_ms_to_timestamp(F.col("m"))),
    ).first()
    same = datetime.datetime(2024, 1, 15, 0, 0, 0, 1000)
    assert tuple(row) == (1705276800001, 1705276800002, same, same)
    assert ft.cutoff_ms(1_000_000) == 940_000
    now = spark.range(1).select(ft.now_ms()).first()[0]
    assert abs(now - datetime.datetime.now().timestamp() * 1000) < 60_000


@pytest.mark.parametrize("kind", ["bigint", "timestamp", "timestamp_ntz"])
def test_series_is_open_at_both_ends(spark, kind):
    df = spark.createDataFrame(
        [("A", t, t * 10, D(t)) for t in (1000, 2000, 3000, 4000)] + [("B", 2000, 1, D(1))],
        "id string, ms bigint, volume int, price decimal(10,4)",
    )
    time = {
        "bigint": F.col("ms"),
        "timestamp": F.timestamp_millis("ms"),
        "timestamp_ntz": ft.epoch_ms_to_ntz(F.col("ms")),
    }[kind]
    df = df.withColumn("at", time)
    out = tr.series(df, "id", "price", "at", ["A"], 1000, 4000)
    assert out.columns == ["id", "value", "time"]
    assert sorted((r.id, r.value) for r in out.collect()) == [("A", 2000.0), ("A", 3000.0)]
    named = tr.series(df, "id", "volume", "at", ["A", "B"], 1000, 2001, alias="x")
    assert sorted((r.id, r.value) for r in named.collect()) == [("x", 1.0), ("x", 20000.0)]


def test_series_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    text = plan(tr.series(events, "user_id", "value", "ts", [1, 2], 0, 1705276800000))
    for part in ("In(user_id, [1,2])", "GreaterThan(ts", "LessThan(ts"):
        assert part in text
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in text


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", None), ("a", 2, None, 5), ("b", 1, "y", 6)], "k string, n int, v string, w int"
    )
    expected = [("a", None, 5), ("b", "y", 6)]
    assert rows(latest_per_key(df, ["k"], ["n"], ["v", "w"])) == expected
    assert rows(latest_per_key(df, ["k"], ["n", "k"], ["v", "w"])) == expected
    hashed = latest_per_key(df.select("k", "n", "w"), ["k"], ["n"], ["w"])
    assert "HashAggregate" in plan(hashed) and "SortAggregate" not in plan(hashed)


def hot_trades(spark, n, hot_share=0.5, seed=1):
    """Trades with one hot symbol, equal times, exact copies and nulls."""
    rng = random.Random(seed)
    data = []
    for _ in range(n):
        symbol = "HOT" if rng.random() < hot_share else rng.choice(["A", "B", "C", None])
        price = None if rng.random() < 0.05 else D(rng.randrange(5))
        data.append((price, symbol, rng.choice([7, 7, 7, rng.randrange(n)]), rng.randrange(3)))
    return spark.createDataFrame(data, TRADES).repartition(5)


def brute_lag(table):
    def first(v):
        return (v is not None, v if v is not None else 0)

    out, last = [], {}
    for price, symbol, ts, volume in sorted(
        table, key=lambda r: (first(r[2]), first(r[0]), first(r[3]))
    ):
        out.append((price, symbol, ts, volume, last.get(symbol)))
        last[symbol] = price
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


@pytest.fixture(params=["coalesced", "all slices", "small batches"])
def slices(spark, request):
    conf = {
        "coalesced": {},
        "all slices": {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "23"},
        "small batches": {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"},
    }[request.param]
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_previous_price(spark, slices):
    df = hot_trades(spark, 1500)
    out = tr.with_previous_price(df)
    assert rows(out) == brute_lag([tuple(r) for r in df.collect()])
    assert tr.with_previous_price(df.limit(0)).count() == 0


def test_previous_price_of_copies_only(spark, slices):
    df = spark.range(0, 1000, 1, 8).selectExpr(
        "cast(5 as decimal(10,4)) price", "'HOT' symbol", "7L ts", "1 volume"
    )
    out = tr.with_previous_price(df)
    assert out.filter("price_lag1 = 5").count() == 999
    assert out.filter("price_lag1 is null").count() == 1


def facts_of(spark, *symbols):
    data = [(s, f"{s} Inc", "x", i) for s in symbols for i in ("NASDAQ", "S&P500")]
    return spark.createDataFrame(data, STOCKS)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_enrich_keeps_every_trade(spark, threshold):
    df = hot_trades(spark, 800)
    name = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(name, threshold)
    try:
        out = tr.enrich(df, facts_of(spark, "HOT", "A", "Z"))
        assert ("BroadcastHashJoin" in plan(out)) == (threshold != "-1")
        check_enriched(df, out)
    finally:
        spark.conf.unset(name)


def check_enriched(df, out):
    assert out.count() == 800
    for symbol, found in (("HOT", True), ("A", True), ("B", False)):
        part = out.filter(F.col("symbol") == symbol)
        assert part.count() == df.filter(F.col("symbol") == symbol).count() > 0
        assert part.filter(F.col("indexes").eqNullSafe("NASDAQ,S&P500" if found else None)).count() == part.count()
    assert rows(out, *df.columns) == rows(df)


def test_older_than_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert "LessThan(ts" in plan(events.filter(tr.older_than(events, 1705276800000)))


def test_symbols(spark):
    df = hot_trades(spark, 200)
    assert rows(tr.symbols(df)) == [(None,), ("A",), ("B",), ("C",), ("HOT",)]
    assert rows(uni.index_names(facts_of(spark, "A"))) == [("NASDAQ",), ("S&P500",)]
