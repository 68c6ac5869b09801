import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from tradeflow.operators.editor import bounded_sql, chart_points, run_sql
from tradeflow.sources.store import TradeStore
from tradeflow.sources.tables import drop_table, sync_archive_table

TEXT = "SELECT symbol, max(price), max(ts) FROM trades WHERE ts > $__timeFrom AND ts < $__timeTo AND volume >= :least GROUP BY symbol"


@pytest.fixture
def store(spark, tmp_path):
    found = TradeStore(spark, str(tmp_path / "store"))
    ticks = [("A", 1, 1.5, 1), ("A", 2, 2.5, 9), ("A", 3, 3.5, 9), ("B", 2, 4.5, 9), ("B", 9, 5.5, 9)]
    found.append(
        spark.createDataFrame(ticks, "symbol string, ts bigint, price double, volume int")
        .withColumns({"ts": F.timestamp_millis("ts"), "price": F.col("price").cast("decimal(10,4)")})
    )
    return found


def test_bounds_are_open_and_parameters_bind(spark, store):
    found = run_sql(spark, TEXT, {"trades": store.read_hot()}, 1, 9, {"least": 5})
    assert [(s, float(p)) for s, p, _ in rows(found)] == [("A", 3.5), ("B", 4.5)]
    assert not spark.catalog.tableExists("trades")
    points = chart_points(found)
    assert points.columns == ["id", "value", "time"] and dict(points.dtypes)["value"] == "double"
    with pytest.raises(ValueError):
        chart_points(found.select("symbol"))


def test_bounds_reach_the_scan(spark, store):
    text = plan(run_sql(spark, TEXT, {"trades": store.read_hot()}, 1, 9, {"least": 5}))
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line and "ts" in line)
    assert "GreaterThan(ts,1970-01-01 00:00:00.001)" in pushed and "LessThan(ts,1970-01-01 00:00:00.009)" in pushed


def test_markers_in_quotes_and_comments_stay():
    kept = """SELECT '$__timeFrom', "a $__timeTo", `$__timeFrom`, 'it\\'s $__timeTo' -- $__timeFrom '
    /* $__timeTo \n */ FROM t WHERE x > $__timeFromX"""
    assert bounded_sql(kept) == kept
    assert bounded_sql("x > $__timeFrom", "bigint") == "x > :time_from"
    assert bounded_sql("'a' || $__timeTo", "bigint") == "'a' || :time_to"


def test_a_view_of_the_session_is_not_replaced(spark, store):
    spark.range(1).createOrReplaceTempView("trades")
    try:
        with pytest.raises(Exception, match="trades"):
            run_sql(spark, TEXT, {"other": store.read_hot(), "trades": store.read_hot()}, 1, 9, {"least": 5})
        assert spark.table("trades").columns == ["id"] and not spark.catalog.tableExists("other")
    finally:
        spark.catalog.dropTempView("trades")


def test_text_given_as_a_parameter_is_no_sql(spark, store):
    text = "SELECT count(*) AS n FROM trades WHERE symbol = :name"
    assert rows(run_sql(spark, text, {"trades": store.read_hot()}, 0, 0, {"name": "A' OR '1' = '1"})) == [(0,)]


def test_archive_table_follows_moves_and_compaction(spark, store):
    name = "archive_of_test"
    try:
        assert sync_archive_table(spark, name, store) == {"added": 0, "dropped": 0}
        assert spark.table(name).count() == 0
        for cutoff in (2, 3, 4):
            store.move(cutoff)
        assert sync_archive_table(spark, name, store) == {"added": 3, "dropped": 0}
        before = rows(spark.table(name), "symbol", "ts", "price", "volume")
        assert before == rows(store.read_cold().drop("run")) and len(before) == 4
        store.compact(86_400_000)
        assert sync_archive_table(spark, name, store) == {"added": 1, "dropped": 3}
        assert sync_archive_table(spark, name, store) == {"added": 0, "dropped": 0}
        store.vacuum()
        assert rows(spark.table(name), "symbol", "ts", "price", "volume") == before
        text = plan(spark.sql(f"SELECT count(*) FROM {name} WHERE day = '1970-01-01'"))
        assert "PartitionFilters: [isnotnull(day" in text and "CatalogFileIndex" not in text
        assert spark.sql(f"SELECT * FROM {name} WHERE day > '1970-01-01'").count() == 0
    finally:
        drop_table(spark, name)
