from helpers import plan, rows

from tradeflow.operators import universe as uni
from tradeflow.schemas import STOCKS
from tradeflow.sources import tables

ROWS = [
    ("MMM", "3M", "Industrials", "S&P500"),
    ("AAPL", "Apple", "IT", "S&P500"),
    ("AAPL", "Apple", "IT", "NASDAQ"),
    ("TSLA", "Tesla", "Cars", "NASDAQ"),
    ("TSLA", "Tesla", "Cars", "NASDAQ"),
]


def stocks(spark):
    return spark.createDataFrame(ROWS, STOCKS)


def test_members_and_union(spark):
    a = spark.createDataFrame([("MMM", "3M", "x", 1)], ["Symbol", "Security", "GICS Sector", "n"])
    b = spark.createDataFrame([("Apple", "IT", "AAPL")], ["Company", "GICS Sector", "Ticker"])
    out = uni.universe(
        uni.index_members(a, "Symbol", "Security", "GICS Sector", "S&P500"),
        uni.index_members(b, "Ticker", "Company", "GICS Sector", "NASDAQ"),
    )
    assert out.columns == ["Symbol", "Security", "Sector", "Index"]
    assert rows(out) == [("AAPL", "Apple", "IT", "NASDAQ"), ("MMM", "3M", "x", "S&P500")]


def test_union_keeps_duplicates(spark):
    assert uni.universe(stocks(spark), stocks(spark)).count() == 2 * len(ROWS)


def test_picker(spark):
    out = uni.pick_stocks(stocks(spark), "NASDAQ").collect()
    assert [r.label for r in out] == ["AAPL(Apple)", "TSLA(Tesla)"]
    assert uni.pick_stocks(stocks(spark), None).collect() == []


def test_lists_and_counts(spark):
    assert rows(uni.index_names(stocks(spark))) == [("NASDAQ",), ("S&P500",)]
    assert rows(uni.universe_counts(stocks(spark))) == [("NASDAQ", 3, 2), ("S&P500", 2, 2)]
    assert [r[0] for r in uni.first_symbols(stocks(spark), 2).collect()] == ["AAPL", "MMM"]
    assert "TakeOrderedAndProject" in plan(uni.first_symbols(stocks(spark), 2))


def test_facts_are_one_row_per_symbol(spark):
    assert rows(uni.stock_facts(stocks(spark))) == [
        ("AAPL", "Apple", "IT", "NASDAQ,S&P500"),
        ("MMM", "3M", "Industrials", "S&P500"),
        ("TSLA", "Tesla", "Cars", "NASDAQ"),
    ]


def test_table_over_a_folder(spark, tmp_path):
    folder = str(tmp_path / "an index's stocks")
    tables.overwrite_parquet(stocks(spark).limit(1), folder)
    tables.overwrite_parquet(stocks(spark), folder)
    for _ in range(2):
        tables.create_stocks_table(spark, "stocks_test", folder)
    table = tables.scan_table(spark, "stocks_test")
    try:
        assert rows(table) == rows(stocks(spark))
        assert [f.dataType.simpleString() for f in table.schema] == ["string"] * 4
        # A join to a plain string column matches, and the test reaches the scan.
        assert table.join(stocks(spark).distinct(), ["Symbol", "Index"]).count() == 5
        assert "EqualTo(Index,NASDAQ)" in plan(uni.pick_stocks(table, "NASDAQ"))
    finally:
        tables.drop_table(spark, "stocks_test")
        assert not spark.catalog.tableExists("stocks_test")


def test_append_parquet(spark, tmp_path):
    for _ in range(2):
        tables.append_parquet(stocks(spark), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2 * len(ROWS)
