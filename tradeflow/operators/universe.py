"""The stock universe: one row per stock and index."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tradeflow.constants import FIRST_SYMBOLS, INDEX_PAGES
from tradeflow.sources.html import cell_columns, html_table


def index_members(
    table: DataFrame, symbol: str, security: str, sector: str, index: str
) -> DataFrame:
    """Three columns of a page's table under their common names, plus the index."""
    return (
        table.select(symbol, security, sector)
        .withColumnsRenamed({symbol: "Symbol", security: "Security", sector: "Sector"})
        .withColumn("Index", F.lit(index))
    )


def universe(*members: DataFrame) -> DataFrame:
    """All members of all indexes; a stock in two indexes keeps two rows."""
    return reduce(DataFrame.unionByName, members)


def universe_from_pages(pages: DataFrame) -> DataFrame:
    """The universe from HTML pages ``(page_id, index, html)``, each read by the
    table position and headers of its index."""
    members = []
    for index, (position, *headers) in INDEX_PAGES.items():
        own = pages.filter(F.col("index") == index)
        table = cell_columns(html_table(own, "html", "page_id", position), *headers)
        members.append(index_members(table, *headers, index))
    return universe(*members)


def stock_label() -> Column:
    return F.concat("Symbol", F.lit("("), "Security", F.lit(")"))


def pick_stocks(stocks: DataFrame, index: str | None) -> DataFrame:
    """Distinct stocks of one index with their label, sorted by symbol.

    With no index chosen the comparison is to null and nothing is listed.
    """
    return (
        stocks.filter(F.col("Index") == F.lit(index))
        .select("Symbol", "Security")
        .distinct()
        .select("Symbol", "Security", stock_label().alias("label"))
        .orderBy("Symbol")
    )


def index_names(stocks: DataFrame) -> DataFrame:
    return stocks.select("Index").distinct()


def first_symbols(stocks: DataFrame, n: int = FIRST_SYMBOLS) -> DataFrame:
    """The first ``n`` distinct symbols in ascending order."""
    return stocks.select("Symbol").distinct().orderBy("Symbol").limit(n)


def universe_counts(stocks: DataFrame) -> DataFrame:
    """Rows and distinct stocks per index."""
    return stocks.groupBy("Index").agg(
        F.count(F.lit(1)).alias("listings"), F.countDistinct("Symbol").alias("stocks")
    )


def stock_facts(stocks: DataFrame) -> DataFrame:
    """One row per symbol: security, sector and its indexes, joined by commas.

    The set per symbol holds distinct index names only, so copies do not grow it.
    """
    return stocks.groupBy(F.col("Symbol").alias("symbol")).agg(
        F.min("Security").alias("security"),
        F.min("Sector").alias("sector"),
        F.array_join(F.sort_array(F.collect_set("Index")), ",").alias("indexes"),
    )
