"""The test tables seen as trades, stocks and pages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeflow.constants import INDEX_PAGES
from tradeflow.functions.time import epoch_ms_to_timestamp, ntz_to_epoch_ms
from tradeflow.operators.messages import pack_rows
from tradeflow.operators.universe import index_members, universe


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat trades with ``ts`` in epoch ms."""
    return table(spark, sf_dir, "events").select(
        F.col("value").cast("decimal(10,4)").alias("price"),
        F.concat(F.lit("U"), "user_id").alias("symbol"),
        ntz_to_epoch_ms(F.col("ts")).alias("ts"),
        F.get_json_object("props", "$.k").cast("int").alias("volume"),
    )


def timed_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat trades with ``ts`` as a timestamp of whole milliseconds."""
    return trades(spark, sf_dir).withColumn("ts", epoch_ms_to_timestamp(F.col("ts")))


def _members(spark: SparkSession, sf_dir: str, index: str) -> DataFrame:
    """Customers as members of one of two overlapping indexes, under the headers
    of its page."""
    rows = table(spark, sf_dir, "customer")
    chosen = {"S&P500": F.col("c_acctbal") >= 0, "NASDAQ": F.col("c_nationkey") < 12}[index]
    _, symbol, security, sector = INDEX_PAGES[index]
    return rows.filter(chosen).select(
        F.concat(F.lit("U"), "c_custkey").alias(symbol),
        F.col("c_name").alias(security),
        F.col("c_mktsegment").alias(sector),
    )


def stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return universe(
        *[
            index_members(_members(spark, sf_dir, index), *headers, index)
            for index, (_, *headers) in INDEX_PAGES.items()
        ]
    )


PAGE_ROWS = 500
DECOY = "<table><tr><th>Symbol</th></tr><tr><td>none</td></tr></table>"


def html_pages(rows: DataFrame, position: int) -> DataFrame:
    """HTML pages ``(page_id, html)`` that hold the rows in one of their tables."""

    def line(tag: str, values):
        cells = [F.concat(F.lit(f"<{tag}>"), v, F.lit(f"</{tag}>")) for v in values]
        return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))

    def escaped(value):
        value = F.coalesce(value, F.lit(""))
        for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            value = F.replace(value, F.lit(plain), F.lit(entity))
        return value

    html = F.concat(
        F.lit("<html><body>" + DECOY * position + "<table><thead>"),
        line("th", [escaped(F.lit(name)) for name in rows.columns]),
        F.lit("</thead><tbody>"),
        F.array_join(
            F.transform("rows", lambda r: line("td", [escaped(r[c]) for c in rows.columns])), ""
        ),
        F.lit("</tbody></table>" + DECOY + "</body></html>"),
    )
    pages = pack_rows(rows, PAGE_ROWS)
    return pages.select(F.monotonically_increasing_id().alias("page_id"), html.alias("html"))


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers as stocks, in the second table of each page."""
    rows = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("U"), "c_custkey").alias("Ticker"),
        F.col("c_name").alias("Company"),
        F.concat("c_mktsegment", F.lit(" & more")).alias("GICS Sector"),
    )
    return html_pages(rows, 1)


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of both indexes, ``(page_id, index, html)``."""
    return reduce(
        DataFrame.unionByName,
        [
            html_pages(_members(spark, sf_dir, index), position).withColumn("index", F.lit(index))
            for index, (position, *_) in INDEX_PAGES.items()
        ],
    )
