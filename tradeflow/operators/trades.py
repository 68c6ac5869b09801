"""Operators over flat trades."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tradeflow.functions.time import bound
from tradeflow.operators.skew import lookup
from tradeflow.operators.universe import stock_facts
from tradeflow.session import pin

# What runs on executors travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def symbols(trades: DataFrame) -> DataFrame:
    return trades.select("symbol").distinct()


def older_than(trades: DataFrame, cutoff: int, column: str = "ts") -> Column:
    """The age test, on the bare column so that it reaches the scan."""
    return F.col(column) < bound(cutoff, trades.schema[column].dataType)


def enrich(trades: DataFrame, stocks: DataFrame) -> DataFrame:
    """Trades with security, sector and indexes of their stock; none is lost."""
    return lookup(trades, stock_facts(stocks), "symbol")


def series(
    df: DataFrame,
    id_column: str,
    value_column: str,
    time_column: str,
    ids: list,
    start_ms: int,
    end_ms: int,
    alias: str | None = None,
) -> DataFrame:
    """Chart points ``id, value, time`` of some ids, strictly inside a time range.

    ``alias`` replaces the id in the result, as a legend text. The tests are on
    bare columns against constants and reach the Parquet scan.
    """
    time_type = df.schema[time_column].dataType
    shown = F.col(id_column) if alias is None else F.lit(alias)
    return df.filter(
        F.col(id_column).isin(ids)
        & (F.col(time_column) > bound(start_ms, time_type))
        & (F.col(time_column) < bound(end_ms, time_type))
    ).select(
        shown.alias("id"),
        F.col(value_column).cast("double").alias("value"),
        F.col(time_column).alias("time"),
    )


def with_previous_price(trades: DataFrame) -> DataFrame:
    """Trades with ``price_lag1``, the price of the symbol's previous trade.

    Trades are ordered by time, then price, then volume. One range shuffle sorts
    them all; it cuts anywhere in that order, inside a symbol too, and the source
    split as the last sort column cuts inside a group of copies. In a sorted slice
    the previous price is the row before. Only the first row of a slice takes it
    from another one, so these rows alone are joined with the slices' last rows.
    The cut points are sampled, so the slices are written out once.
    """
    order = ["symbol", "ts", "price", "volume"]
    more = [T.StructField("price_lag1", trades.schema["price"].dataType)]
    more += [T.StructField(f"_{c}", T.BooleanType()) for c in ("head", "tail")]
    slices = pin(
        trades.withColumn("_split", F.spark_partition_id())
        .repartitionByRange(*order, "_split")
        .sortWithinPartitions(*order)
        .drop("_split")
        .mapInArrow(_lag_in_order, T.StructType([*trades.schema.fields, *more]))
        .withColumn("_slice", F.spark_partition_id()),
        "slices",
    )
    # One row per slice.
    before = Window.orderBy("_slice")
    last = slices.filter("_tail").select("_slice", F.struct("symbol", "price").alias("_row"))
    last = last.select("_slice", F.lag("_row").over(before).alias("_before"))
    same = F.col("_before.symbol").eqNullSafe(F.col("symbol")) & F.col("_before").isNotNull()
    heads = slices.filter("_head").drop("price_lag1").join(last, "_slice", "left")
    heads = heads.withColumn("price_lag1", F.when(same, F.col("_before.price")))
    columns = [*trades.columns, "price_lag1"]
    return slices.filter("NOT _head").select(*columns).unionByName(heads.select(*columns))


def _lag_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the price of the row before, if it has the same symbol, and whether the
    row is the first or last of its partition."""
    before, held = None, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        symbol, price = batch.column("symbol"), batch.column("price")
        if before is None:
            before = (pa.nulls(1, symbol.type), pa.nulls(1, price.type))
        elif held is not None:
            yield _marked(*held, tail=False)
        first = held is None
        symbols, prices = (
            pa.concat_arrays([b, c.slice(0, n - 1)]) for b, c in zip(before, (symbol, price))
        )
        both_null = pc.and_(pc.is_null(symbol), pc.is_null(symbols))
        same = pc.or_(pc.fill_null(pc.equal(symbol, symbols), False), both_null)
        lag = pc.if_else(same, prices, pa.nulls(n, price.type))
        before = (symbol.slice(n - 1), price.slice(n - 1))
        held = (batch, lag, first)
    if held is not None:
        yield _marked(*held, tail=True)


def _marked(batch: pa.RecordBatch, lag: pa.Array, first: bool, tail: bool) -> pa.RecordBatch:
    n = batch.num_rows
    head = pa.array([first, *[False] * (n - 1)])
    last = pa.array([*[False] * (n - 1), tail])
    names = [*batch.schema.names, "price_lag1", "_head", "_tail"]
    return pa.RecordBatch.from_arrays([*batch.columns, lag, head, last], names)
