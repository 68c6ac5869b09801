"""Trade messages: pack ticks into envelopes, encode, parse, flatten.

A message is ``{"data": [{"p": price, "s": symbol, "t": ms, "v": volume}, ..],
"type": ".."}``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from tradeflow.schemas import MESSAGE

MAX_TICKS = 1000


def pack_rows(df: DataFrame, max_rows: int, name: str = "rows") -> DataFrame:
    """Runs of at most ``max_rows`` neighbouring rows as one array of structs.

    The rows are cut where they lie, by slicing Arrow batches, so nothing is
    shuffled and no array can outgrow ``max_rows``, however the data is keyed.
    Grouping on a made-up key would move every row across the network first.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.StructArray.from_arrays(batch.columns, names=batch.schema.names)
            starts = [*range(0, len(rows), max_rows), len(rows)]
            arrays = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([arrays], names=[name])

    packed = T.StructType([T.StructField(name, T.ArrayType(df.schema))])
    return df.mapInArrow(cut, packed)


def pack_messages(
    trades: DataFrame, max_ticks: int = MAX_TICKS, kind: str = "trade"
) -> DataFrame:
    """Flat trades ``(price, symbol, ts ms, volume)`` to messages ``(data, type)``."""
    ticks = trades.select(
        F.col("price").cast("decimal(10,4)").alias("p"),
        F.col("symbol").alias("s"),
        F.col("ts").alias("t"),
        F.col("volume").alias("v"),
    )
    return pack_rows(ticks, max_ticks, "data").withColumn("type", F.lit(kind))


def encode(messages: DataFrame) -> DataFrame:
    """Messages to one JSON text per row, in the column ``value``."""
    landed = [c for c in ("at", "no") if c in messages.columns]
    return messages.select(F.to_json(F.struct("data", "type", *landed)).alias("value"))


def parse(texts: DataFrame, column: str = "value") -> DataFrame:
    """JSON texts to messages; a corrupt text gives a message without ticks."""
    return texts.select(F.from_json(column, MESSAGE).alias("m")).select("m.data", "m.type")


def flatten(
    messages: DataFrame, only_type: str | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """One row per tick: ``price, symbol, ts, volume``, then ``keep`` columns.

    Messages without ticks give no rows; a null tick gives a row of nulls. The
    type of a message is not looked at unless ``only_type`` is given. The
    position of the tick in its message is available to ``keep`` as ``pos``.
    """
    if only_type is not None:
        messages = messages.filter(F.col("type") == only_type)
    carried = [c for c in keep if c != "pos"]
    # The outer form plus a test of the position drops the same messages as the
    # plain one, but adds no size(data) filter below, which would make Spark
    # parse each JSON text twice.
    return (
        messages.select(*carried, F.posexplode_outer("data").alias("pos", "tick"))
        .filter(F.col("pos").isNotNull())
        .select(
            F.col("tick.p").alias("price"),
            F.col("tick.s").alias("symbol"),
            F.col("tick.t").alias("ts"),
            F.col("tick.v").alias("volume"),
            *keep,
        )
    )


def subscriptions(symbols: DataFrame, column: str = "Symbol") -> DataFrame:
    """One subscribe message per symbol, as JSON text in ``message``."""
    body = F.struct(F.lit("subscribe").alias("type"), F.col(column).alias("symbol"))
    return symbols.select(F.to_json(body).alias("message"))
