"""Fixed schemas."""

from pyspark.sql import types as T

TICK = T.StructType(
    [
        T.StructField("p", T.DecimalType(10, 4)),
        T.StructField("s", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("v", T.IntegerType()),
    ]
)

# ``at`` and ``no`` are added on landing: its epoch ms, and the message's number in it.
MESSAGE = T.StructType(
    [
        T.StructField("data", T.ArrayType(TICK)),
        T.StructField("type", T.StringType()),
        T.StructField("at", T.LongType()),
        T.StructField("no", T.LongType()),
    ]
)

# Keyed trades: the key is (symbol, ts).
TRADES = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("price", T.DecimalType(10, 4)),
        T.StructField("volume", T.IntegerType()),
    ]
)

STOCKS = T.StructType(
    [
        T.StructField("Symbol", T.StringType()),
        T.StructField("Security", T.StringType()),
        T.StructField("Sector", T.StringType()),
        T.StructField("Index", T.StringType()),
    ]
)

TRAINING = T.StructType(
    [
        T.StructField("volume", T.IntegerType()),
        T.StructField("price", T.DoubleType()),
    ]
)
