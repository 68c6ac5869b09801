"""Which rows may have their key in a table, judged where the rows lie.

Wide rows that few keys ask for would all be shuffled by a join with a table beyond
Spark's broadcast threshold. Here one bit per hash of a key, ``PER_KEY`` bits per
key and ``MOST`` in all, goes to every task, packed into words of 64 bits: the bits
have a bound, whatever the table. A row whose bit is unset has no key in the table;
the others are few and still need the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeflow.llm.common import power_of_two
from tradeflow.session import pin

PER_KEY, LEAST, MOST = 16, 1 << 10, 1 << 24


def marked(rows: DataFrame, key: str, table: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``_maybe``: false where the key is surely not in ``table``, whose
    one column has the keys. Null keys match null keys; keys may repeat in both."""
    (column,) = table.columns
    size = min(MOST, max(LEAST, 1 << power_of_two(PER_KEY * table.count())))

    def place(c: str):
        return F.pmod(F.xxhash64(F.lit("member"), c), F.lit(size))

    bits = table.select(place(column).alias("_at"))
    bits = bits.groupBy(F.floor(F.col("_at") / 64).cast("int").alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 AS int))")).alias("_bits")
    )
    rows = rows.withColumn("_at", place(key)).withColumn("_word", F.floor(F.col("_at") / 64).cast("int"))
    found = rows.join(F.broadcast(pin(bits, name)), "_word", "left")
    bit = F.expr("shiftright(_bits, cast(_at % 64 AS int)) & 1L = 1L")
    return found.withColumn("_maybe", F.coalesce(bit, F.lit(False))).drop("_word", "_at", "_bits")
