"""Last write wins: the latest row of each key."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F


def arrival(at: Column, no: Column, pos: Column) -> Column:
    """Order of arrival as one number: landing ms, number of the message, place in it.

    A decimal has a fixed width, so an aggregate over it stays hash based. Its 38 digits
    are 13 for the time, 16 for the number, which is one of a million tasks of a landing
    above and a row of the task below (33 bits), and 9 for the place: a message is one
    text, and a text of the greatest size has fewer ticks.
    """
    row = no.bitwiseAND(F.lit((1 << 33) - 1)).cast("decimal(10,0)")
    task = F.shiftrightunsigned(no, 33).cast("decimal(6,0)")
    number = (at.cast("decimal(13,0)") * F.lit(Decimal(10**6))).cast("decimal(19,0)") + task
    number = (number.cast("decimal(19,0)") * F.lit(Decimal(10**10))).cast("decimal(29,0)") + row
    number = (number.cast("decimal(29,0)") * F.lit(Decimal(10**9))).cast("decimal(38,0)")
    return (number + pos.cast("decimal(9,0)")).cast("decimal(38,0)")


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[str], values: list[str]
) -> DataFrame:
    """``keys`` and ``values`` of the row with the greatest ``order`` per key.

    An aggregate and not a window, so all copies of a hot key shrink to one row
    per task before the shuffle. One order column of a fixed width keeps the
    plan a hash aggregate; it must be distinct per key and not null. With any
    other number, ties are broken by the values, so the result does not depend
    on the order of arrival.
    """
    if len(order) == 1:
        picked = [F.max_by(v, order[0]).alias(v) for v in values]
        return df.groupBy(*keys).agg(*picked)
    ranks = [F.col(name).alias(f"_rank{i}") for i, name in enumerate(order)]
    last = F.max(F.struct(*ranks, *values)).alias("_last")
    return df.groupBy(*keys).agg(last).select(*keys, *[f"_last.{v}" for v in values])
