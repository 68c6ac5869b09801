"""Lookup joins that hold for any distribution of the keys."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tradeflow.session import pin


def lookup(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` left join ``facts`` on ``key``; ``facts`` has one row per key.

    The facts are written out, so their size is known when the join is planned:
    Spark broadcasts them up to its threshold. Beyond it both sides are shuffled
    once, and adaptive execution splits the partitions of hot keys, null among
    them, by the tasks their rows come from. ``rows`` are read once.
    """
    return rows.join(pin(facts, "facts"), key, "left")
