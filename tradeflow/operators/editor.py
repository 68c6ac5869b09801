"""Free SQL over tables, within the time bounds of a dashboard."""

from __future__ import annotations

import re
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

# A marker counts outside of quotes and comments only.
_QUOTED = r"'(?:[^'\\]|\\.)*'" + r'|"(?:[^"\\]|\\.)*"' + r"|`[^`]*`|--[^\n]*|/\*.*?\*/"
_MARKER = re.compile(rf"(?s)({_QUOTED})|\$__time(From|To)\b")

# How a marker is written for a time column of this type; a constant, so a test of the
# bare column against it reaches the scan.
_TIMES = {
    "timestamp": "timestamp_millis(:{name})",
    "timestamp_ntz": "timestampadd(MILLISECOND, :{name}, timestamp_ntz'1970-01-01 00:00:00')",
    "bigint": ":{name}",
}


def bounded_sql(text: str, time_type: str = "timestamp") -> str:
    """The text with ``$__timeFrom`` and ``$__timeTo`` as named parameters."""

    def marker(found: re.Match) -> str:
        if found[1] is not None:
            return found[1]
        return _TIMES[time_type].format(name=f"time_{found[2].lower()}")

    return _MARKER.sub(marker, text)


def run_sql(
    spark: SparkSession,
    text: str,
    tables: dict[str, DataFrame],
    start_ms: int,
    end_ms: int,
    args: dict[str, Any] | None = None,
    time_type: str = "timestamp",
) -> DataFrame:
    """One query over ``tables`` by their names, with ``:name`` taken from ``args``.

    ``$__timeFrom`` and ``$__timeTo`` stand for the bounds as values of ``time_type``,
    the type of the time columns that they are compared with. The result is bound to
    the tables given, so their names are free again afterwards; a name that the
    session already has as a view is refused. Without a marker nothing is bounded.
    """
    made = []
    try:
        for name, table in tables.items():
            table.createTempView(name)
            made.append(name)
        bounds = {"time_from": start_ms, "time_to": end_ms}
        return spark.sql(bounded_sql(text, time_type), args={**(args or {}), **bounds})
    finally:
        for name in made:
            spark.catalog.dropTempView(name)


def chart_points(rows: DataFrame) -> DataFrame:
    """The first three columns as chart points ``id, value, time``, in this order; the
    others are left out."""
    if len(rows.columns) < 3:
        raise ValueError("a chart takes an id, a value and a time, in this order")
    first = rows.toDF(*[f"_{i}" for i in range(len(rows.columns))])
    return first.select(F.col("_0").alias("id"), F.col("_1").cast("double").alias("value"), F.col("_2").alias("time"))
