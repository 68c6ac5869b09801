"""Words, tables and keys that several operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A word is a run of characters other than the six ASCII white space characters;
# ``bytes.split`` cuts at the same six.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def power_of_two(n: float) -> int:
    """Exponent of the smallest power of two that is at least ``n``."""
    return max(0, math.ceil(math.log2(max(1.0, n))))


def key128(text: Column, mark: str = "") -> list[Column]:
    """Two independent 64-bit hashes as the columns ``_h1`` and ``_h2``."""
    return [
        F.xxhash64(text).alias(f"_h1{mark}"),
        F.xxhash64(F.lit("second"), text, F.length(text)).alias(f"_h2{mark}"),
    ]
