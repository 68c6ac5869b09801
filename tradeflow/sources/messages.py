"""Message folders: landing files, batch and streaming reads."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeflow.operators.messages import encode
from tradeflow.schemas import MESSAGE


def land_messages(
    messages: DataFrame, path: str, at_ms: int | None = None, per_file: int = 0
) -> None:
    """Append messages to a folder as JSON lines, one document per line.

    Each document carries the epoch ms of its landing and its number in it, which
    give the order of arrival; names of files do not. Many documents share a file,
    so the number of files follows the number of tasks and not of messages, unless
    ``per_file`` bounds the documents of a file.
    """
    at_ms = time.time_ns() // 1_000_000 if at_ms is None else at_ms
    numbered = messages.withColumns(
        {"at": F.lit(at_ms).cast("bigint"), "no": F.monotonically_increasing_id()}
    )
    encode(numbered).write.mode("append").option("maxRecordsPerFile", per_file).text(path)


def _with_origin(messages: DataFrame) -> DataFrame:
    """Files that others landed tell the order by the time they were written; their
    messages have no number, so a number of the file stands for it."""
    written = F.unix_millis("_metadata.file_modification_time")
    other = F.pmod(F.xxhash64("_metadata.file_name"), F.lit(1 << 52))
    return messages.select(
        "data",
        "type",
        F.col("_metadata.file_name").alias("file"),
        F.coalesce("at", written).alias("at"),
        F.coalesce("no", other).alias("no"),
    )


def read_messages(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Messages of a folder, with the name of the file each came from.

    ``multi_line`` is for files that hold one document spread over several lines.
    """
    reader = spark.read.schema(MESSAGE).option("multiLine", multi_line)
    return _with_origin(reader.json(path))


def stream_messages(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    clean_source: str = "delete",
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """The same as a stream. Processed files are removed by default, and a file is
    one document; ``multi_line=False`` is for files of ``land_messages``.

    ``max_files`` and ``max_bytes`` bound one micro-batch, so a backlog is
    worked off in steps of a known size.
    """
    reader = (
        spark.readStream.schema(MESSAGE)
        .option("multiLine", multi_line)
        .option("cleanSource", clean_source)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return _with_origin(reader.json(path))
