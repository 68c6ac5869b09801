"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# UTC keeps epoch milliseconds and timestamps interchangeable. INT64 timestamps
# carry min/max statistics in Parquet, so a time range can skip row groups; the
# default INT96 encoding has none.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder; a cluster
    session is refused, since a machine-local folder would not survive there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):  # local-cluster is a cluster
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tradeflow-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark)}/tradeflow/{name}-{uuid.uuid4().hex}"


_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


@contextmanager
def noted() -> Iterator[list[str]]:
    """Lists the tables that ``pin`` makes meanwhile, to be dropped once what was made
    from them is stored."""
    token = _made.set([])
    try:
        yield _made.get()
    finally:
        _made.reset(token)


def pin(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder.

    For what is read more than once or must not change between two reads. The
    table outlives any executor, and later reads take only the columns they use.
    """
    path = work_folder(df.sparkSession, name)
    if _made.get() is not None:
        _made.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """As ``pin``, in buckets of ``key``, as many as there are shuffle partitions: joins
    on ``key`` then shuffle their other side only. The rows should already be shuffled
    by ``key``, or each task writes a file for each bucket. The catalog keeps no entry."""
    spark = df.sparkSession
    path, table = work_folder(spark, name), f"pinned_{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")  # external: its files stay


def drop_tables(spark: SparkSession, folders: list[str]) -> None:
    """Deletes work folders, once the results that were made from them are stored."""
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def collect_garbage(spark: SparkSession) -> None:
    """Lets go of finished plans in a loop of many: Spark deletes their shuffle files
    once the driver has collected them, by itself every half an hour only."""
    spark._jvm.System.gc()


def drop_work(spark: SparkSession) -> None:
    """Deletes all work folders and pinned tables below the shared folder, once the
    results that were made from them have been read."""
    drop_tables(spark, [f"{shared_folder(spark)}/tradeflow"])
