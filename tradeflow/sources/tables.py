"""Parquet folders, catalog tables and training files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tradeflow.schemas import STOCKS, TRADES
from tradeflow.sources.store import TradeStore


def overwrite_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def append_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def create_stocks_table(spark: SparkSession, name: str, location: str) -> None:
    """External table over a stocks folder, if it does not exist yet.

    The columns are plain strings: fixed-width ones would be padded on read,
    which breaks joins and keeps equality tests away from the scan.
    """
    create_external_table(spark, name, location, STOCKS)


def create_external_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType,
    partitions: tuple[str, ...] = (),
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = location.replace("\\", "\\\\").replace("'", "\\'")
    parted = f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}) USING parquet {parted}LOCATION '{place}'"
    )


def sync_archive_table(spark: SparkSession, name: str, store: TradeStore) -> dict[str, int]:
    """External table over the archived trades, partitioned by day and run.

    The catalog is given the folders that hold the archive as of now, and forgets those
    that compaction has replaced, so a query sees committed rows only and lists no
    folder; tests on ``day`` choose its partitions. To be called again after moves and
    compactions, before the replaced files are vacuumed. Returns how many partitions
    were added and dropped.
    """
    schema = T.StructType([*TRADES.fields]).add("day", "string").add("run", "long")
    create_external_table(spark, name, store.cold_path, schema, ("day", "run"))
    table, now = _quoted(name), set(store.cold_partitions())
    shown = [r[0].split("/") for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    known = {(day.removeprefix("day="), int(run.removeprefix("run="))) for day, run in shown}
    for change, found in (("ADD IF NOT EXISTS", sorted(now - known)), ("DROP IF EXISTS", sorted(known - now))):
        comma = ", " if change.startswith("DROP") else " "
        for at in range(0, len(found), 500):
            parts = comma.join(f"PARTITION (day='{day}', run={run})" for day, run in found[at : at + 500])
            spark.sql(f"ALTER TABLE {table} {change} {parts}")
    return {"added": len(now - known), "dropped": len(known - now)}


def _quoted(name: str) -> str:
    """A table's name, with a database before a dot, as SQL takes it."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM {_quoted(name)}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Takes an external table out of the catalog; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def read_training(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header. Types are inferred, at the price of one more pass over
    the files, unless a schema is given."""
    reader = spark.read.option("header", True)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", True).csv(path)


def write_training(trades: DataFrame, path: str) -> None:
    trades.select("volume", "price").write.mode("overwrite").option("header", True).csv(path)
