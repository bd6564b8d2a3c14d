"""Streaming sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerline.operators.windows import dense_index
from ledgerline.streaming.sinks import stream_batches


def rate_stream(spark: SparkSession, rows_per_second: int = 10) -> DataFrame:
    """A clock: columns ``timestamp`` and ``value``, counting up from 0."""
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def replay(clock: DataFrame, static: DataFrame, index: str = "index", restamp: str | None = None) -> DataFrame:
    """One row of a static table per tick of a clock.

    Clock values are looked up in the row index of the table; a tick beyond the
    table gives a row of NULLs.  With ``restamp`` the tick's time replaces that
    column of the table, otherwise the time of the clock is dropped.
    """
    ticks = clock.select("value", *([clock["timestamp"].alias("_tick")] if restamp else []))
    rows = static.drop(restamp) if restamp else static
    joined = ticks.join(rows, ticks["value"] == rows[index], "left").drop("value", index)
    return joined.withColumnRenamed("_tick", restamp) if restamp else joined


def store_replayed(static: DataFrame, order: list[str], path: str, index: str = "index") -> None:
    """Number a table once and store it in the order of the numbers, for a replay of any length."""
    dense_index(static, order, index).write.mode("overwrite").parquet(path)


def replay_to(
    clock: DataFrame, path: str, out: str, checkpoint: str, index: str = "index", restamp: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Replay a stored table (``store_replayed``) by a stream of ticks, into one folder of ``out`` per micro-batch.

    A batch reads only the part of the table its ticks point at, so the work of a batch follows its
    ticks and not the table.  A batch that runs again after a failure replaces its folder.
    """

    def handle(ticks: DataFrame, batch: int) -> None:
        ends = ticks.agg(F.min("value").alias("low"), F.max("value").alias("high")).first()
        rows = ticks.sparkSession.read.parquet(path).where(F.col(index).between(ends["low"], ends["high"]))
        replay(ticks, rows, index, restamp).write.mode("overwrite").parquet(f"{out}/batch={batch}")

    return stream_batches(clock, handle, checkpoint, trigger)


def stream_files(
    spark: SparkSession, path: str, fmt: str, schema: T.StructType | str, max_files: int | None = None
) -> DataFrame:
    """New files of a folder, each taken exactly once per checkpoint of the query that reads them."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", "\\")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def stream_table(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """A parquet table, or a change log, as a stream of its rows.

    The change log is append-only, so updates and deletes of the table it records
    reach the stream as new rows and never disturb it.
    """
    schema = spark.read.parquet(path).schema
    return stream_files(spark, path, "parquet", schema, max_files)
