"""Layered tables fed by streams: event log by minute, charts as files arrive."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.casts import epoch_seconds
from ledgerline.functions.scalars import DIRECTION, calendar_parts
from ledgerline.plans import charging, charts
from ledgerline.sources.readers import read_time_partition
from ledgerline.sources.writers import replace_partitions
from ledgerline.streaming.sinks import stream_to_parquet
from ledgerline.streaming.sources import stream_files, stream_table

MINUTE_PARTITIONS = ["year", "month", "day", "hour", "minute"]


def bronze_rows(log: DataFrame) -> DataFrame:
    """Log rows with epoch seconds and the columns the bronze table is partitioned by."""
    return log.withColumn("write_timestamp_epoch", epoch_seconds("write_timestamp")).withColumns(
        calendar_parts("write_timestamp")
    )


def write_bronze(log: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return stream_to_parquet(bronze_rows(log), path, checkpoint, MINUTE_PARTITIONS, trigger)


# Cleaned tables by the message they hold.
SILVER = {
    ("StartTransaction", 2): charging.start_requests,
    ("StartTransaction", 3): charging.start_responses,
    ("StopTransaction", 2): charging.stop_requests,
    ("MeterValues", 2): charging.meter_samples,
}


def last_minute(bronze: DataFrame, now: datetime) -> DataFrame:
    """Rows of the minute before ``now``; no other partition is read."""
    return read_time_partition(bronze, now - timedelta(minutes=1))


def silver_minute(spark: SparkSession, bronze_path: str, base: str, now: datetime) -> list[str]:
    """Bring the silver tables up to the last full minute of the bronze table; returns the tables written."""
    until = now.replace(second=0, microsecond=0)
    return silver_span(spark, bronze_path, base, until - timedelta(minutes=1), until)


def silver_span(
    spark: SparkSession, bronze_path: str, base: str, since: datetime, until: datetime, grain: str = "minute"
) -> list[str]:
    """Make the silver tables of the time from ``since`` up to ``until`` out of the bronze table.

    Both tables are partitioned by date parts down to ``grain``, and both times begin such a part.
    The partitions written replace their earlier state, so a second run adds nothing, and a job that
    missed some minutes catches up in one run.  A count by kind, which reads two columns and
    only the span's folders, tells which tables have rows; then every body is parsed once.
    Returns the names of the tables written.
    """
    parts = MINUTE_PARTITIONS[: MINUTE_PARTITIONS.index(grain) + 1]
    begins = F.make_timestamp(*[F.col(p) if p in parts else F.lit(0) for p in MINUTE_PARTITIONS], F.lit(0))
    bronze = spark.read.parquet(bronze_path)
    span = bronze.where((begins >= F.lit(since).cast("timestamp")) & (begins < F.lit(until).cast("timestamp"))).drop(*parts)
    found = {(r["action"], r["message_type"]) for r in span.groupBy("action", "message_type").count().collect()}
    written = []
    for kind in [k for k in SILVER if k in found]:
        name = f"{kind[0]}{DIRECTION[kind[1]]}"
        dated = SILVER[kind](span).withColumns({p: c for p, c in calendar_parts("write_timestamp").items() if p in parts})
        replace_partitions(dated, f"{base}/{name}", parts)
        written.append(name)
    return written


def chart_bronze(spark: SparkSession, folder: str, path: str, checkpoint: str) -> StreamingQuery:
    """Every new CSV file of a folder, appended as it is."""
    return stream_to_parquet(stream_files(spark, folder, "csv", charts.RAW_SCHEMA), path, checkpoint)


def chart_silver(spark: SparkSession, bronze: str, path: str, checkpoint: str) -> StreamingQuery:
    """New bronze rows, typed, those without a stream count left out."""
    rows = charts.with_streams(charts.clean(stream_table(spark, bronze)))
    return stream_to_parquet(rows, path, checkpoint)
