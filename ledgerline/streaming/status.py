"""Status notifications of charge points, counted per window.  Batch frames work too."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.casts import iso_timestamp
from ledgerline.plans.charging import unpack
from ledgerline.plans.charging_schemas import STATUS
from ledgerline.streaming.sinks import stream_to_parquet

# Window length, and how late a row may come.
WINDOW, LATENESS = "5 minutes", "10 minutes"


def status_rows(log: DataFrame) -> DataFrame:
    """Charge point, status and event time out of the JSON body."""
    return unpack(log, STATUS).select(
        "charge_point_id",
        F.expr("new_body.status").alias("status"),
        iso_timestamp("new_body.timestamp").alias("timestamp"),
    )


def windowed_counts(
    df: DataFrame, keys: list[Column | str], ts: str, counted: str, out: str, window: str = WINDOW, lateness: str = LATENESS
) -> DataFrame:
    """Non-NULL values per key and tumbling window; a row later than the watermark is dropped.

    Counting starts in the map tasks, so a hot key costs one state row per window.
    """
    return (
        df.withWatermark(ts, lateness)
        .groupBy(*keys, F.window(ts, window).alias("window"))
        .agg(F.count(counted).alias(out))
    )


def status_counts(rows: DataFrame) -> DataFrame:
    return windowed_counts(rows, ["charge_point_id", "status"], "timestamp", "status", "status_count")


def write_status_counts(log: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    return stream_to_parquet(status_counts(status_rows(log)), path, checkpoint, trigger=trigger)
