"""Streaming sinks.  Every query takes what is there and stops, unless given another trigger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def _writer(df: DataFrame, checkpoint: str | None, mode: str, trigger: dict | None):
    writer = df.writeStream.outputMode(mode).trigger(**(trigger or {"availableNow": True}))
    return writer.option("checkpointLocation", checkpoint) if checkpoint else writer


def stream_to_parquet(
    df: DataFrame, path: str, checkpoint: str, partition_by: list[str] | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Append rows to a parquet table; of windowed counts, only closed windows."""
    writer = _writer(df, checkpoint, "append", trigger).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def stream_update(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand every changed result row of a micro-batch to ``handle(rows, batch_id)``.

    A batch may be handed over again after a failure, so ``handle`` should replace
    what it wrote for the same id.
    """
    return _writer(df, checkpoint, "update", trigger).foreachBatch(handle).start()


def stream_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Hand the new rows of every micro-batch to ``handle(rows, batch_id)``, under the same rule as ``stream_update``."""
    return _writer(df, checkpoint, "append", trigger).foreachBatch(handle).start()


def late_groups(query: StreamingQuery) -> int:
    """Groups that the watermark dropped as too late in the batches of a query, counted after the tasks' own aggregation."""
    return sum(int(op["numRowsDroppedByWatermark"]) for p in query.recentProgress for op in p["stateOperators"])


def stream_live(df: DataFrame, name: str, mode: str = "update", trigger: dict | None = None) -> StreamingQuery:
    """An in-memory view of a small result, such as totals by status, for looking at."""
    return _writer(df, None, mode, trigger).format("memory").queryName(name).start()
