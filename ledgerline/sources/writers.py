"""Batch sinks."""

from __future__ import annotations

from datetime import date
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerline.functions.scalars import calendar_parts, message_label

LOG_PARTITIONS = ["charge_point_id", "year", "month", "day"]


# Tables of layers are written and read within one job, where fewer bytes count for more than the last second.
LAYER_CODEC = "zstd"


def write_parquet(df: DataFrame, path: str, mode: str | None = "overwrite", compression: str | None = None) -> None:
    """Write parquet.  ``mode=None`` is Spark's default: fail when the path holds data; so is the codec without ``compression``."""
    df.write.mode(mode or "errorifexists").parquet(path, compression=compression)


def spread(df: DataFrame, columns: list[str]) -> DataFrame:
    """Bring rows of a partition value together before a partitioned write.

    A rebalance keeps the number of files low as ``repartition(columns)`` does, but
    adaptive execution splits a value with many rows over several tasks.
    """
    return df.hint("rebalance", *[F.col(c) for c in columns])


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "append") -> None:
    spread(df, columns).write.partitionBy(*columns).mode(mode).parquet(path)


def replace_partitions(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write the partitions that ``df`` has rows of, in place of what they held; others stay."""
    spread(df, columns).write.partitionBy(*columns).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_event_log(df: DataFrame, path: str, ts: str = "write_timestamp") -> None:
    """Append log rows partitioned by charge point and day of ``ts``."""
    write_partitioned(df.withColumns(calendar_parts(ts, minute=False)), path, LOG_PARTITIONS)


def labelled(df: DataFrame) -> DataFrame:
    """Add ``action_table``, the name of the table a message belongs to."""
    return df.withColumn("action_table", message_label(F.col("action"), F.col("message_type")))


def write_actions(df: DataFrame, base: str, ts: str = "write_timestamp", parts: list[str] | None = None) -> None:
    """Append each message to the table of its action and direction in one pass.

    Tables are folders ``action_table=...``; an action without rows gets no folder.  Inside
    they are partitioned by charge point and day, or by the given columns.
    """
    routed = labelled(df).withColumns(calendar_parts(ts, minute=False))
    columns = ["action_table", *(LOG_PARTITIONS if parts is None else parts)]
    kept = routed.where(F.col("action_table").isNotNull())
    unused = [c for c in ("year", "month", "day") if c not in columns and c not in df.columns]
    write_partitioned(kept.drop(*unused), base, columns)


def write_route_list(spark: SparkSession, base: str, path: str) -> None:
    """One row per routed table: its name, direction and rows, for reading only some of them."""
    rows = spark.read.parquet(base).groupBy("action_table", "message_type").agg(F.count(F.lit(1)).alias("rows"))
    write_parquet(rows, path)


def read_routes(spark: SparkSession, base: str, wanted: DataFrame) -> DataFrame:
    """Messages of the tables that ``wanted``, rows of a route list, names.

    Folders of other tables are left out when the job runs, as soon as the names are known.
    """
    return spark.read.parquet(base).join(wanted.select("action_table"), "action_table")


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none", file_rows: int = 0) -> None:
    """CSV with a header.  A compressed file is read by one task, so ``file_rows`` should bound its rows (0: no bound)."""
    writer = df.write.mode(mode).option("header", True).option("escape", "\\").option("compression", compression)
    writer.option("maxRecordsPerFile", file_rows).csv(path)


def write_snapshot(df: DataFrame, base: str, day: date) -> str:
    """A dated copy of a table; returns its path."""
    path = f"{base}/{day.isoformat()}"
    write_parquet(df, path)
    return path


def fixed_files(df: DataFrame, files: int) -> DataFrame:
    """Exactly ``files`` output files of even size, for small exports."""
    return df.repartition(files)


def align_schema(df: DataFrame, target: T.StructType, extra: bool = False) -> DataFrame:
    """Columns of ``target`` in its order and types; missing ones are NULL.

    With ``extra`` the columns only ``df`` has follow at the end.
    """
    have = set(df.columns)
    columns = [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields
    ]
    more = [F.col(c) for c in df.columns if c not in target.fieldNames()] if extra else []
    return df.select(*columns, *more)


def union_evolving(*frames: DataFrame) -> DataFrame:
    """Stack frames by name; a column some frame lacks is NULL there."""
    result = frames[0]
    for other in frames[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result


def split_quality(df: DataFrame, good: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows and quarantined rows; a NULL verdict is not good."""
    return df.where(good), df.where(~F.coalesce(good, F.lit(False)))


def write_with_quarantine(df: DataFrame, good: Column, path: str, compression: str | None = None) -> None:
    """Both parts in one pass, as folders ``quality=good`` and ``quality=quarantine``."""
    verdict = F.when(F.coalesce(good, F.lit(False)), "good").otherwise("quarantine")
    df.withColumn("quality", verdict).write.partitionBy("quality").mode("overwrite").parquet(path, compression=compression)


def has_rows(df: DataFrame) -> bool:
    """Whether there is any row; stops at the first one."""
    return not df.isEmpty()


def file_list(spark: SparkSession, path: str) -> DataFrame:
    """``file_path``, ``folder`` and ``file_size`` of a table's files, from their listing; no file is opened."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
        .select("_metadata.file_path", "_metadata.file_size")
    )
    return files.withColumn("folder", F.regexp_extract("file_path", "^(.*)/[^/]*$", 1))


def compact(spark: SparkSession, path: str, target: str, file_bytes: int = 512 << 20) -> int:
    """Rewrite many small files as files of about ``file_bytes`` into a new path.

    Neighbouring files of a folder are put into bins by their listed sizes, and each bin becomes one
    file, so partitions stay as they are and rows keep their order.  Returns the number of
    files.  Readers of the old path are not disturbed; switch the table's location when the job is done.
    """
    in_folder = W.partitionBy("folder").orderBy("file_path").rowsBetween(W.unboundedPreceding, -1)
    place = F.floor(F.coalesce(F.sum("file_size").over(in_folder), F.lit(0)) / file_bytes)
    # One row per file from here on.
    along = W.partitionBy(F.lit(0)).orderBy("folder", "_bin")
    bins = file_list(spark, path).withColumn("_bin", place).select("file_path", "folder", (F.dense_rank().over(along) - 1).alias("_bin"))
    plan = bins.agg(F.max("_bin").alias("last"), F.min("folder").alias("folder")).first()
    df = spark.read.parquet(path)
    if plan["last"] is None:
        write_parquet(df, target, mode=None)
        return 0
    files = plan["last"] + 1
    parts = [c for c in df.columns if f"/{c}=" in unquote(plan["folder"])]
    rows = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    dealt = rows.join(bins.select(F.col("file_path").alias("_file"), "_bin"), "_file").repartitionById(files, F.col("_bin").cast("int"))
    writer = dealt.sortWithinPartitions(*parts, "_bin", "_file", "_row").drop("_bin", "_file", "_row").write
    (writer.partitionBy(*parts) if parts else writer).mode("errorifexists").parquet(target)
    return files
