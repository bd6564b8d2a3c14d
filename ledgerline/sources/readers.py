"""Batch readers."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.casts import instant
from ledgerline.operators.windows import dense_index


UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given parquet tables, with zone-less timestamps read as instants."""
    path = f"{folder.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    zoneless = [f.name for f in df.schema if f.dataType == T.TimestampNTZType()]
    if not zoneless:
        return df
    if spark.conf.get("spark.sql.session.timeZone") in UTC_NAMES:
        # Same instants without a cast, so that filters on them reach the files.
        fields = [T.StructField(f.name, T.TimestampType()) if f.name in zoneless else f for f in df.schema]
        return spark.read.schema(T.StructType(fields)).parquet(path)
    return df.withColumns({c: instant(c) for c in zoneless})


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType) -> DataFrame:
    """CSV with a header and backslash escapes.  A cell that does not fit its type is NULL."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("delimiter", ",")
        .option("escape", "\\")
        .option("mode", "PERMISSIVE")
        .csv(paths)
    )


def read_csv_union(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Several CSV files stacked.

    With a schema this is one scan.  Without one Spark infers the types, also in
    one scan of all files, so every file ends up with the same types.
    """
    if schema is not None:
        return read_csv(spark, paths, schema)
    return spark.read.option("header", True).option("inferSchema", True).option("escape", "\\").csv(paths)


def read_json_records(
    spark: SparkSession, path: str, schema: T.StructType | None = None, index_order: list[str] | None = None
) -> DataFrame:
    """A JSON array of records; with ``index_order`` also a dense ``index`` column from 0.

    An array file is one task per file: Spark cannot split it.  Large inputs belong
    in JSON lines (``write_json_lines``).
    """
    reader = spark.read.option("multiLine", True)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    return dense_index(df, index_order, "index") if index_order else df


def frame(spark: SparkSession, rows: list, schema: T.StructType | str | None = None) -> DataFrame:
    """A frame from rows at hand, for configuration and tests."""
    return spark.createDataFrame(rows, schema)


def with_row_id(df: DataFrame, out: str = "id") -> DataFrame:
    """A unique id per row, neither dense nor stable across runs; see ``dense_index`` for both."""
    return df.withColumn(out, F.monotonically_increasing_id())


def read_time_partition(df: DataFrame, when: datetime | date) -> DataFrame:
    """The rows of one minute (datetime) or one day (date) of a table partitioned by date parts.

    The filter names the partition columns themselves, so other folders are not read.
    """
    parts = {"year": when.year, "month": when.month, "day": when.day}
    if isinstance(when, datetime):
        parts |= {"hour": when.hour, "minute": when.minute}
    return df.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in parts.items()]))


def rows_of_day(df: DataFrame, column: str, day: date | None = None) -> DataFrame:
    """Rows of one day, today by default, by a date or a time column.

    A time is compared with both ends of the day, which files can be skipped by.
    """
    start = F.lit(day) if day else F.current_date()
    if df.schema[column].dataType == T.DateType():
        return df.where(F.col(column) == start)
    return df.where((F.col(column) >= start.cast("timestamp")) & (F.col(column) < F.date_add(start, 1).cast("timestamp")))
