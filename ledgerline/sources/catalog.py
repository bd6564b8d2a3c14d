"""Databases, external tables, views and loading them."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerline.sources.writers import align_schema
from ledgerline.streaming.sinks import stream_to_parquet
from ledgerline.streaming.sources import stream_files


def clean_name(text: str) -> str:
    """A name for a database or table: only letters and digits stay."""
    name = re.sub("[^a-zA-Z0-9]", "", text)
    if not name:
        raise ValueError(f"no letters or digits in {text!r}")
    return name


def create_database(spark: SparkSession, name: str, use: bool = False, location: str | None = None) -> str:
    database = clean_name(name)
    at = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    if use:
        spark.sql(f"USE `{database}`")
    return database


def create_table(spark: SparkSession, database: str, table: str, path: str) -> str:
    """Register a parquet folder as a table; returns the qualified name."""
    name = f"`{clean_name(database)}`.`{clean_name(table)}`"
    location = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING PARQUET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return name


def drop_table(spark: SparkSession, database: str, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS `{clean_name(database)}`.`{clean_name(table)}`")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS `{clean_name(name)}` CASCADE")


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Column names and types of a table."""
    return spark.sql(f"DESCRIBE TABLE {table}").select("col_name", "data_type")


def as_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def insert_select(df: DataFrame, path: str, target: DataFrame) -> None:
    """Append a query result to a table's folder in the table's column order and types."""
    align_schema(df, target.schema).write.mode("append").parquet(path)


def replace_table(spark: SparkSession, database: str, table: str, df: DataFrame, path: str) -> str:
    """Replace a table by a query result, written to a new path."""
    df.write.mode("errorifexists").parquet(path)
    drop_table(spark, database, table)
    return create_table(spark, database, table, path)


def copy_into(
    spark: SparkSession, source: str, path: str, checkpoint: str, fmt: str, schema: T.StructType | str
) -> int:
    """Load the files of a folder that were not loaded before; returns the number of new rows.

    A stream that takes what is there and stops: its checkpoint remembers the loaded
    files, and its sink never shows a half-loaded one, whenever the job died.  Old
    files are listed but not read.  New rows are those the stream's own batches took, one batch
    and perhaps one that a died run left behind, whoever else writes to the table.
    """
    query = stream_to_parquet(stream_files(spark, source, fmt, schema), path, checkpoint)
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)
