"""Small helpers that the operators of this folder share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later steps neither
    repeat its work nor depend on an executor that may be lost."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that an output column would clash with, in any case of letters."""
    taken = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def aside(df: DataFrame, inner: tuple[str, ...]) -> dict[str, str]:
    """Other names for the input columns that clash with names an operator uses inside, in any case of letters."""
    used = {n.lower() for n in inner}
    return {c: f"_aside_{i}" for i, c in enumerate(df.columns) if c.lower() in used}


def plain_text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Bytes of all texts, from which widths of exchanges are derived."""
    total = df.select(F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("n")).first()
    return int(total["n"] or 0)


def width(amount: float, per_task: float, least: int = 1) -> int:
    """Number of partitions so that each gets about ``per_task`` of ``amount``."""
    return max(least, int(-(-amount // per_task)))


def small_or_plain(df: DataFrame, label: str, rows: int = 1_000_000) -> DataFrame:
    """A frame of a few short columns for one side of a join: stored, counted, and marked for
    broadcast only up to ``rows`` rows (some 50 MB). Beyond that the join shuffles."""
    kept = stored(df, label)
    return F.broadcast(kept) if kept.count() <= rows else kept
