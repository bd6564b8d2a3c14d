"""Clustering the rows of a table along several columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerline.functions.search import count_at_or_below

# Sampled rows the cut points are taken from, and the bits of one cluster number.
SAMPLE_ROWS = 100_000
NUMBER_BITS = 62


def ordered_value(df: DataFrame, column: str) -> Column:
    """The column, or a number in its order, as a value that a literal can hold exactly; text stays text."""
    kind = df.schema[column].dataType
    c = F.col(column)
    if isinstance(kind, (T.NumericType, T.StringType)):
        return c
    if isinstance(kind, T.DateType):
        return F.unix_date(c)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return c.cast("int")
    raise TypeError(f"cannot cluster by {column}: {kind.simpleString()}")


def _cut_points(sample: DataFrame, column: str, cuts: int) -> list:
    """At most ``cuts`` values that part the sampled ones evenly; the sample has a fixed size."""
    tile = F.ntile(cuts + 1).over(W.partitionBy(F.lit(0)).orderBy(column))
    tiles = sample.where(F.col(column).isNotNull()).select(column, tile.alias("_tile"))
    firsts = tiles.groupBy("_tile").agg(F.min(column).alias("_first")).where("_tile > 1")
    return [r[0] for r in firsts.select("_first").distinct().collect()]


def with_cluster_number(df: DataFrame, columns: list[str], out: str, bits: int = 6) -> DataFrame:
    """Add a number made of the bits of each column's quantile number, in turn.

    Rows near each other in all columns get numbers near each other.  The quantiles
    come from a sample of fixed size; per column at most ``2**bits - 1`` cut points
    come to the driver.  With many columns each has fewer bits, so that all fit one number.
    """
    if not 1 <= len(columns) <= NUMBER_BITS:
        raise ValueError(f"cluster by one to {NUMBER_BITS} columns")
    bits = min(bits, NUMBER_BITS // len(columns))
    cuts = (1 << bits) - 1
    places = [f"_place_{i}" for i in range(len(columns))]
    placed = df.select("*", *[ordered_value(df, c).alias(p) for c, p in zip(columns, places)])
    fraction = min(1.0, SAMPLE_ROWS / max(1, df.count()))
    sample = placed.select(*places).sample(fraction=fraction, seed=5)

    def place(p: str) -> Column:
        kind = T.ArrayType(placed.schema[p].dataType)
        values = _cut_points(sample, p, cuts)
        points = F.sort_array(F.array(*[F.lit(v) for v in values]).cast(kind))
        # A column of few values has few cuts; spread over all bits, so that it counts as much as the others.
        return F.floor(count_at_or_below(points, F.col(p), cuts) * F.lit(1 << bits) / (len(values) + 1)).cast("long")

    numbered = placed.withColumns({p: place(p) for p in places})
    parts = [
        F.shiftleft(F.shiftright(F.col(p), b).bitwiseAND(F.lit(1).cast("long")), b * len(columns) + i)
        for i, p in enumerate(places)
        for b in range(bits)
    ]
    return numbered.withColumn(out, reduce(lambda x, y: x.bitwiseOR(y), parts)).drop(*places)


def _bits(files: int, columns: list[str]) -> int:
    """Enough bits for eight cells to a file, and six to ten bits a column."""
    return min(10, max(6, -(-(files.bit_length() + 3) // max(1, len(columns)))))


def cluster_layout(df: DataFrame, columns: list[str], files: int, bits: int | None = None) -> DataFrame:
    """The same rows, spread over ``files`` tasks so that each holds a small range of every column.

    A row hash follows the cluster number in the range key, so that many rows with
    equal values still spread over several tasks.
    """
    numbered = with_cluster_number(df, columns, "_z", bits or _bits(files, columns)).withColumn("_h", F.xxhash64(*df.columns))
    return numbered.repartitionByRange(files, "_z", "_h").sortWithinPartitions("_z", *columns).drop("_z", "_h")


def write_clustered(df: DataFrame, columns: list[str], path: str, files: int, bits: int | None = None) -> None:
    cluster_layout(df, columns, files, bits).write.mode("errorifexists").parquet(path)


def file_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per file of a file-based frame and column: rows, least and greatest values, which a reader skips files by."""
    ends = [x for i, c in enumerate(columns) for x in (F.min(c).alias(f"_low_{i}"), F.max(c).alias(f"_high_{i}"))]
    return df.select(F.col("_metadata.file_path").alias("file_path"), *columns).groupBy("file_path").agg(F.count(F.lit(1)).alias("rows"), *ends)


def files_touched(ranges: DataFrame, columns: list[str], wanted: list[tuple[str, object, object]]) -> DataFrame:
    """How many files a reader of each value range opens: ``column``, ``low``, ``high`` as text, and ``files``.

    ``ranges`` comes from ``file_ranges`` over the same ``columns``; ``wanted`` lists (column, low, high).
    """

    def meets(column: str, low: object, high: object) -> Column:
        i = columns.index(column)
        inside = (F.lit(low) <= F.col(f"_high_{i}")) & (F.lit(high) >= F.col(f"_low_{i}"))
        texts = [F.lit(column).alias("column"), F.lit(str(low)).alias("low"), F.lit(str(high)).alias("high")]
        return F.struct(*texts, F.coalesce(inside, F.lit(False)).cast("int").alias("files"))

    each = ranges.select(F.inline(F.array(*[meets(*w) for w in wanted])))
    return each.groupBy("column", "low", "high").agg(F.sum("files").alias("files"))
