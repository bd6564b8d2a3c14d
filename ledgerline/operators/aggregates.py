"""Grouped and distribution statistics.

All of them aggregate in the map tasks first, so a hot group costs one partial row
per task.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.scalars import scaled_mean
from ledgerline.operators.skew import DEFAULT_POLICY, HotKeyPolicy, enrich
from ledgerline.operators.windows import partition_stats


def group_summary(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Sum, mean, least and greatest value per group."""
    return df.groupBy(*keys).agg(
        F.sum(value).alias("sum"), F.avg(value).alias("avg"), F.min(value).alias("min"), F.max(value).alias("max")
    )


def scaled_means(df: DataFrame, keys: list[str], measures: dict[str, str]) -> DataFrame:
    """(mean - min) / (max - min) per group for each measure; NULL for a constant measure."""
    return df.groupBy(*keys).agg(*[scaled_mean(F.col(c)).alias(out) for out, c in measures.items()])


def greatest_by(df: DataFrame, keys: list[str], measure: str, item: str) -> DataFrame:
    """The item with the greatest measure per group; ties go to the greatest item, NULL measures lose."""
    best = F.max(F.struct(measure, item)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, f"_best.{item}", f"_best.{measure}")


def share_of_group(
    df: DataFrame, group: str, member: str, policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Rows per (group, member), rows per group and the percentage of the group."""
    counts = df.groupBy(group, member).agg(F.count(F.lit(1)).alias("member_count"))
    totals = partition_stats(counts, [group], {"group_count": F.sum("member_count")}, policy)
    return totals.withColumn("percentage", F.col("member_count") / F.col("group_count") * 100)


def top_and_others(df: DataFrame, group: str, member: str, k: int = 3) -> DataFrame:
    """The k largest members of each group by rows, and all others as one row ``Others``.

    Only k members per group and task reach the window.  The rest is counted as the
    group's rows less those of its top members.
    """
    counts = df.groupBy(group, member).agg(F.count(F.lit(1)).alias("member_count"))
    largest = W.partitionBy(group).orderBy(F.col("member_count").desc(), F.col(member).asc())
    top = counts.withColumn("_place", F.row_number().over(largest)).where(F.col("_place") <= k)
    named = top.select(group, F.col(member).cast("string").alias("member"), "member_count")
    everything = counts.groupBy(group).agg(F.sum("member_count").alias("group_count"))
    # From here on at most k + 1 rows per group.
    rest = (
        everything.select(group, F.lit("Others").alias("member"), F.col("group_count").alias("_signed"))
        .unionByName(named.select(group, F.lit("Others").alias("member"), (-F.col("member_count")).alias("_signed")))
        .groupBy(group, "member")
        .agg(F.sum("_signed").alias("member_count"))
    )
    rows = named.unionByName(rest)
    return rows.withColumn(
        "percentage", F.col("member_count") / F.sum("member_count").over(W.partitionBy(group)) * 100
    ).drop("member_count")


def null_share(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a value, and the proportion without, in one pass."""
    missing = F.count_if(F.col(column).isNull())
    return df.agg(
        missing.alias("null_rows"),
        F.count(column).alias("value_rows"),
        F.try_divide(missing.cast("double"), F.count(F.lit(1))).alias("null_proportion"),
    )


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, in two passes.

    The first one finds the means; the second adds up products of the distances from them, one plain
    sum for each pair, which Spark compiles where that many ``corr`` aggregates are interpreted.
    Rows with a NULL in any of the columns do not count.
    """
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    values = [F.col(f"_{i}") for i in range(len(columns))]
    whole = df.select(*columns).dropna().select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])
    # The mean of equal values is that value, without rounding.
    means = [F.when(F.min(v) == F.max(v), F.min(v)).otherwise(F.avg(v)).alias(f"_mean{i}") for i, v in enumerate(values)]
    far = [v - F.lit(mean).cast("double") for v, mean in zip(values, whole.agg(*means).first())]
    row = whole.agg(F.count(F.lit(1)).alias("_n"), *[F.sum(far[i] * far[j]).alias(f"_{i}_{j}") for i, j in pairs])
    cells = []
    for i, j in pairs:
        value = F.when(F.col("_n") > 1, F.col(f"_{i}_{j}") / F.sqrt(F.col(f"_{i}_{i}") * F.col(f"_{j}_{j}"))).alias("correlation")
        cells += [F.struct(F.lit(x).alias("left_column"), F.lit(y).alias("right_column"), value) for x, y in {(columns[i], columns[j]), (columns[j], columns[i])}]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def exploded_mean(df: DataFrame, keys: list[str], names: str, separator: str, measure: str, out: str) -> DataFrame:
    """Mean of a measure per group and single name of a separated list of names."""
    return (
        df.withColumn("name", F.explode(F.split(names, separator))).groupBy(*keys, "name").agg(F.avg(measure).alias(out))
    )


def keep_frequent(df: DataFrame, keys: list[str], more_than: int) -> DataFrame:
    """Rows whose key occurs more than ``more_than`` times: a semi join with the counted keys."""
    frequent = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > more_than).select(*keys)
    return enrich(df, frequent, keys, "left_semi")


def frequent_means(df: DataFrame, keys: list[str], more_than: int, measure: str, out: str) -> DataFrame:
    """Mean per key over the keys with more than ``more_than`` rows, in one aggregate; NULL keys do not count."""
    named = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    grouped = df.where(named).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.avg(measure).alias(out))
    return grouped.where(F.col("_n") > more_than).drop("_n")


def _spread(column: str) -> list[Column]:
    return [
        F.count(column).cast("double").alias("count"),
        F.avg(column).alias("mean"),
        F.min(column).cast("double").alias("low"),
        F.max(column).cast("double").alias("high"),
        (F.max(column) - F.min(column)).cast("double").alias("range"),
    ]


def _sketch(df: DataFrame, column: str, probabilities: dict[str, float], accuracy: int) -> list[Column]:
    """Approximate values a little below and above each wanted position; a sketch per task, merged."""
    c = F.col(column)
    if df.schema[column].dataType.typeName() in ("double", "float"):
        # NaN sorts last; the sketch only needs a value that does too.
        c = F.when(F.isnan(c), float("inf")).otherwise(c)
    slack = 2.0 / accuracy
    places = [min(1.0, max(0.0, p + side * slack)) for p in probabilities.values() for side in (-1, 1)]
    return [F.percentile_approx(c, places, accuracy).alias("_sketch"), F.count(column).alias("_rows")]


def exact_quantiles(df: DataFrame, column: str, probabilities: dict[str, float], accuracy: int = 10_000) -> DataFrame:
    """One row of exact quantiles, interpolated between neighbouring values.

    A first pass merges the tasks' sketches, which bracket each wanted position to some
    4/accuracy of the rows.  A second one counts the rows outside of the brackets as
    whole ranges and those inside value by value, which gives the exact rows at the positions.
    No task ever holds the whole column, as Spark's ``percentile`` would.
    """
    seen = df.agg(*_sketch(df, column, probabilities, accuracy)).first()
    return _within(df, column, probabilities, seen["_sketch"], seen["_rows"], accuracy)


def _within(df: DataFrame, column: str, probabilities: dict[str, float], sketch: list | None, rows: int, accuracy: int) -> DataFrame:
    wanted = {}
    for name, p in probabilities.items():
        place = p * max(rows - 1, 0)
        low = math.floor(place)
        wanted[name] = (low, min(low + 1, max(rows - 1, 0)) if place > low else low, place - low)
    # Brackets as (from, to); an end beyond the first or last row is open, as is one that a sketch cannot tell from NaN.
    slack, brackets = 2.0 / accuracy, []
    for i, p in enumerate(probabilities.values() if sketch else ()):
        low, high = sketch[2 * i], sketch[2 * i + 1]
        brackets.append((None if p - slack <= 0 else low, None if p + slack >= 1 or (isinstance(high, float) and math.isinf(high)) else high))
    if rows * slack < 8:
        # Too few rows for positions to lie within the sketch's error: every value counts.
        brackets = [(None, None)]
    merged: list[tuple] = []
    for low, high in sorted(brackets, key=lambda b: (b[0] is not None, b[0])):
        if merged and (merged[-1][1] is None or low is None or low <= merged[-1][1]):
            last = merged.pop()
            low, high = last[0], None if last[1] is None or high is None else max(last[1], high)
        merged.append((low, high))

    c, kind = F.col(column), df.schema[column].dataType
    # Even numbers are ranges between brackets, odd ones the brackets.
    slot = F.lit(2 * len(merged))
    for i, (low, high) in reversed(list(enumerate(merged))):
        if high is not None:
            slot = F.when(c <= F.lit(high).cast(kind), 2 * i + 1).otherwise(slot)
        else:
            slot = F.lit(2 * i + 1)
        if low is not None:
            slot = F.when(c < F.lit(low).cast(kind), 2 * i).otherwise(slot)
    counted = (
        df.where(c.isNotNull()).select(c, slot.alias("_slot"))
        .groupBy("_slot", F.when(F.col("_slot") % 2 == 1, c).alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    )
    upto = F.sum("_n").over(W.partitionBy("_slot").orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow))
    if merged == [(None, None)]:
        placed = counted.withColumn("_upto", upto)
    else:
        # At most one row per slot.
        slots = counted.groupBy("_slot").agg(F.sum("_n").alias("_all"))
        earlier = W.partitionBy(F.lit(0)).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
        starts = slots.select("_slot", F.coalesce(F.sum("_all").over(earlier), F.lit(0)).alias("_start"))
        placed = counted.join(F.broadcast(starts), "_slot").withColumn("_upto", F.col("_start") + upto)

    def at(position: int) -> Column:
        holds = (F.col("_upto") - F.col("_n") <= position) & (F.col("_upto") > position)
        return F.max(F.when(holds, F.col("_value").cast("double")))

    return placed.agg(
        *[(at(low) + (at(high) - at(low)) * rest).alias(name) for name, (low, high, rest) in wanted.items()]
    )


QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def distribution(df: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Rows (statistic, value): count, mean, range, quartiles and median, what a box plot shows; two passes."""
    seen = df.agg(*_spread(column), *_sketch(df, column, QUARTILES, accuracy)).first()
    whole = [F.lit(seen[name]).cast("double").alias(name) for name in ("count", "mean", "low", "high", "range")]
    row = _within(df, column, QUARTILES, seen["_sketch"], seen["_rows"], accuracy).select(*whole, *QUARTILES)
    return row.unpivot([], row.columns, "statistic", "value")


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per bin of equal width.  Bin 0 lies below ``low``, bin ``bins + 1`` from ``high`` on."""
    width = (high - low) / bins
    bin_number = F.width_bucket(F.col(column), F.lit(float(low)), F.lit(float(high)), F.lit(bins).cast("long"))
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(bin_number.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bin_from", F.lit(float(low)) + (F.col("bin") - 1) * F.lit(width))
    )
