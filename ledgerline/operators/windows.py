"""Window analytics that survive hot keys.

Each function has one plan for ordinary data, a plain Spark window, and one for
data with hot keys: the window runs per slice of the sort order and is completed
from one summary row per slice, or sees copies of the rows beside the slice (see
``operators.skew``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.operators.skew import (
    DEFAULT_POLICY,
    HASH,
    SLICE,
    Cuts,
    HotFrom,
    HotKeyPolicy,
    attach_summary,
    cut_hot_keys,
    find_hot_keys,
    key_hash,
)
from ledgerline.session import scratch_path

COPY = "_copy"
#: Cuts not looked for yet; None are the cuts of data without hot keys.
FIND = object()


def partition_stats(
    df: DataFrame, keys: list[str], aggs: dict[str, Column], policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Every row with the aggregates of its whole group."""

    def windowed(part: DataFrame) -> DataFrame:
        w = W.partitionBy(*keys)
        return part.select("*", *[agg.over(w).alias(name) for name, agg in aggs.items()])

    hot, _ = find_hot_keys(df, keys, policy)
    if not hot:
        return windowed(df)
    is_hot = key_hash(keys).isin(hot)
    heavy = df.where(is_hot)
    stats = heavy.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return windowed(df.where(~is_hot)).unionByName(attach_summary(heavy, stats, keys, []))


def rank_rows(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    tie: list[str],
    tiles: int = 2,
    descending: bool = False,
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Add row_number, rank, dense_rank, percent_rank and ntile.

    Rows equal in ``order`` are peers for rank, dense_rank and percent_rank;
    ``tie`` makes the order total for row_number and ntile.
    """
    by_order, by_all = _directed(order, descending), _directed(order + tie, descending)
    functions = {
        "row_number": (F.row_number(), by_all),
        "rank": (F.rank(), by_order),
        "dense_rank": (F.dense_rank(), by_order),
        "percent_rank": (F.percent_rank(), by_order),
        "ntile": (F.ntile(tiles), by_all),
    }

    def ranked(part: DataFrame, by: list[str]) -> DataFrame:
        return part.select(
            "*", *[f.over(W.partitionBy(*by).orderBy(*o)).alias(name) for name, (f, o) in functions.items()]
        )

    cuts = cut_hot_keys(df, keys, order + tie, policy)
    if cuts is None:
        return ranked(df, keys)

    sliced = cuts.slice_of(df)
    hot = cuts.hot_rows(df)
    first, last = (F.max_by, F.min_by) if descending else (F.min_by, F.max_by)
    value = F.struct(*order)
    summary = (
        hot.groupBy(*keys, SLICE, *order)
        .agg(F.count(F.lit(1)).alias("peers"))
        .groupBy(*keys, SLICE)
        .agg(
            F.sum("peers").alias("n"),
            F.count(F.lit(1)).alias("values"),
            first(value, value).alias("first_value"),
            last(value, value).alias("last_value"),
            last(F.col("peers"), value).alias("last_peers"),
        )
    )
    along = W.partitionBy(*keys).orderBy(*_directed([SLICE], descending))
    earlier = along.rowsBetween(W.unboundedPreceding, -1)
    summary = (
        summary.withColumn("rows_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .withColumn("rows_all", F.sum("n").over(W.partitionBy(*keys)))
        # Does the slice go on with the value the slice before ended with?
        .withColumn(
            "goes_on", F.coalesce(F.lag("last_value").over(along) == F.col("first_value"), F.lit(False)).cast("int")
        )
        # Rank of the last value of the slice, wherever its run of peers began.
        .withColumn(
            "run_start",
            F.min(F.col("rows_before") + F.col("n") - F.col("last_peers") + 1).over(
                W.partitionBy(*keys, "last_value")
            ),
        )
        .withColumn("first_rank", F.when(F.col("goes_on") == 1, F.lag("run_start").over(along)))
        .withColumn(
            "values_before",
            F.coalesce(F.sum(F.col("values") - F.col("goes_on")).over(earlier), F.lit(0)) - F.col("goes_on"),
        )
        .select(*keys, SLICE, "rows_before", "rows_all", "first_rank", "values_before")
    )
    local = ranked(sliced, keys + [SLICE])
    joined = attach_summary(local, summary, keys, [SLICE])
    in_hot = F.col(SLICE) > 0
    row = F.col("rows_before") + F.col("row_number")
    rank = F.when((F.col("rank") == 1) & F.col("first_rank").isNotNull(), F.col("first_rank")).otherwise(
        F.col("rows_before") + F.col("rank")
    )
    total = F.col("rows_all")
    return joined.select(
        *df.columns,
        F.when(in_hot, row).otherwise(F.col("row_number")).cast("int").alias("row_number"),
        F.when(in_hot, rank).otherwise(F.col("rank")).cast("int").alias("rank"),
        F.when(in_hot, F.col("values_before") + F.col("dense_rank"))
        .otherwise(F.col("dense_rank"))
        .cast("int")
        .alias("dense_rank"),
        F.when(in_hot, F.coalesce(F.try_divide((rank - 1).cast("double"), total - 1), F.lit(0.0)))
        .otherwise(F.col("percent_rank"))
        .alias("percent_rank"),
        F.when(in_hot, _tile(row, total, tiles)).otherwise(F.col("ntile")).cast("int").alias("ntile"),
    )


def shift_columns(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    shifts: dict[str, tuple[str, int] | tuple[str, int, object]],
    policy: HotKeyPolicy = DEFAULT_POLICY,
    hot_from: HotFrom | None = None,
    cuts: Cuts | None | object = FIND,
) -> DataFrame:
    """Add values of earlier (positive offset) or later (negative offset) rows of the key.

    ``shifts`` maps a new name to (column, offset) or (column, offset, default).
    ``order`` must tell the rows of a key apart.  ``cuts`` may be those of a caller
    who has looked for hot keys already.
    """

    def shifted(by: list[str]) -> list[Column]:
        w = W.partitionBy(*by).orderBy(*order)
        return [F.lag(s[0], s[1], *s[2:]).over(w).alias(name) for name, s in shifts.items()]

    if cuts is FIND:
        cuts = cut_hot_keys(df, keys, order, policy, hot_from)
    if cuts is None:
        return df.select("*", *shifted(keys))

    reach = [s[1] for s in shifts.values()]
    needed = sorted({s[0] for s in shifts.values()} | set(order) | set(keys))
    rows = with_neighbours(df, cuts, keys, order, needed, max(0, *reach), max(0, *[-r for r in reach]))
    return rows.select("*", *shifted([*keys, SLICE])).where(~F.col(COPY)).select(*df.columns, *shifts)


def with_neighbours(
    df: DataFrame, cuts: Cuts, keys: list[str], order: list[str], needed: list[str], back: int, ahead: int
) -> DataFrame:
    """Rows with their slice, and for each slice copies of the ``back`` rows before and the ``ahead`` rows after it.

    Copies are marked ``_copy`` and have only the ``needed`` columns.  A window that looks no
    farther is then right in every slice for all rows but the copies.  Each map task hands
    over at most ``back`` or ``ahead`` rows per slice for them.
    """
    narrow = cuts.hot_rows(df.select(*needed))
    sizes: dict[int, list[tuple[int, int]]] = {}
    # One row per slice of a hot key.
    for r in narrow.groupBy(HASH, SLICE).agg(F.count(F.lit(1)).alias("n")).collect():
        sizes.setdefault(r[HASH], []).append((r[SLICE], r["n"]))
    parts = [cuts.slice_of(df).withColumn(COPY, F.lit(False))]
    for reach, descending in ((back, True), (ahead, False)):
        links = [
            (key, *link) for key, slices in sizes.items() for link in _links(sorted(slices, reverse=not descending), reach)
        ]
        if not links:
            continue
        to = df.sparkSession.createDataFrame(links, f"{HASH} long, {SLICE} int, _to int, _gap long")
        nth = F.row_number().over(W.partitionBy(*keys, SLICE).orderBy(*_directed(order, descending)))
        edge = narrow.withColumn("_nth", nth).where(F.col("_nth") <= reach)
        copies = edge.join(F.broadcast(to), [HASH, SLICE]).where(F.col("_nth") + F.col("_gap") <= reach)
        parts.append(copies.select(*needed, F.col("_to").alias(SLICE), F.lit(True).alias(COPY)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _links(slices: list[tuple[int, int]], reach: int) -> list[tuple[int, int, int]]:
    """(slice, slice that needs copies of it, rows between the two); nearly always only the next slice does."""
    out = []
    for i, (number, _) in enumerate(slices):
        gap = 0
        for other, n in slices[i + 1 :]:
            if gap >= reach:
                break
            out.append((number, other, gap))
            gap += n
    return out


def rolling_mean(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    before: int,
    after: int,
    out: str,
    policy: HotKeyPolicy = DEFAULT_POLICY,
) -> DataFrame:
    """Mean over the rows from ``before`` earlier to ``after`` later ones; NULL values do not count."""

    def mean(by: list[str]) -> Column:
        return F.avg(value).over(W.partitionBy(*by).orderBy(*order).rowsBetween(-before, after)).alias(out)

    cuts = cut_hot_keys(df, keys, order, policy)
    if cuts is None:
        return df.withColumn(out, mean(keys))
    needed = sorted({value, *keys, *order})
    rows = with_neighbours(df, cuts, keys, order, needed, before, after)
    return rows.select("*", mean([*keys, SLICE])).where(~F.col(COPY)).select(*df.columns, out)


def running_total(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    tie: list[str],
    value: str,
    out: str,
    policy: HotKeyPolicy = DEFAULT_POLICY,
    cuts: Cuts | None | object = FIND,
) -> DataFrame:
    """Sum up to and including the peers of the row: rows equal in ``order`` share the total.

    ``tie`` is only used to cut large runs of peers.
    """

    def so_far(by: list[str]) -> Column:
        w = W.partitionBy(*by).orderBy(*order).rangeBetween(W.unboundedPreceding, W.currentRow)
        return F.sum(value).over(w)

    plain = df.withColumn(out, so_far(keys))
    if cuts is FIND:
        cuts = cut_hot_keys(df, keys, order + tie, policy)
    if cuts is None:
        return plain

    sliced = cuts.slice_of(df)
    place = F.struct(*order)
    per_slice = (
        cuts.hot_rows(df)
        .groupBy(*keys, SLICE, *order)
        .agg(F.sum(value).alias("s"))
        .groupBy(*keys, SLICE)
        .agg(
            F.sum("s").alias("slice_sum"),
            F.min(place).alias("first_value"),
            F.max(place).alias("last_value"),
            F.min_by(F.struct("s"), place).alias("first_sum"),
        )
    )
    earlier = W.partitionBy(*keys).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    # Later slices that begin with a value add their part of its peers.
    later = W.partitionBy(*keys, "_value").orderBy(F.col(SLICE).desc(), "_role").rowsBetween(W.unboundedPreceding, -1)
    ends = per_slice.select(*keys, SLICE, F.lit(1).alias("_role"), F.col("last_value").alias("_value"), _null("_part"))
    starts = per_slice.select(
        *keys, SLICE, F.lit(2).alias("_role"), F.col("first_value").alias("_value"), F.col("first_sum.s").alias("_part")
    )
    tails = (
        ends.unionByName(starts)
        .withColumn("tail", F.sum("_part").over(later))
        .where(F.col("_role") == 1)
        .select(*keys, SLICE, "tail")
    )
    before = per_slice.select(*keys, SLICE, "last_value", F.sum("slice_sum").over(earlier).alias("before"))
    summary = attach_summary(before, tails, keys, [SLICE])
    local = sliced.withColumn("_here", so_far(keys + [SLICE]))
    joined = attach_summary(local, summary, keys, [SLICE])
    tail = F.when(place == F.col("last_value"), F.col("tail"))
    total = _null_sum(F.col("before"), F.col("_here"), tail).cast(plain.schema[out].dataType)
    return joined.select(*df.columns, total.alias(out))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The last row of each key in ``order``.

    Spark keeps one row per key in every map task before the shuffle, so a hot key
    costs one row per task.
    """
    newest = W.partitionBy(*keys).orderBy(*[_desc(c) for c in order])
    return df.withColumn("_newest", F.row_number().over(newest)).where(F.col("_newest") == 1).drop("_newest")


def dense_index(
    df: DataFrame, order: list[str], out: str, start: int = 0, step: int = 1, policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """Number the whole table in ``order``, which must tell rows apart: start, start + step, ...

    A small table is numbered by one task.  A larger one is sorted by ranges and stored with
    each row's place in its range; the ranges are counted, and one row per range,
    with the rows before it, completes the numbers.
    """
    rows = 0 if policy.rules_out(df) else df.count()
    limit = policy.limit(rows)
    if rows <= limit:
        number = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(*order))
        return df.withColumn(out, (F.lit(start) + (number - 1) * step).cast("long"))
    ranges = -(-rows // max(1, int(limit)))
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("_range"), place.alias("_place"))
    path = scratch_path(df.sparkSession, "numbered")
    placed.write.parquet(path)
    stored = df.sparkSession.read.schema(placed.schema).parquet(path)
    earlier = W.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        stored.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    joined = stored.join(F.broadcast(offsets), "_range")
    return joined.select(*df.columns, (F.lit(start) + (F.col("_before") + F.col("_place")) * step).cast("long").alias(out))


def idle_time(
    df: DataFrame,
    key: str,
    ts: str,
    busy: Column,
    out: str,
    policy: HotKeyPolicy = DEFAULT_POLICY,
    hot_from: HotFrom | None = None,
) -> DataFrame:
    """Hours each key spent idle, two decimals.

    An island is a run of readings in the same state, and lasts from its first to
    its last reading; gaps between islands do not count.  The idle islands of a key
    therefore add up to the gaps between neighbouring readings that are both idle,
    which needs one look at the previous row.  A reading with unknown state is idle, and
    a key that is never idle has no row.  A reading sent again adds nothing; of readings of
    one time that disagree, the idle ones count as the later.
    """
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    readings = df.select(key, ts, F.coalesce(~busy, F.lit(True)).alias("_idle"), seconds.alias("_s"))
    paired = shift_columns(
        readings, [key], [ts, "_idle"], {"_was_idle": ("_idle", 1, False), "_prev_s": ("_s", 1)}, policy, hot_from
    )
    gap = F.when(F.col("_was_idle"), F.col("_s") - F.col("_prev_s")).otherwise(F.lit(0))
    return (
        paired.where("_idle").groupBy(key).agg(F.round(F.sum(gap) / F.lit(3600.0), 2).alias(out))
    )


def state_islands(
    df: DataFrame, key: str, ts: str, state: Column, policy: HotKeyPolicy = DEFAULT_POLICY
) -> DataFrame:
    """One row per run of equal state: key, island number, state, first and last time, readings.

    The island number is the running count of state changes, where the row before
    the first counts as state false, and so does a row without a state.
    """
    flagged = df.select(key, ts, F.coalesce(state, F.lit(False)).cast("int").alias("state"))
    cuts = cut_hot_keys(flagged, [key], [ts], policy)
    changed = shift_columns(flagged, [key], [ts], {"_before": ("state", 1, 0)}, cuts=cuts).withColumn(
        "_change", F.abs(F.col("state") - F.col("_before"))
    )
    numbered = running_total(changed, [key], [ts], [], "_change", "island", cuts=cuts)
    return numbered.groupBy(key, "island", "state").agg(
        F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts"), F.count(F.lit(1)).alias("readings")
    )


def _directed(names: list[str], descending: bool) -> list[Column]:
    return [F.col(n).desc() if descending else F.col(n).asc() for n in names]


def _desc(c: Column | str) -> Column:
    return F.col(c).desc() if isinstance(c, str) else c


def _null(name: str) -> Column:
    return F.lit(None).alias(name)


def _null_sum(*parts: Column) -> Column:
    """Sum of the parts that are not NULL; NULL when all are."""
    some = reduce(lambda a, b: a | b, [p.isNotNull() for p in parts])
    return F.when(some, reduce(lambda a, b: a + b, [F.coalesce(p, F.lit(0)) for p in parts]))


def _tile(row: Column, total: Column, tiles: int) -> Column:
    """Tile of a row: the first ``total mod tiles`` tiles hold one row more."""
    small, extra = F.floor(total / tiles), total % tiles
    in_large = row <= extra * (small + 1)
    large_tile = F.floor((row - 1) / (small + 1)) + 1
    small_tile = extra + F.floor(F.try_divide(row - 1 - extra * (small + 1), small)) + 1
    return F.when(in_large, large_tile).otherwise(small_tile)
