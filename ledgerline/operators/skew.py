"""Work on keys that hold a large share of the rows.

A window sends all rows of a key to one task.  The functions here look for keys that
are too large for that, and ``cut_hot_keys`` cuts the rows of each such key into slices
along the sort order, so that a window can run per slice and be completed from
its neighbours or from one summary row per slice.  ``enrich`` joins to facts so that
adaptive execution can split hot keys by itself.

Sizes: a key is hot when it holds more rows than one task sorts with ease, and more than
1/16384 of all rows; a hot key gets one slice per that many rows.  So there are fewer than
32768 slices in all, the bound on everything broadcast or brought to the driver here.
Both plans give the same result, so the choice may follow the size.  Cut points are fixed
values by the time the real work starts, hence every branch of a plan, and every
re-run of a lost task, puts a row in the same slice.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerline.functions.search import count_at_or_below

HASH, SLICE = "_key_hash", "_slice"


MOST_CUTS = 16384
# A frame whose files are smaller than this holds no key worth cutting.
SMALL_BYTES = 64 << 20


@dataclass(frozen=True)
class HotKeyPolicy:
    """When a key counts as hot: above ``task_rows`` rows, and above 1/16384 of all rows.

    A share, if given, replaces both limits; a share of 1 makes no key hot.
    """

    share: float | None = None
    task_rows: int = 5_000_000
    # Sampled rows by which a key at the limit is found, and by which one cut is placed.
    sample_per_slice: int = 200

    def limit(self, rows: int) -> float:
        """The rows above which a key is hot."""
        return self.share * rows if self.share is not None else max(self.task_rows, rows / MOST_CUTS)

    def rules_out(self, df: DataFrame) -> bool:
        """Whether no key can be hot, as far as Spark's estimate of the size tells without a job."""
        if self.share is not None:
            return self.share >= 1
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < SMALL_BYTES


DEFAULT_POLICY = HotKeyPolicy()


# A frame with the same keys that is cheaper to count, or one and the key columns to be made of its sampled rows.
HotFrom = DataFrame | tuple[DataFrame, list[Column]]


def key_hash(keys: list[str] | list[Column]) -> Column:
    """One long for any number of key columns, NULL keys included."""
    return F.xxhash64(*keys) if keys else F.lit(0).cast("long")


def find_hot_keys(
    df: DataFrame, keys: list[str] | list[Column], policy: HotKeyPolicy = DEFAULT_POLICY
) -> tuple[list[int], float]:
    """Hashes of the hot keys, and the number of rows above which a key is hot.

    Rows are sampled, so that a key at the limit is drawn ``sample_per_slice`` times;
    only the sample is shuffled, whatever the size of the input, and keys given as columns
    are only made for sampled rows.  Chance may miss or add
    a key near the limit, which costs speed and never changes a result.
    """
    if policy.rules_out(df):
        return [], 0.0
    rows = df.count()
    limit = policy.limit(rows)
    if rows <= limit:
        return [], limit
    fraction = min(1.0, policy.sample_per_slice / limit)
    drawn = df.sample(fraction=fraction, seed=7).select(key_hash(keys).alias(HASH))
    counted = drawn.groupBy(HASH).agg(F.count(F.lit(1)).alias("n"))
    return [r[0] for r in counted.where(F.col("n") > limit * fraction).collect()], limit


@dataclass(frozen=True)
class Cuts:
    """Cut points of every hot key along one sort order."""

    keys: list[str]
    order: list[str]
    hot: list[int]
    # (key hash, order columns) of each cut, as one sorted array literal: all rows
    # share it, where a joined array would be copied into every row.
    points: Column
    count: int

    def slice_of(self, df: DataFrame) -> DataFrame:
        """Add ``_slice``: 0 for other keys, and a number that grows along the order for hot ones."""
        return df.withColumn(HASH, key_hash(self.keys)).withColumn(
            SLICE, F.when(F.col(HASH).isin(self.hot), self._place()).otherwise(0)
        )

    def hot_rows(self, df: DataFrame) -> DataFrame:
        """Only rows of hot keys, with their slice; other rows are dropped before it is looked up."""
        hashed = df.withColumn(HASH, key_hash(self.keys))
        return hashed.where(F.col(HASH).isin(self.hot)).withColumn(SLICE, self._place())

    def _place(self) -> Column:
        return count_at_or_below(self.points, F.struct(HASH, *self.order), self.count) + 1


def cut_hot_keys(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    policy: HotKeyPolicy = DEFAULT_POLICY,
    hot_from: HotFrom | None = None,
) -> Cuts | None:
    """Cut points for the hot keys of ``df``, or None when no key is hot.

    ``hot_from`` may be a frame with the same keys that is cheaper to count, alone or with its key columns.
    Rows equal in all ``order`` columns stay in one slice, so ``order`` should end
    with a column that tells copies apart.
    """
    source, by = hot_from if isinstance(hot_from, tuple) else (df if hot_from is None else hot_from, keys)
    hot, limit = find_hot_keys(source, by, policy)
    if not hot:
        return None
    fraction = min(1.0, policy.sample_per_slice / limit)
    every = max(1, int(limit * fraction))
    sample = (
        df.withColumn(HASH, key_hash(keys))
        .where(F.col(HASH).isin(hot))
        .select(HASH, *order)
        .sample(fraction=fraction, seed=11)
    )
    # At most sample_per_slice / share sampled rows, and one kept row in `every`.
    # Values travel as text; a cut need not be any row's exact value.
    nth = F.row_number().over(W.partitionBy(HASH).orderBy(*order))
    kept = sample.withColumn("_nth", nth).where(F.col("_nth") % every == 0)
    rows = kept.select(HASH, *[F.hex(F.col(c).cast("string")).alias(c) for c in order]).distinct().collect()
    if not rows:
        return None
    types = [df.schema[c].dataType.simpleString() for c in order]
    return Cuts(keys, order, sorted({r[0] for r in rows}), _literal(rows, types), len(rows))


def _literal(rows: list, types: list[str]) -> Column:
    """A sorted array of (hash, values) as one expression, which Spark folds into a constant."""

    def value(text: str | None, kind: str) -> str:
        return f"CAST(NULL AS {kind})" if text is None else f"CAST(CAST(unhex('{text}') AS STRING) AS {kind})"

    def point(row) -> str:
        return ", ".join([f"{row[0]}L", *[value(text, kind) for text, kind in zip(row[1:], types)]])

    return F.expr(f"sort_array(array({', '.join(f'struct({point(r)})' for r in rows)}))")


def attach_summary(df: DataFrame, summary: DataFrame, keys: list[str], extra: list[str]) -> DataFrame:
    """Left join ``df`` to a summary of the slices; the summary has a proven size bound.

    Keys are compared NULL-safe, since a window treats NULL as a key.
    """
    names = [c for c in summary.columns if c not in keys + extra]
    renamed = summary.select(*[F.col(c).alias(f"_r_{c}") for c in keys + extra], *names)
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys] + [F.col(c) == F.col(f"_r_{c}") for c in extra]
    joined = df.join(F.broadcast(renamed), reduce(lambda a, b: a & b, on), "left")
    return joined.drop(*[f"_r_{c}" for c in keys + extra])


def enrich(df: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join to ``facts``, which is computed per key, so that hot keys and NULL keys spread.

    Adaptive execution splits a hot key of a join only where both sides were shuffled for
    that join, and an aggregate on the key was not.  One more join column, 0 for every row with a
    key, asks for that shuffle of the facts, which are small beside the rows.  Rows
    with a NULL key match nothing, and the same column deals them over all tasks.
    """
    spread = "_spread"
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    dealt = df.withColumn(spread, F.when(missing, F.pmod(F.xxhash64(*df.columns), F.lit(1 << 16)) + 1).otherwise(F.lit(0).cast("long")))
    known = facts.withColumn(spread, F.when(missing, F.lit(-1).cast("long")).otherwise(F.lit(0).cast("long")))
    return dealt.join(known, [*keys, spread], how).drop(spread)
