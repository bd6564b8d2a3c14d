"""Changing tables and keeping their history.

A table's history is an append-only log of changed rows: key and payload columns
plus ``_op`` (insert, update, delete), ``_version`` and ``_commit_ts``.  A version
holds at most one change per key and is written by one job.  The log is stored
partitioned by ``_version``, so reading up to a version skips later folders.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.windows import dense_index, latest_per_key

INSERT, UPDATE, DELETE = "insert", "update", "delete"
LOG_COLUMNS = ["_op", "_version", "_commit_ts"]


class CheckViolation(ValueError):
    """A batch has rows that fail a check."""


class AmbiguousMerge(ValueError):
    """Several source rows match one target row."""


# Plain tables


def update_where(df: DataFrame, condition: Column, assignments: dict[str, Column]) -> DataFrame:
    """Set columns where the condition holds; a NULL condition does not hold.

    All right-hand sides see the row as it was.
    """
    return df.select(
        *[
            F.when(condition, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
            for c in df.columns
        ]
    )


def delete_where(df: DataFrame, condition: Column | None = None) -> DataFrame:
    """Rows for which the condition does not hold; without a condition nothing is left."""
    return df.where(~F.coalesce(condition, F.lit(False)) if condition is not None else F.lit(False))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    when_matched: str = "update",
    when_not_matched: str = "insert",
) -> DataFrame:
    """Update (or ``"delete"``, or ``"keep"``) matching target rows, insert (or ``"skip"``) the other source rows.

    A target row matched by several source rows is an error.  Both tables are read once, by one
    full join (``merged``).
    """
    _reject_ambiguous(target, source, keys)
    if when_matched not in ("update", "delete", "keep"):
        raise ValueError(f"unknown action {when_matched!r}")
    if when_not_matched not in ("insert", "skip"):
        raise ValueError(f"unknown action {when_not_matched!r}")
    rows, op = merged(target, source, keys), F.col("_op")
    if when_matched == "delete":
        rows = rows.where(~op.eqNullSafe(UPDATE))
    if when_not_matched == "skip":
        rows = rows.where(~op.eqNullSafe(INSERT))
    side = F.when(op.isNull() | (op == UPDATE) & F.lit(when_matched == "keep"), F.col("_old")).otherwise(F.col("_new"))
    return _row(rows.withColumn("_row", side), target, keys).select(*target.columns)


def merged(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of both tables, matched by one full join: keys, the ``_old`` and the ``_new`` payload, and ``_op``.

    ``_op`` is ``update`` for a match, ``insert`` for a new source row and NULL for an untouched target row.
    NULL keys never match.
    """
    columns = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(F.lit(True).alias("_there"), *columns).alias("_old"))
    new = source.select(*keys, F.struct(F.lit(True).alias("_there"), *columns).alias("_new"))
    op = F.when(F.col("_old").isNull(), INSERT).when(F.col("_new").isNotNull(), UPDATE)
    return old.join(new, keys, "full").withColumn("_op", op)


def _row(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    return df.select("_op", *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in target.columns])


def _reject_ambiguous(target: DataFrame, source: DataFrame, keys: list[str]) -> None:
    repeated = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).select(*keys)
    if not repeated.isEmpty() and not repeated.join(target.select(*keys), keys, "left_semi").isEmpty():
        raise AmbiguousMerge(f"several source rows have the same {keys} as a target row")


def violations(df: DataFrame, check: Column, null_passes: bool = True) -> DataFrame:
    """Rows that fail a check."""
    return df.where(~check if null_passes else ~F.coalesce(check, F.lit(False)))


def enforce_check(df: DataFrame, name: str, check: Column, null_passes: bool = True) -> DataFrame:
    """The frame itself, or an error when any row fails the check."""
    if not violations(df, check, null_passes).isEmpty():
        raise CheckViolation(f"rows violate {name}")
    return df


def assign_identity(df: DataFrame, order: list[str], out: str, start: int = 10_000, step: int = 1) -> DataFrame:
    """Dense ids in ``order``, which must tell rows apart."""
    return dense_index(df, order, out, start, step)


def next_identity(df: DataFrame, column: str, start: int = 10_000, step: int = 1) -> int:
    """The id to go on with when rows are added to a table."""
    last = df.agg(F.max(column)).first()[0]
    return start if last is None else last + step


def with_generated(df: DataFrame, generated: dict[str, Column]) -> DataFrame:
    """Add columns computed from others, to partition by."""
    return df.withColumns(generated)


def generated_equals(df: DataFrame, generated: dict[str, Column], condition: Column, values: dict[str, Column]) -> DataFrame:
    """Filter on a source column and, so that folders are skipped, on what is generated from it.

    ``values`` gives, per generated column, its value for the wanted rows.
    """
    for name, value in values.items():
        if name not in generated:
            raise KeyError(name)
        condition = (F.col(name) == value) & condition
    return df.where(condition)


# The change log


def stamped(df: DataFrame, op: str | Column, version: int, commit_ts: datetime | str) -> DataFrame:
    """Rows as changes of one version."""
    ts = F.lit(commit_ts).cast("timestamp")
    return df.withColumns(
        {
            "_op": F.lit(op) if isinstance(op, str) else op,
            "_version": F.lit(version).cast("long"),
            "_commit_ts": ts,
        }
    )


def update_changes(df: DataFrame, condition: Column, assignments: dict[str, Column], version: int, ts) -> DataFrame:
    """The change rows of an update of the current table."""
    return stamped(update_where(df.where(condition), F.lit(True), assignments), UPDATE, version, ts)


def delete_changes(df: DataFrame, condition: Column, version: int, ts) -> DataFrame:
    return stamped(df.where(condition), DELETE, version, ts)


def merge_changes(target: DataFrame, source: DataFrame, keys: list[str], version: int, ts) -> DataFrame:
    """The change rows of an upsert: no untouched row of the target is written again."""
    _reject_ambiguous(target, source, keys)
    touched = merged(target, source, keys).where(F.col("_op").isNotNull()).withColumn("_row", F.col("_new"))
    rows = _row(touched, target, keys)
    return stamped(rows, F.col("_op"), version, ts).select(*target.columns, *LOG_COLUMNS)


def commit(changes: DataFrame, path: str, version: int) -> None:
    """Write one version's folder.  Running it again after a failure replaces the same folder."""
    changes.where(F.col("_version") == version).drop("_version").write.mode("overwrite").parquet(
        f"{path}/_version={version}"
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", True).parquet(path).withColumn("_version", F.col("_version").cast("long"))


def history(log: DataFrame) -> DataFrame:
    """One row per version: time and rows by operation."""
    return log.groupBy("_version").agg(
        F.max("_commit_ts").alias("_commit_ts"),
        F.count_if(F.col("_op") == INSERT).alias("inserted"),
        F.count_if(F.col("_op") == UPDATE).alias("updated"),
        F.count_if(F.col("_op") == DELETE).alias("deleted"),
    )


def as_of(log: DataFrame, keys: list[str], version: int | None = None, ts: datetime | str | None = None) -> DataFrame:
    """The table at a version or a time; the newest without either."""
    seen = log
    if version is not None:
        seen = seen.where(F.col("_version") <= version)
    if ts is not None:
        seen = seen.where(F.col("_commit_ts") <= F.lit(ts).cast("timestamp"))
    return latest_per_key(seen, keys, ["_version"]).where(F.col("_op") != DELETE).drop(*LOG_COLUMNS)


def table_diff(log: DataFrame, keys: list[str], old: int, new: int) -> DataFrame:
    """Net changes from version ``old`` to version ``new``, which may also go back in time.

    Deleted rows show their old values, other rows their new ones.  Only keys with a
    change between the versions are looked at, and both states of a key come out of
    one aggregate over its changes.
    """
    payload = [c for c in log.columns if c not in keys + LOG_COLUMNS]
    row = F.struct("_op", *payload)

    def state(version: int) -> Column:
        last = F.max_by(F.when(F.col("_version") <= version, row), F.when(F.col("_version") <= version, F.col("_version")))
        return last

    since, until = min(old, new), max(old, new)
    between = log.where((F.col("_version") > since) & (F.col("_version") <= until))
    touched = between.select(*[F.col(k).alias(f"_t_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    states = (
        log.where(F.col("_version") <= since)
        .join(touched, same, "left_semi")
        .unionByName(between)
        .groupBy(*keys)
        .agg(state(old).alias("_old"), state(new).alias("_new"))
    )

    def live(side: str) -> Column:
        return F.col(side).isNotNull() & (F.col(f"{side}._op") != DELETE)

    def values(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in payload])

    had, has = live("_old"), live("_new")
    kind = (
        F.when(~had & has, INSERT)
        .when(had & ~has, DELETE)
        .when(had & has & ~values("_old").eqNullSafe(values("_new")), UPDATE)
    )
    shown = F.when(kind == DELETE, values("_old")).otherwise(values("_new"))
    return (
        states.select(*keys, kind.alias("change_type"), shown.alias("_row"))
        .where(F.col("change_type").isNotNull())
        .select(*keys, *[f"_row.{c}" for c in payload], "change_type")
    )


def restore_changes(log: DataFrame, keys: list[str], to_version: int, current: int, ts) -> DataFrame:
    """The changes that, committed as version ``current + 1``, bring back the table of ``to_version``."""
    back = table_diff(log, keys, current, to_version).withColumnRenamed("change_type", "_op")
    return stamped(back, F.col("_op"), current + 1, ts).select(*log.columns)


def prune(log: DataFrame, keys: list[str], cutoff: datetime | str) -> DataFrame:
    """The log without history before the cutoff; states from the cutoff on stay readable."""
    at = F.lit(cutoff).cast("timestamp")
    base = latest_per_key(log.where(F.col("_commit_ts") < at), keys, ["_version"]).where(F.col("_op") != DELETE)
    return base.unionByName(log.where(F.col("_commit_ts") >= at))
