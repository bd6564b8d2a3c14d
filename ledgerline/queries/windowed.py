"""Window queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casts import wall_clock
from ledgerline.operators import windows as win
from ledgerline.operators.aggregates import group_summary
from ledgerline.sources.readers import read_table


def _in_cents(orders: DataFrame) -> DataFrame:
    """Prices as whole cents, so that sums are exact and means are the same double in every engine."""
    return orders.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("long"))


def latest_per_user(spark: SparkSession, sf: str) -> DataFrame:
    latest = win.latest_per_key(read_table(spark, sf, "events"), ["user_id"], ["ts", "event_id"])
    return latest.withColumn("ts", wall_clock("ts"))


def win_partition_agg(spark: SparkSession, sf: str) -> DataFrame:
    orders = _in_cents(read_table(spark, sf, "orders")).select("o_orderkey", "o_custkey", "cents")
    aggs = {f: getattr(F, f)("cents") for f in ("sum", "avg", "min", "max")}
    return win.partition_stats(orders, ["o_custkey"], aggs)


def win_as_groupby(spark: SparkSession, sf: str) -> DataFrame:
    return group_summary(_in_cents(read_table(spark, sf, "orders")), ["o_custkey"], "cents")


def win_rank(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    ranked = win.rank_rows(orders, ["o_custkey"], ["o_orderpriority"], ["o_orderkey"], tiles=2)
    return ranked.withColumn("percent_rank", F.round("percent_rank", 6))


def win_lag_lead(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    shifts = {"lag_1": ("value", 1), "lag_2": ("value", 2), "lead_1": ("value", -1), "back_lead_1": ("value", 1)}
    shifted = win.shift_columns(events, ["user_id"], ["ts", "event_id"], shifts)
    return shifted.withColumn("change", F.round(F.col("value") - F.col("lag_1"), 2)).drop("ts")


def win_lag_other(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return win.shift_columns(events, ["user_id"], ["ts", "event_id"], {"type_before": ("event_type", 1)}).drop("ts")


def win_rolling_avg(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts", "value")
    rolled = win.rolling_mean(events, ["user_id"], ["ts", "event_id"], "value", 1, 1, "mean")
    return rolled.withColumn("mean", F.round("mean", 6)).drop("ts")


def win_running_total(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    total = win.running_total(orders, ["o_custkey"], ["o_orderpriority"], ["o_orderkey"], "o_totalprice", "total")
    return total.withColumn("total", F.round("total", 2))


def idle_time(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("user_id", "ts", "value")
    return win.idle_time(events, "user_id", "ts", F.col("value") > 50, "idle_hours")


def idle_islands(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events").select("user_id", "ts", "value")
    islands = win.state_islands(events, "user_id", "ts", F.col("value") > 50)
    return islands.withColumns({c: wall_clock(c) for c in ("first_ts", "last_ts")})


def idle_islands_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """Some readings are missing; they count as idle."""
    value = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    events = read_table(spark, sf, "events").select("user_id", "ts", value.alias("value"))
    islands = win.state_islands(events, "user_id", "ts", F.col("value") > 50)
    return islands.withColumns({c: wall_clock(c) for c in ("first_ts", "last_ts")})


QUERIES = {
    f.__name__: f
    for f in (
        latest_per_user,
        win_partition_agg,
        win_as_groupby,
        win_rank,
        win_lag_lead,
        win_lag_other,
        win_rolling_avg,
        win_running_total,
        idle_time,
        idle_islands,
        idle_islands_nulls,
    )
}

_CENTS = "SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders"
BY_USER = "WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"
_ISLANDS = f"""
    SELECT user_id, ts, state, sum(change) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM (
        SELECT user_id, ts, state, abs(state - lag(state, 1, 0) OVER (PARTITION BY user_id ORDER BY ts)) AS change
        FROM (SELECT user_id, ts, CASE WHEN value > 50 THEN 1 ELSE 0 END AS state FROM events))
"""

ORACLES = {
    "latest_per_user": """SELECT * FROM events
                          QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "win_partition_agg": f"""
        SELECT o_orderkey, o_custkey, cents, CAST(sum(cents) OVER w AS BIGINT) AS sum, avg(cents) OVER w AS avg,
               min(cents) OVER w AS min, max(cents) OVER w AS max
        FROM ({_CENTS}) WINDOW w AS (PARTITION BY o_custkey)""",
    "win_as_groupby": f"""
        SELECT o_custkey, sum, avg, min, max FROM (
            SELECT o_custkey, CAST(sum(cents) OVER w AS BIGINT) AS sum, avg(cents) OVER w AS avg,
                   min(cents) OVER w AS min, max(cents) OVER w AS max,
                   row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
            FROM ({_CENTS}) WINDOW w AS (PARTITION BY o_custkey)) WHERE rn = 1""",
    "win_rank": """
        SELECT o_orderkey, o_custkey, o_orderpriority,
               CAST(row_number() OVER t AS INTEGER) AS row_number, CAST(rank() OVER w AS INTEGER) AS rank,
               CAST(dense_rank() OVER w AS INTEGER) AS dense_rank, round(percent_rank() OVER w, 6) AS percent_rank,
               CAST(ntile(2) OVER t AS INTEGER) AS ntile
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderpriority),
                           t AS (PARTITION BY o_custkey ORDER BY o_orderpriority, o_orderkey)""",
    "win_lag_lead": f"""
        SELECT event_id, user_id, value, lag(value) OVER w AS lag_1, lag(value, 2) OVER w AS lag_2,
               lead(value) OVER w AS lead_1, lead(value, -1) OVER w AS back_lead_1,
               round(value - lag(value) OVER w, 2) AS change FROM events {BY_USER}""",
    "win_lag_other": f"""SELECT event_id, user_id, event_type, lag(event_type) OVER w AS type_before
                         FROM events {BY_USER}""",
    "win_rolling_avg": """
        SELECT event_id, user_id, value, round(avg(value) OVER (
            PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS mean
        FROM events""",
    "win_running_total": """
        SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice, round(sum(o_totalprice) OVER (
            PARTITION BY o_custkey ORDER BY o_orderpriority RANGE UNBOUNDED PRECEDING), 2) AS total FROM orders""",
    "idle_time": f"""
        SELECT user_id, round(sum(seconds) / 3600.0, 2) AS idle_hours FROM (
            SELECT user_id, island, floor(epoch(max(ts))) - floor(epoch(min(ts))) AS seconds
            FROM ({_ISLANDS}) WHERE state = 0 GROUP BY user_id, island) GROUP BY user_id""",
    "idle_islands": f"""
        SELECT user_id, CAST(island AS BIGINT) AS island, CAST(state AS INTEGER) AS state, min(ts) AS first_ts,
               max(ts) AS last_ts, count(*) AS readings FROM ({_ISLANDS}) GROUP BY user_id, island, state""",
    "idle_islands_nulls": """
        WITH seen AS (SELECT user_id, ts, CASE WHEN event_id % 7 <> 0 THEN value END > 50 AS state FROM events),
        steps AS (
            SELECT user_id, ts, CAST(coalesce(state, false) AS INTEGER) AS state,
                   lag(CAST(coalesce(state, false) AS INTEGER), 1, 0) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM seen),
        numbered AS (SELECT *, sum(abs(state - before)) OVER (PARTITION BY user_id ORDER BY ts) AS island FROM steps)
        SELECT user_id, CAST(island AS BIGINT) AS island, CAST(state AS INTEGER) AS state, min(ts) AS first_ts,
               max(ts) AS last_ts, count(*) AS readings FROM numbered GROUP BY user_id, island, state""",
}
