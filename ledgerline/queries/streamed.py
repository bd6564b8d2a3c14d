"""Streaming operators: run as streams over the given tables, and their batch twins."""

from __future__ import annotations

from datetime import datetime, time, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casts import ISO_MICROS, iso_timestamp, wall_clock
from ledgerline.operators.windows import dense_index
from ledgerline.plans.users import make_users, mean_age_group
from ledgerline.queries.frames import chart_text
from ledgerline.session import scratch_path
from ledgerline.sources.readers import read_table
from ledgerline.sources.writers import write_csv, write_parquet
from ledgerline.streaming import layers, status
from ledgerline.streaming.sinks import stream_to_parquet, stream_update
from ledgerline.streaming.sources import replay, replay_to, store_replayed, stream_table


def _flat(counts: DataFrame) -> DataFrame:
    bounds = {f"window_{side}": wall_clock(F.col(f"window.{side}")) for side in ("start", "end")}
    return counts.withColumns(bounds).drop("window")


def _event_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as status notifications, with the status and time in a JSON body."""
    body = F.struct(
        F.col("user_id").cast("int").alias("connector_id"),
        F.col("event_type").alias("status"),
        F.date_format("ts", ISO_MICROS).alias("timestamp"),
    )
    return read_table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("message_id"),
        F.lit(2).alias("message_type"),
        F.concat(F.lit("cp-"), F.col("user_id")).alias("charge_point_id"),
        F.lit("StatusNotification").alias("action"),
        F.date_format("ts", ISO_MICROS).alias("write_timestamp"),
        F.to_json(body).alias("body"),
    )


def replay_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are the ticks, events the table that is replayed."""
    ticks = read_table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("value"), F.col("o_orderdate").alias("timestamp")
    )
    events = read_table(spark, sf, "events").select("event_id", "user_id", "ts")
    table = dense_index(events, ["ts", "event_id"], "index")
    return replay(ticks, table, restamp="ts").withColumn("ts", wall_clock("ts"))


def tumbling_counts(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    return _flat(status.windowed_counts(events, ["event_type"], "ts", "event_type", "n"))


def status_select(spark: SparkSession, sf: str) -> DataFrame:
    rows = status.status_rows(_event_log(spark, sf))
    return rows.withColumn("timestamp", wall_clock("timestamp"))


def props_select(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    parsed = events.withColumn("p", F.from_json("props", "k int"))
    return parsed.select("event_id", F.expr("p.k").alias("k"), "event_type")


def status_counts_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The log written as files, streamed with a watermark, closed windows appended to parquet."""
    base = scratch_path(spark, "status")
    write_parquet(_event_log(spark, sf), f"{base}/log")
    query = status.write_status_counts(stream_table(spark, f"{base}/log"), f"{base}/out", f"{base}/checkpoint")
    query.awaitTermination()
    return _flat(spark.read.parquet(f"{base}/out"))


def _arrivals(spark: SparkSession, sf: str) -> DataFrame:
    """Events with the ``arrival`` they come in: four quarters of their time, and every seventh one two arrivals late."""
    events = read_table(spark, sf, "events")
    at = F.unix_micros("ts")
    ends = events.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    quarter = F.floor((at - ends["low"]) * 4 / (ends["high"] - ends["low"] + 1)).cast("int")
    return events.withColumn("arrival", quarter + F.when(F.col("event_id") % 7 == 0, 2).otherwise(0))


ARRIVALS = 6


def late_rows_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Six arrivals, each taken by a run that goes on from the checkpoint: kept state, and rows too late for it."""
    base = scratch_path(spark, "late")
    log, arrival = _event_log(spark, sf), _arrivals(spark, sf).select(F.col("event_id").cast("string").alias("message_id"), "arrival")
    write_parquet(log.join(arrival, "message_id"), f"{base}/staged")
    staged = spark.read.parquet(f"{base}/staged")
    for n in range(ARRIVALS):
        write_parquet(staged.where(F.col("arrival") == n).drop("arrival"), f"{base}/log", "append")
        status.write_status_counts(stream_table(spark, f"{base}/log"), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return _flat(spark.read.parquet(f"{base}/out"))


def replay_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Orders arrive as ticks in three batches; events are numbered and stored once, then replayed."""
    base = scratch_path(spark, "replay")
    store_replayed(read_table(spark, sf, "events").select("event_id", "user_id", "ts"), ["ts", "event_id"], f"{base}/events")
    ticks = read_table(spark, sf, "orders").select(F.col("o_orderkey").alias("value"), F.col("o_orderdate").alias("timestamp"))
    for n in range(3):
        write_parquet(ticks.where(F.col("value") % 3 == n), f"{base}/ticks", "append")
        replay_to(stream_table(spark, f"{base}/ticks"), f"{base}/events", f"{base}/out", f"{base}/checkpoint", restamp="ts").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "user_id", wall_clock("ts").alias("ts"))


def silver_job(spark: SparkSession, sf: str) -> DataFrame:
    """Events as messages of four kinds, streamed to bronze; the silver job over all days, run twice."""
    base = scratch_path(spark, "silver")
    events = read_table(spark, sf, "events")
    at, key = F.date_format("ts", ISO_MICROS), F.col("event_id").cast("int")
    bodies = {
        "view": ("MeterValues", 2, F.struct(
            key.alias("transaction_id"), F.array(F.struct(at.alias("timestamp"), F.array(F.struct(F.col("value").cast("string").alias("value"))).alias("sampled_value"))).alias("meter_value"))),
        "click": ("StartTransaction", 2, F.struct(F.col("user_id").cast("string").alias("id_tag"), key.alias("meter_start"), at.alias("timestamp"))),
        "purchase": ("StartTransaction", 3, F.struct(key.alias("transaction_id"))),
        None: ("StopTransaction", 2, F.struct(key.alias("meter_stop"), key.alias("transaction_id"), at.alias("timestamp"))),
    }
    named = reduce(lambda a, k: a | (F.col("event_type") == k), [k for k in bodies if k], F.lit(False))
    parts = [
        events.where(F.col("event_type") == kind if kind else ~named).select(
            F.col("event_id").cast("string").alias("message_id"), F.lit(code).alias("message_type"), F.concat(F.lit("cp-"), F.col("user_id")).alias("charge_point_id"),
            F.lit(action).alias("action"), F.col("ts").alias("write_timestamp"), F.to_json(body).alias("body"),
        )
        for kind, (action, code, body) in bodies.items()
    ]
    write_parquet(reduce(DataFrame.unionByName, parts), f"{base}/log")
    days = layers.MINUTE_PARTITIONS[:3]
    rows = layers.bronze_rows(stream_table(spark, f"{base}/log")).drop("hour", "minute")
    stream_to_parquet(rows, f"{base}/bronze", f"{base}/checkpoint", days).awaitTermination()
    ends = events.agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last")).first()
    since, until = (datetime.combine(d, time()) for d in (ends["first"], ends["last"] + timedelta(days=1)))
    for _ in range(2):
        tables = layers.silver_span(spark, f"{base}/bronze", f"{base}/silver", since, until, "day")
    shown = [spark.read.parquet(f"{base}/silver/{t}").select(F.lit(t).alias("table"), "message_id", "charge_point_id", *days) for t in tables]
    return reduce(DataFrame.unionByName, shown)


def status_counts_update_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same in update mode: the newest count of every window, open ones too."""
    base = scratch_path(spark, "status-update")
    write_parquet(_event_log(spark, sf), f"{base}/log")
    counts = status.status_counts(status.status_rows(stream_table(spark, f"{base}/log")))

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/out/batch={batch}")

    stream_update(counts, keep, f"{base}/checkpoint").awaitTermination()
    changed = spark.read.parquet(f"{base}/out")
    newest = changed.groupBy("charge_point_id", "status", "window").agg(
        F.max_by("status_count", "batch").alias("status_count")
    )
    return _flat(newest)


def bronze_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The log streamed to a table with epoch and date-part columns."""
    base = scratch_path(spark, "bronze")
    write_parquet(_event_log(spark, sf), f"{base}/log")
    rows = layers.bronze_rows(stream_table(spark, f"{base}/log").withColumn("write_timestamp", iso_timestamp("write_timestamp")))
    stream_to_parquet(rows, f"{base}/out", f"{base}/checkpoint", ["year", "month", "day"]).awaitTermination()
    return spark.read.parquet(f"{base}/out").select(
        "message_id", "charge_point_id", "write_timestamp_epoch", *layers.MINUTE_PARTITIONS
    )


def chart_silver_stream(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files to a bronze table to a cleaned table, both by streams."""
    base = scratch_path(spark, "charts")
    raw = chart_text(spark, sf)
    full = [F.col(c) if c in raw.columns else F.lit(None).cast("string").alias(c) for c in layers.charts.RAW_COLUMNS]
    write_csv(raw.select(*full), f"{base}/landing")
    layers.chart_bronze(spark, f"{base}/landing", f"{base}/bronze", f"{base}/checkpoint-1").awaitTermination()
    layers.chart_silver(spark, f"{base}/bronze", f"{base}/silver", f"{base}/checkpoint-2").awaitTermination()
    silver = spark.read.parquet(f"{base}/silver")
    return silver.select("id", "rank", "date", "artist", "streams", "explicit", "release_date", "af_energy")


def age_group_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Users streamed from a table, mean age group by gender kept complete."""
    base = scratch_path(spark, "ages")
    users = make_users(read_table(spark, sf, "customer").select("c_custkey"), "c_custkey", "2024-01-01 00:00:00")
    write_parquet(users, f"{base}/users")

    def keep(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/out")

    means = mean_age_group(stream_table(spark, f"{base}/users"))
    query = (
        means.writeStream.outputMode("complete")
        .option("checkpointLocation", f"{base}/checkpoint")
        .trigger(availableNow=True)
        .foreachBatch(keep)
        .start()
    )
    query.awaitTermination()
    return spark.read.parquet(f"{base}/out")


QUERIES = {
    f.__name__: f
    for f in (
        replay_join,
        tumbling_counts,
        status_select,
        props_select,
        status_counts_stream,
        late_rows_stream,
        replay_stream,
        silver_job,
        status_counts_update_stream,
        bronze_stream,
        chart_silver_stream,
        age_group_stream,
    )
}

_WINDOWS = """
    SELECT 'cp-' || user_id AS charge_point_id, event_type AS status, count(*) AS status_count,
           time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
           time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end
    FROM events GROUP BY ALL
"""

_REPLAY = """
    SELECT event_id, user_id, o_orderdate AS ts FROM orders LEFT JOIN (
        SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS index FROM events)
    ON o_orderkey = index"""

# A row is too late when its window had ended by the watermark that the arrivals before it left.
_LATE = f"""
    WITH ends AS (SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM events),
    arriving AS (
        SELECT user_id, event_type, ts, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
               (epoch_us(ts) - low) * 4 // (high - low + 1) + CASE WHEN event_id % 7 = 0 THEN 2 ELSE 0 END AS arrival
        FROM events, ends),
    marks AS (
        SELECT a.n AS arrival, date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE AS mark
        FROM range({ARRIVALS + 1}) a(n) LEFT JOIN arriving r ON r.arrival < a.n GROUP BY a.n)
    SELECT 'cp-' || user_id AS charge_point_id, event_type AS status, count(*) AS status_count, window_start,
           window_start + INTERVAL 5 MINUTE AS window_end
    FROM arriving JOIN marks USING (arrival)
    WHERE (mark IS NULL OR window_start + INTERVAL 5 MINUTE > mark)
      AND window_start + INTERVAL 5 MINUTE <= (SELECT max(mark) FROM marks)
    GROUP BY ALL
"""

ORACLES = {
    "replay_join": _REPLAY,
    "replay_stream": _REPLAY,
    "late_rows_stream": _LATE,
    "silver_job": """
        SELECT CASE event_type WHEN 'view' THEN 'MeterValuesRequest' WHEN 'click' THEN 'StartTransactionRequest'
                    WHEN 'purchase' THEN 'StartTransactionResponse' ELSE 'StopTransactionRequest' END AS "table",
               CAST(event_id AS VARCHAR) AS message_id, 'cp-' || user_id AS charge_point_id, CAST(year(ts) AS INTEGER) AS year,
               CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day FROM events""",
    "tumbling_counts": """
        SELECT event_type, count(*) AS n, time_bucket(INTERVAL 5 MINUTE, ts) AS window_start,
               time_bucket(INTERVAL 5 MINUTE, ts) + INTERVAL 5 MINUTE AS window_end FROM events GROUP BY ALL""",
    "status_select": """SELECT 'cp-' || user_id AS charge_point_id, event_type AS status, ts AS timestamp FROM events""",
    "props_select": """SELECT event_id, CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS k, event_type
                       FROM events""",
    "status_counts_stream": f"""SELECT * FROM ({_WINDOWS})
        WHERE window_end <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 10 MINUTE FROM events)""",
    "status_counts_update_stream": _WINDOWS,
    "bronze_stream": """
        SELECT CAST(event_id AS VARCHAR) AS message_id, 'cp-' || user_id AS charge_point_id,
               CAST(floor(epoch(ts)) AS BIGINT) AS write_timestamp_epoch, CAST(year(ts) AS INTEGER) AS year,
               CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
               CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute FROM events""",
    "chart_silver_stream": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CAST(CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 1 ELSE 12 END AS INTEGER) AS rank,
               CAST(o_orderdate AS DATE) AS date, c_name AS artist,
               CAST(floor(o_totalprice) AS INTEGER) AS streams,
               CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS explicit,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN
                    CAST(o_orderdate - to_days(CAST(o_custkey AS INTEGER)) AS DATE) END AS release_date,
               CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(c_acctbal / 10000 AS FLOAT) END AS af_energy
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')""",
    "age_group_stream": """
        SELECT gender, round(avg(age), 2) AS mean_age_group FROM (
            SELECT CAST(round(CAST('0x' || substr(md5('users-gender|' || c_custkey), 1, 8) AS BIGINT)
                       / 4294967296.0 + 0.2) AS INTEGER) AS gender,
                   CAST(round(CAST('0x' || substr(md5('users-age|' || c_custkey), 1, 8) AS BIGINT)
                       / 4294967296.0 * 10) AS INTEGER) AS age FROM customer) GROUP BY gender""",
}
