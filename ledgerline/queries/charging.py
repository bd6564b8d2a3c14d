"""Charging queries and their checks, which use the source tables and no JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casts import iso_timestamp, wall_clock
from ledgerline.plans import charging as plan
from ledgerline.plans.charging_schemas import START_RESPONSE
from ledgerline.queries.message_log import message_log
from ledgerline.session import scratch_path
from ledgerline.sources.writers import labelled, read_routes, write_actions, write_parquet, write_route_list


def _zoneless(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: wall_clock(c) for c in columns})


def cdr(spark: SparkSession, sf: str) -> DataFrame:
    """The log is stored first, as a real one would be: the plan reads it several times."""
    path = scratch_path(spark, "log")
    write_parquet(message_log(spark, sf), path)
    return _zoneless(plan.charge_records_from_log(spark.read.parquet(path)), "start_timestamp", "stop_timestamp")


def cdr_layered(spark: SparkSession, sf: str) -> DataFrame:
    gold = plan.build_layers(message_log(spark, sf), scratch_path(spark, "charging"))
    return _zoneless(gold, "start_timestamp", "stop_timestamp")


def filter_message(spark: SparkSession, sf: str) -> DataFrame:
    log = message_log(spark, sf)
    kinds = [("StartTransaction", 2), ("StartTransaction", 3), ("StopTransaction", 2), ("MeterValues", 2)]
    counts = [plan.messages(log, *k).groupBy("action", "message_type").agg(F.count("*").alias("n")) for k in kinds]
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


def unpack_json(spark: SparkSession, sf: str) -> DataFrame:
    responses = plan.messages(message_log(spark, sf), "StartTransaction", 3)
    parsed = plan.unpack(responses, START_RESPONSE)
    return parsed.select(
        "message_id",
        F.col("new_body.transaction_id").alias("transaction_id"),
        F.col("new_body")["id_tag_info"]["status"].alias("status"),
        F.expr("new_body.id_tag_info.parent_id_tag").alias("parent_id_tag"),
    )


def unpack_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return plan.start_responses(message_log(spark, sf)).drop("write_timestamp")


def explode_meter_values(spark: SparkSession, sf: str) -> DataFrame:
    samples = plan.meter_samples(message_log(spark, sf))
    return _zoneless(
        samples.select("transaction_id", "connector_id", "timestamp", "measurand", "phase", "value"), "timestamp"
    )


def _matched(spark: SparkSession, sf: str, how: str) -> DataFrame:
    log = message_log(spark, sf)
    return _zoneless(
        plan.matched_starts(plan.start_responses(log), plan.start_requests(log), how), "start_timestamp"
    )


def match_start_inner(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf, "inner")


def match_start_left(spark: SparkSession, sf: str) -> DataFrame:
    return _matched(spark, sf, "left")


def _stops(spark: SparkSession, sf: str, keep: bool) -> DataFrame:
    log = message_log(spark, sf)
    starts = plan.matched_starts(plan.start_responses(log), plan.start_requests(log), "left")
    return plan.matched_stops(plan.stop_requests(log), starts, keep)


def stop_start_left(spark: SparkSession, sf: str) -> DataFrame:
    return _zoneless(_stops(spark, sf, False), "start_timestamp", "stop_timestamp")


def stop_start_left_keep(spark: SparkSession, sf: str) -> DataFrame:
    return _zoneless(_stops(spark, sf, True), "start_timestamp", "stop_timestamp")


def duration_hours(spark: SparkSession, sf: str) -> DataFrame:
    return plan.with_totals(_stops(spark, sf, True)).select("transaction_id", "total_time")


def energy_kwh(spark: SparkSession, sf: str) -> DataFrame:
    stops = _stops(spark, sf, True)
    raw = plan.with_totals(stops, "Wh").withColumnRenamed("total_energy", "energy_wh")
    return plan.with_totals(raw).select("transaction_id", "energy_wh", F.col("total_energy").alias("energy_kwh"))


def route_actions(spark: SparkSession, sf: str) -> DataFrame:
    return labelled(message_log(spark, sf)).groupBy("action_table").agg(F.count("*").alias("n"))


def last_connection(spark: SparkSession, sf: str) -> DataFrame:
    latest = plan.last_connection(message_log(spark, sf), iso_timestamp("write_timestamp"))
    return _zoneless(latest, "converted_timestamp").select(
        "charge_point_id", "message_id", "message_type", "action", "converted_timestamp"
    )


def routed_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The log routed into tables by action, then only the tables of requests read back."""
    base = scratch_path(spark, "routed")
    write_actions(message_log(spark, sf), f"{base}/tables", parts=["year"])
    write_route_list(spark, f"{base}/tables", f"{base}/list")
    wanted = spark.read.parquet(f"{base}/list").where(F.col("message_type") == 2)
    rows = read_routes(spark, f"{base}/tables", wanted)
    return rows.groupBy("action_table").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("charge_point_id").alias("points"))


QUERIES = {
    f.__name__: f
    for f in (
        cdr,
        cdr_layered,
        filter_message,
        unpack_json,
        unpack_flatten,
        explode_meter_values,
        match_start_inner,
        match_start_left,
        stop_start_left,
        stop_start_left_keep,
        duration_hours,
        energy_kwh,
        route_actions,
        routed_tables,
        last_connection,
    )
}

SESSIONS = """
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           'cp-' || o_custkey AS charge_point_id,
           CAST(floor(o_totalprice) AS INTEGER) AS meter_start,
           o_orderdate + to_minutes(o_orderkey % 1440) AS start_ts
    FROM orders
"""

USED = "SELECT l_orderkey, CAST(sum(l_quantity) AS INTEGER) AS q FROM lineitem GROUP BY l_orderkey"

READINGS = """
    SELECT l_orderkey, l_shipdate,
           sum(CASE WHEN l_returnflag <> 'N' THEN l_quantity ELSE 0 END) AS power,
           sum(l_quantity) AS energy,
           date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS minute
    FROM lineitem GROUP BY l_orderkey, l_shipdate
"""

STARTS = """
    SELECT o.charge_point_id, CAST(o.o_orderkey AS INTEGER) AS transaction_id,
           CASE WHEN o.o_orderpriority <> '5-LOW' THEN o.meter_start END AS meter_start,
           CASE WHEN o.o_orderpriority <> '5-LOW' THEN o.start_ts END AS start_timestamp
    FROM sessions o WHERE o.o_orderpriority <> '4-NOT SPECIFIED'
"""

STOPS = """
    SELECT charge_point_id, CAST(o_orderkey AS INTEGER) AS transaction_id,
           CAST(meter_start + 10 * q AS INTEGER) AS meter_stop, start_ts + to_minutes(q) AS stop_timestamp
    FROM sessions JOIN used ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F'
"""

PARKING = """
    SELECT transaction_id, round(sum(CASE WHEN was_idle THEN minute - before ELSE 0 END) / 60.0, 2)
               AS total_parking_time
    FROM (
        SELECT CAST(l_orderkey AS INTEGER) AS transaction_id, minute, power,
               lag(power) OVER w <= 0 AS was_idle, lag(minute) OVER w AS before
        FROM readings WINDOW w AS (PARTITION BY l_orderkey ORDER BY minute)
    ) WHERE power <= 0 GROUP BY transaction_id
"""

WITH = (
    f"WITH sessions AS ({SESSIONS}), used AS ({USED}), readings AS ({READINGS}), starts AS ({STARTS}), "
    f"stops AS ({STOPS}), parking AS ({PARKING}) "
)


def _record(kind: str) -> str:
    """Charge records; ``kind`` is how starts without a request are treated."""
    starts = "starts" if kind == "left" else "(SELECT * FROM starts WHERE start_timestamp IS NOT NULL)"
    meters = "b.meter_start, s.meter_stop, " if kind == "left" else ""
    energy = (
        "round((s.meter_stop - b.meter_start) / 1000.0, 2)"
        if kind == "left"
        else "CAST(s.meter_stop - b.meter_start AS DOUBLE)"
    )
    return (
        WITH
        + f"""
        SELECT {'b' if kind == 'left' else 's'}.charge_point_id, b.transaction_id, {meters} b.start_timestamp, s.stop_timestamp,
               round(date_diff('second', b.start_timestamp, s.stop_timestamp) / 3600.0, 2) AS total_time,
               {energy} AS total_energy, p.total_parking_time
        FROM stops s LEFT JOIN {starts} b ON s.transaction_id = b.transaction_id
             LEFT JOIN parking p ON p.transaction_id = b.transaction_id
        """
    )


_STOP_START = """
    SELECT {side}.charge_point_id, b.transaction_id, b.meter_start, s.meter_stop, b.start_timestamp,
           s.stop_timestamp
    FROM stops s LEFT JOIN starts b ON s.transaction_id = b.transaction_id
"""

_KINDS = """
    SELECT 'StartTransaction' AS action, 2 AS message_type, count(*) AS n FROM sessions
        WHERE o_orderpriority <> '5-LOW'
    UNION ALL SELECT 'StartTransaction', 3, count(*) FROM sessions WHERE o_orderpriority <> '4-NOT SPECIFIED'
    UNION ALL SELECT 'StopTransaction', 2, count(*) FROM stops
    UNION ALL SELECT 'MeterValues', 2, count(*) FROM readings
"""

ORACLES = {
    "cdr": _record("inner"),
    "cdr_layered": _record("left"),
    "filter_message": WITH + _KINDS,
    "unpack_json": WITH
    + """SELECT 'm-' || transaction_id AS message_id, transaction_id, 'Accepted' AS status,
                CAST(NULL AS VARCHAR) AS parent_id_tag FROM starts""",
    "unpack_flatten": WITH
    + """SELECT 'm-' || transaction_id AS message_id, CAST(3 AS INTEGER) AS message_type, charge_point_id,
                'StartTransaction' AS action, transaction_id, 'Accepted' AS id_tag_info_status,
                CAST(NULL AS VARCHAR) AS id_tag_info_parent_id_tag,
                CAST(NULL AS VARCHAR) AS id_tag_info_expiry_date FROM starts""",
    "explode_meter_values": WITH
    + """SELECT CAST(l_orderkey AS INTEGER) AS transaction_id, CAST(1 AS INTEGER) AS connector_id,
                start_ts + to_minutes(minute) + to_seconds(CASE WHEN k = 3 THEN 30 ELSE 0 END) AS timestamp,
                CASE WHEN k = 3 THEN 'Energy.Active.Import.Register' ELSE 'Power.Active.Import' END AS measurand,
                CASE WHEN k = 2 THEN 'L1' END AS phase,
                CAST(CASE k WHEN 1 THEN power WHEN 2 THEN power + 1 ELSE energy END AS DOUBLE) AS value
         FROM readings JOIN sessions ON o_orderkey = l_orderkey, (VALUES (1), (2), (3)) AS kinds(k)""",
    "match_start_inner": WITH + "SELECT * FROM starts WHERE start_timestamp IS NOT NULL",
    "match_start_left": WITH + "SELECT * FROM starts",
    "stop_start_left": WITH + _STOP_START.format(side="b"),
    "stop_start_left_keep": WITH + _STOP_START.format(side="s"),
    "duration_hours": WITH
    + """SELECT b.transaction_id,
                round(date_diff('second', b.start_timestamp, s.stop_timestamp) / 3600.0, 2) AS total_time
         FROM stops s LEFT JOIN starts b ON s.transaction_id = b.transaction_id""",
    "energy_kwh": WITH
    + """SELECT b.transaction_id, CAST(s.meter_stop - b.meter_start AS DOUBLE) AS energy_wh,
                round((s.meter_stop - b.meter_start) / 1000.0, 2) AS energy_kwh
         FROM stops s LEFT JOIN starts b ON s.transaction_id = b.transaction_id""",
    "route_actions": WITH
    + f"""SELECT action || CASE message_type WHEN 2 THEN 'Request' WHEN 3 THEN 'Response' END AS action_table, n
          FROM ({_KINDS})""",
    "routed_tables": WITH
    + """SELECT 'StartTransactionRequest' AS action_table, count(*) AS n, count(DISTINCT charge_point_id) AS points
             FROM sessions WHERE o_orderpriority <> '5-LOW'
         UNION ALL SELECT 'StopTransactionRequest', count(*), count(DISTINCT charge_point_id) FROM stops
         UNION ALL SELECT 'MeterValuesRequest', count(*), count(DISTINCT charge_point_id)
             FROM readings JOIN sessions ON o_orderkey = l_orderkey""",
    "last_connection": WITH
    + """, log AS (
            SELECT charge_point_id, 'm-' || o_orderkey AS message_id, 2 AS message_type,
                   'StartTransaction' AS action, start_ts AS ts FROM sessions WHERE o_orderpriority <> '5-LOW'
            UNION ALL SELECT charge_point_id, 'm-' || o_orderkey, 3, 'StartTransaction', start_ts FROM sessions
                WHERE o_orderpriority <> '4-NOT SPECIFIED'
            UNION ALL SELECT charge_point_id, 's-' || transaction_id, 2, 'StopTransaction', stop_timestamp FROM stops
            UNION ALL SELECT charge_point_id, 'v-' || o_orderkey || '-' || minute, 2, 'MeterValues',
                start_ts + to_minutes(minute) FROM readings JOIN sessions ON o_orderkey = l_orderkey)
         SELECT charge_point_id, message_id, CAST(message_type AS INTEGER) AS message_type, action,
                ts AS converted_timestamp FROM log
         QUALIFY row_number() OVER (
            PARTITION BY charge_point_id ORDER BY ts DESC, message_id DESC, message_type DESC) = 1""",
}
