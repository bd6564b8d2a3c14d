"""Charging sessions from an event log: raw messages to charge records.

A start is a request and a response with the same message id, and the response
names the transaction.  A stop is one request with the transaction id.  Meter
readings arrive as arrays inside requests.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.casts import iso_timestamp, to_double
from ledgerline.functions.scalars import energy_used, hours_between
from ledgerline.operators.skew import DEFAULT_POLICY, HotFrom, HotKeyPolicy, enrich
from ledgerline.operators.windows import idle_time, latest_per_key
from ledgerline.plans import charging_schemas as shape
from ledgerline.sources.writers import LAYER_CODEC, write_parquet

LOG_COLUMNS = ["message_id", "message_type", "charge_point_id", "action", "write_timestamp"]

RECORD = [
    "charge_point_id",
    "transaction_id",
    "meter_start",
    "meter_stop",
    "start_timestamp",
    "stop_timestamp",
    "total_time",
    "total_energy",
    "total_parking_time",
]
SHORT_RECORD = [c for c in RECORD if c not in ("meter_start", "meter_stop")]


def messages(log: DataFrame, action: str, message_type: int) -> DataFrame:
    """Messages of one action and direction."""
    return log.where((F.col("action") == action) & (F.col("message_type") == message_type))


def unpack(df: DataFrame, schema: str, out: str = "new_body") -> DataFrame:
    """Parse the JSON body.  A bad field is NULL, a bad document has all fields NULL, the row stays."""
    return df.withColumn(out, F.from_json("body", schema, {"mode": "PERMISSIVE"}))


def start_requests(log: DataFrame) -> DataFrame:
    parsed = unpack(messages(log, "StartTransaction", shape.REQUEST), shape.START_REQUEST)
    return parsed.select(
        *LOG_COLUMNS,
        "new_body.connector_id",
        "new_body.id_tag",
        "new_body.meter_start",
        iso_timestamp("new_body.timestamp").alias("timestamp"),
        "new_body.reservation_id",
    )


def start_responses(log: DataFrame) -> DataFrame:
    parsed = unpack(messages(log, "StartTransaction", shape.RESPONSE), shape.START_RESPONSE)
    return parsed.select(
        *LOG_COLUMNS,
        "new_body.transaction_id",
        F.col("new_body.id_tag_info.status").alias("id_tag_info_status"),
        F.col("new_body.id_tag_info.parent_id_tag").alias("id_tag_info_parent_id_tag"),
        F.col("new_body.id_tag_info.expiry_date").alias("id_tag_info_expiry_date"),
    )


def stop_requests(log: DataFrame) -> DataFrame:
    parsed = unpack(messages(log, "StopTransaction", shape.REQUEST), shape.STOP_REQUEST)
    return parsed.select(
        *LOG_COLUMNS,
        "new_body.meter_stop",
        iso_timestamp("new_body.timestamp").alias("timestamp"),
        "new_body.transaction_id",
        "new_body.reason",
        "new_body.id_tag",
        "new_body.transaction_data",
    )


def meter_samples(log: DataFrame) -> DataFrame:
    """One row per sampled value; a message without samples has none."""
    parsed = unpack(messages(log, "MeterValues", shape.REQUEST), shape.METER_VALUES)
    # A plain explode would have its array checked below the parsing, which parses every body once more.
    readings = parsed.select("*", F.posexplode_outer("new_body.meter_value").alias("_at", "reading"))
    samples = readings.select("*", F.posexplode_outer("reading.sampled_value").alias("_nth", "sample"))
    return samples.where(F.col("_nth").isNotNull()).select(
        *LOG_COLUMNS,
        "new_body.transaction_id",
        "new_body.connector_id",
        iso_timestamp("reading.timestamp").alias("timestamp"),
        "sample.measurand",
        "sample.phase",
        F.round(to_double("sample.value"), 2).alias("value"),
    )


def main_power(samples: DataFrame) -> DataFrame:
    """Readings of the whole import power, not of a single phase."""
    return samples.where((F.col("measurand") == shape.MAIN_MEASURAND) & F.col("phase").isNull())


def matched_starts(responses: DataFrame, requests: DataFrame, how: str = "inner") -> DataFrame:
    """Starts with transaction id; ``how='left'`` keeps responses whose request is missing."""
    asked = requests.select("message_id", "meter_start", F.col("timestamp").alias("start_timestamp"))
    named = responses.select("message_id", "charge_point_id", "transaction_id")
    return named.join(asked, "message_id", how).select(
        "charge_point_id", "transaction_id", "meter_start", "start_timestamp"
    )


def matched_stops(stops: DataFrame, starts: DataFrame, keep_stop_keys: bool = False) -> DataFrame:
    """Every stop with its start.

    Transaction and charge point come from the start, so they are NULL for a stop
    without one; with ``keep_stop_keys`` the charge point comes from the stop.
    """
    s, b = stops.alias("s"), starts.alias("b")
    side = "s" if keep_stop_keys else "b"
    return s.join(b, F.col("s.transaction_id") == F.col("b.transaction_id"), "left").select(
        f"{side}.charge_point_id",
        "b.transaction_id",
        "b.meter_start",
        "s.meter_stop",
        "b.start_timestamp",
        F.col("s.timestamp").alias("stop_timestamp"),
    )


def with_totals(sessions: DataFrame, unit: str = "kWh") -> DataFrame:
    """Add total_time in hours and total_energy."""
    return sessions.withColumn("total_time", hours_between("start_timestamp", "stop_timestamp")).withColumn(
        "total_energy", energy_used(F.col("meter_start"), F.col("meter_stop"), unit)
    )


def parking_time(
    samples: DataFrame, policy: HotKeyPolicy = DEFAULT_POLICY, hot_from: HotFrom | None = None
) -> DataFrame:
    """Idle hours per transaction; a transaction that never idles has no row."""
    power = main_power(samples).select("transaction_id", "timestamp", "value")
    return idle_time(power, "transaction_id", "timestamp", F.col("value") > 0, "total_parking_time", policy, hot_from)


def with_parking(sessions: DataFrame, parking: DataFrame) -> DataFrame:
    return enrich(sessions, parking, ["transaction_id"]).select(*RECORD)


def charge_records(
    starts_asked: DataFrame,
    starts_named: DataFrame,
    stops: DataFrame,
    samples: DataFrame,
    how: str = "inner",
    unit: str = "kWh",
    policy: HotKeyPolicy = DEFAULT_POLICY,
    metered: HotFrom | None = None,
    keep_stop_keys: bool = False,
) -> DataFrame:
    """Charge records with all nine columns from the four cleaned tables.

    ``metered`` may give the transactions of ``samples`` more cheaply, for finding
    transactions with very many readings.
    """
    starts = matched_starts(starts_named, starts_asked, how)
    return (
        matched_stops(stops, starts, keep_stop_keys)
        .transform(with_totals, unit)
        .transform(with_parking, parking_time(samples, policy, metered))
    )


def charge_records_from_log(log: DataFrame, policy: HotKeyPolicy = DEFAULT_POLICY) -> DataFrame:
    """Charge records straight from the raw log: seven columns, energy in Wh, the charge point of the stop."""
    # Only sampled messages are parsed in search of hot transactions.
    transaction = F.from_json("body", "transaction_id int", {"mode": "PERMISSIVE"})["transaction_id"]
    records = charge_records(
        start_requests(log),
        start_responses(log),
        stop_requests(log),
        meter_samples(log),
        "inner",
        "Wh",
        policy,
        (messages(log, "MeterValues", shape.REQUEST).select("body"), [transaction]),
        keep_stop_keys=True,
    )
    return records.select(*SHORT_RECORD)


def build_layers(log: DataFrame, base: str, policy: HotKeyPolicy = DEFAULT_POLICY) -> DataFrame:
    """Bronze, silver and gold tables under ``base``; returns the gold table.

    Each layer is written and read back, so a lost executor never costs more than
    one layer.  Bronze is laid out by kind of message, without a shuffle, so that each
    silver table reads only its own messages.  The silver tables do not depend on
    each other and are written side by side.
    """
    spark = log.sparkSession
    log.write.mode("overwrite").partitionBy("action", "message_type").parquet(f"{base}/bronze", compression=LAYER_CODEC)
    bronze = spark.read.schema(shape.LOG).parquet(f"{base}/bronze")
    makers = {
        "start_requests": start_requests,
        "start_responses": start_responses,
        "stop_requests": stop_requests,
        "meter_samples": meter_samples,
    }
    with ThreadPoolExecutor(len(makers)) as pool:
        list(pool.map(lambda name: write_parquet(makers[name](bronze), f"{base}/silver/{name}", compression=LAYER_CODEC), makers))
    silver = {name: spark.read.parquet(f"{base}/silver/{name}") for name in makers}
    gold = charge_records(
        silver["start_requests"],
        silver["start_responses"],
        silver["stop_requests"],
        silver["meter_samples"],
        "left",
        "kWh",
        policy,
    )
    write_parquet(gold, f"{base}/gold/charge_records")
    return spark.read.parquet(f"{base}/gold/charge_records")


def last_connection(log: DataFrame, parse: Column) -> DataFrame:
    """The newest message of each charge point, with its parsed time."""
    timed = log.withColumn("converted_timestamp", parse)
    return latest_per_key(timed, ["charge_point_id"], ["converted_timestamp", "message_id", "message_type"])
