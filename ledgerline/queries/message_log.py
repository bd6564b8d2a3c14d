"""A charging log derived from orders and their lines.

Every order is a charging session of its customer's charge point.  Requests of
'5-LOW' orders and responses of '4-NOT SPECIFIED' orders went missing, so both
sides of the start join have unmatched rows.  Sessions of 'F' orders have ended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casts import ISO_MICROS
from ledgerline.plans.charging_schemas import MAIN_MEASURAND
from ledgerline.sources.readers import read_table

LOST_REQUEST, LOST_RESPONSE = "5-LOW", "4-NOT SPECIFIED"


def message_log(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "o_orderpriority",
        F.concat(F.lit("cp-"), F.col("o_custkey")).alias("charge_point_id"),
        F.floor("o_totalprice").cast("int").alias("meter_start"),
        (F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int"))).alias("start_ts"),
    )
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag", "l_shipdate")

    start_request = orders.where(F.col("o_orderpriority") != LOST_REQUEST).transform(
        _message,
        "m",
        2,
        "StartTransaction",
        F.col("start_ts"),
        F.struct(
            F.lit(1).alias("connector_id"),
            F.col("o_orderpriority").alias("id_tag"),
            "meter_start",
            _text(F.col("start_ts")).alias("timestamp"),
            F.lit(None).cast("int").alias("reservation_id"),
        ),
    )
    start_response = orders.where(F.col("o_orderpriority") != LOST_RESPONSE).transform(
        _message,
        "m",
        3,
        "StartTransaction",
        F.col("start_ts"),
        F.struct(
            F.col("o_orderkey").cast("int").alias("transaction_id"),
            F.struct(F.lit("Accepted").alias("status")).alias("id_tag_info"),
        ),
    )
    used = lines.groupBy("l_orderkey").agg(F.sum("l_quantity").cast("int").alias("q"))
    ended = orders.where("o_orderstatus = 'F'").join(used, F.col("o_orderkey") == F.col("l_orderkey"))
    stop_ts = F.col("start_ts") + F.make_dt_interval(mins=F.col("q"))
    stop_request = ended.transform(
        _message,
        "s",
        2,
        "StopTransaction",
        stop_ts,
        F.struct(
            (F.col("meter_start") + 10 * F.col("q")).alias("meter_stop"),
            _text(stop_ts).alias("timestamp"),
            F.col("o_orderkey").cast("int").alias("transaction_id"),
            F.col("o_orderpriority").alias("id_tag"),
            F.array().cast("array<string>").alias("transaction_data"),
        ),
    )
    shipped = lines.groupBy("l_orderkey", "l_shipdate").agg(
        F.sum(F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).otherwise(0)).alias("power"),
        F.sum("l_quantity").alias("energy"),
    )
    days = F.datediff("l_shipdate", F.lit("1995-01-01"))
    reading_ts = F.col("start_ts") + F.make_dt_interval(mins=days)
    # Two readings per message: power with a single-phase sample beside it, then energy.
    reading = shipped.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("seq", days)
    meter_values = reading.transform(
        _message,
        "v",
        2,
        "MeterValues",
        reading_ts,
        F.struct(
            F.lit(1).alias("connector_id"),
            F.col("o_orderkey").cast("int").alias("transaction_id"),
            F.array(
                F.struct(
                    _text(reading_ts).alias("timestamp"),
                    F.array(
                        _sample(F.col("power"), MAIN_MEASURAND, None),
                        _sample(F.col("power") + 1, MAIN_MEASURAND, "L1"),
                    ).alias("sampled_value"),
                ),
                F.struct(
                    _text(reading_ts + F.make_dt_interval(secs=F.lit(30))).alias("timestamp"),
                    F.array(_sample(F.col("energy"), "Energy.Active.Import.Register", None)).alias("sampled_value"),
                ),
            ).alias("meter_value"),
        ),
        F.concat(F.lit("-"), F.col("seq")),
    )
    return start_request.unionByName(start_response).unionByName(stop_request).unionByName(meter_values)


def _text(ts: Column) -> Column:
    return F.date_format(ts, ISO_MICROS)


def _sample(value: Column, measurand: str, phase: str | None) -> Column:
    return F.struct(
        value.cast("string").alias("value"),
        F.lit(measurand).alias("measurand"),
        F.lit(phase).cast("string").alias("phase"),
        F.lit("W").alias("unit"),
    )


def _message(
    df: DataFrame, prefix: str, kind: int, action: str, ts: Column, body: Column, suffix: Column | None = None
) -> DataFrame:
    parts = [F.lit(f"{prefix}-"), F.col("o_orderkey")] + ([suffix] if suffix is not None else [])
    return df.select(
        F.concat(*parts).alias("message_id"),
        F.lit(kind).alias("message_type"),
        "charge_point_id",
        F.lit(action).alias("action"),
        _text(ts).alias("write_timestamp"),
        F.to_json(body).alias("body"),
    )
