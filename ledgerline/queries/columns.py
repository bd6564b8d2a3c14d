"""Projection, filter, conversion and scalar queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import casts
from ledgerline.functions.scalars import (
    air_quality_class,
    alphanumeric,
    calendar_parts,
    location_parts,
)
from ledgerline.plans import charts
from ledgerline.plans.sensors import LOCATION_FIELDS
from ledgerline.queries.frames import chart_text
from ledgerline.sources.catalog import as_view
from ledgerline.sources.readers import read_table, rows_of_day as day_rows
from ledgerline.sources.writers import split_quality, union_evolving


def project_basic(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem")
    return (
        lines.select("*", F.lit("line").alias("kind"))
        .withColumn("l_quantity", F.col("l_quantity").cast("int"))
        .select(["l_orderkey", "l_linenumber", "kind"] + ["l_quantity"])
    )


def rename_drop(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem")
    return (
        lines.withColumnRenamed("l_returnflag", "returned")
        .drop("l_extendedprice", "l_discount", "l_tax", "l_shipdate")
        .drop(F.col("l_linestatus"))
        .drop("l_quantity")
    )


def math_basic(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem")
    price, discount, quantity = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_quantity")
    return lines.select(
        "l_orderkey",
        F.round(price * (1 - discount), 4).alias("net"),
        F.round(price / quantity, 8).alias("unit_price"),
        F.abs(quantity - 25).alias("distance"),
        (quantity + 1).alias("one_more"),
    )


def sql_view(spark: SparkSession, sf: str) -> DataFrame:
    as_view(read_table(spark, sf, "customer").selectExpr("*", "c_acctbal < 0 AS in_debt"), "account")
    return spark.sql("SELECT in_debt, count(*) AS n, round(avg(c_acctbal), 2) AS mean FROM account GROUP BY in_debt")


def clean_chart_rows(spark: SparkSession, sf: str) -> DataFrame:
    return charts.clean(chart_text(spark, sf))


def null_filters(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p"))
    missing = orders.where(F.col("p").isNull()).agg(F.lit("null").alias("part"), F.count("*").alias("n"))
    present = orders.where(F.col("p").isNotNull()).agg(F.lit("value").alias("part"), F.count("*").alias("n"))
    return missing.union(present)


def dropna_nonzero(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem").select(
        "l_orderkey", F.nullif("l_discount", F.lit(0.0)).alias("discount"), "l_tax", "l_quantity"
    )
    return lines.na.drop(subset=["discount"]).where((F.col("l_tax") != 0) & (F.col("l_quantity") > 10))


def in_or_predicate(spark: SparkSession, sf: str) -> DataFrame:
    customer = read_table(spark, sf, "customer")
    return customer.where(F.col("c_custkey").isin(1, 2, 99) | (F.col("c_mktsegment") == "BUILDING"))


def rows_of_day(spark: SparkSession, sf: str) -> DataFrame:
    events = day_rows(read_table(spark, sf, "events"), "ts", date(2024, 1, 15))
    return events.select("event_id", "user_id", F.to_date("ts").alias("day"))


def quarantine_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").withColumn("status", F.nullif("o_orderstatus", F.lit("P")))
    good, bad = split_quality(orders, F.col("status").isNotNull())
    sums = [F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")]
    return good.agg(F.lit("good").alias("quality"), *sums).union(bad.agg(F.lit("quarantine"), *sums))


def union_all(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    stacked = union_evolving(*[orders.where(F.col("o_orderpriority") == n) for n in names])
    return stacked.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def schema_evolve_union(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders")
    old = orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus")
    new = orders.where("o_orderstatus <> 'F'").select("o_orderpriority", "o_orderkey", "o_orderstatus")
    return union_evolving(old, new)


def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    text = F.date_format("ts", casts.ISO_MICROS)
    short = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX")
    return events.select(
        "event_id",
        casts.wall_clock(casts.exact_timestamp(text)).alias("exact"),
        casts.wall_clock(casts.iso_timestamp(text)).alias("iso"),
        casts.wall_clock(casts.iso_timestamp(short)).alias("iso_seconds"),
        casts.exact_timestamp(short).isNull().alias("short_rejected"),
        casts.iso_timestamp(F.col("event_type")).isNull().alias("word_rejected"),
    )


def epoch_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    epoch = casts.epoch_seconds("ts")
    return read_table(spark, sf, "events").select(
        "event_id", epoch.alias("epoch"), casts.wall_clock(casts.from_epoch(epoch)).alias("second")
    )


def date_parts(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    return events.withColumns(calendar_parts("ts")).select("event_id", "year", "month", "day", "hour", "minute")


def score_category(spark: SparkSession, sf: str) -> DataFrame:
    events = read_table(spark, sf, "events")
    return events.select("event_id", air_quality_class(F.col("value")).alias("category"))


def sanitize_name(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "customer").select("c_custkey", alphanumeric(F.col("c_name")).alias("name"))


def parse_location(spark: SparkSession, sf: str) -> DataFrame:
    customer = read_table(spark, sf, "customer")
    nation = read_table(spark, sf, "nation")
    text = F.concat(
        F.when(F.col("c_acctbal") < 0, "[(").otherwise("("),
        F.concat_ws(
            ", ",
            *[
                F.concat(F.lit("'"), c.cast("string"), F.lit("'"))
                for c in (
                    F.round(F.col("c_acctbal") / 100).cast("int") + 1000,
                    F.col("c_custkey") + 10,
                    F.col("c_mktsegment"),
                    F.col("n_name"),
                    F.concat(F.lit("Zone/"), F.col("c_nationkey")),
                )
            ],
        ),
        F.lit(")"),
    )
    located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", location_parts(text, LOCATION_FIELDS).alias("place")
    )
    return located.select("c_custkey", "place.*")


QUERIES = {
    f.__name__: f
    for f in (
        project_basic,
        rename_drop,
        math_basic,
        sql_view,
        clean_chart_rows,
        null_filters,
        dropna_nonzero,
        in_or_predicate,
        rows_of_day,
        quarantine_split,
        union_all,
        schema_evolve_union,
        parse_timestamps,
        epoch_roundtrip,
        date_parts,
        score_category,
        sanitize_name,
        parse_location,
    )
}

ORACLES = {
    "project_basic": """SELECT l_orderkey, l_linenumber, 'line' AS kind,
                               CAST(l_quantity AS INTEGER) AS l_quantity FROM lineitem""",
    "rename_drop": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag AS returned
                      FROM lineitem""",
    "math_basic": """SELECT l_orderkey, round(l_extendedprice * (1 - l_discount), 4) AS net,
                            round(l_extendedprice / l_quantity, 8) AS unit_price,
                            abs(l_quantity - 25) AS distance, l_quantity + 1 AS one_more FROM lineitem""",
    "sql_view": """SELECT c_acctbal < 0 AS in_debt, count(*) AS n, round(avg(c_acctbal), 2) AS mean
                   FROM customer GROUP BY 1""",
    "clean_chart_rows": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id, 'order' AS title,
               CAST(CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 1 ELSE 12 END AS INTEGER) AS rank,
               CAST(o_orderdate AS DATE) AS date, c_name AS artist, c_mktsegment AS region,
               CASE WHEN o_orderstatus = 'O' THEN 'viral50' ELSE 'top200' END AS chart,
               o_orderpriority AS trend,
               CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '4-NOT SPECIFIED' THEN NULL
                    ELSE CAST(floor(o_totalprice) AS INTEGER) END AS streams,
               CAST(o_custkey AS VARCHAR) AS track_id, c_mktsegment AS album,
               CAST(floor(o_totalprice / 5000) AS INTEGER) AS popularity,
               CAST(floor(o_totalprice) AS INTEGER) AS duration_ms,
               CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE END AS explicit,
               CASE WHEN o_orderpriority <> '3-MEDIUM' THEN
                    CAST(o_orderdate - to_days(CAST(o_custkey AS INTEGER)) AS DATE) END AS release_date,
               CAST(o_totalprice / 1000000 AS FLOAT) AS af_danceability,
               CASE WHEN o_orderpriority <> '2-HIGH' THEN CAST(c_acctbal / 10000 AS FLOAT) END AS af_energy
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "null_filters": """SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'null' ELSE 'value' END AS part,
                              count(*) AS n FROM orders GROUP BY 1""",
    "dropna_nonzero": """SELECT l_orderkey, l_discount AS discount, l_tax, l_quantity FROM lineitem
                         WHERE l_discount <> 0 AND l_tax <> 0 AND l_quantity > 10""",
    "in_or_predicate": "SELECT * FROM customer WHERE c_custkey IN (1, 2, 99) OR c_mktsegment = 'BUILDING'",
    "rows_of_day": """SELECT event_id, user_id, CAST(ts AS DATE) AS day FROM events
                      WHERE CAST(ts AS DATE) = DATE '2024-01-15'""",
    "quarantine_split": """SELECT CASE WHEN o_orderstatus = 'P' THEN 'quarantine' ELSE 'good' END AS quality,
                                  count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders GROUP BY 1""",
    "union_all": """SELECT o_orderpriority, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys
                    FROM orders GROUP BY 1""",
    "schema_evolve_union": """SELECT o_orderkey, o_orderstatus,
                                     CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
                              FROM orders""",
    "parse_timestamps": """SELECT event_id, ts AS exact, ts AS iso, date_trunc('second', ts) AS iso_seconds,
                                  TRUE AS short_rejected, TRUE AS word_rejected FROM events""",
    "epoch_roundtrip": """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS epoch,
                                 date_trunc('second', ts) AS second FROM events""",
    "date_parts": """SELECT event_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
                            CAST(day(ts) AS INTEGER) AS day, CAST(hour(ts) AS INTEGER) AS hour,
                            CAST(minute(ts) AS INTEGER) AS minute FROM events""",
    "score_category": """SELECT event_id, CAST(CASE WHEN value <= 50 THEN 1 WHEN value <= 100 THEN 2
                                WHEN value <= 150 THEN 3 WHEN value <= 200 THEN 4 WHEN value <= 300 THEN 5
                                ELSE 6 END AS INTEGER) AS category FROM events""",
    "sanitize_name": "SELECT c_custkey, replace(c_name, '#', '') AS name FROM customer",
    "parse_location": """SELECT c_custkey, CAST(CAST(round(c_acctbal / 100) AS INTEGER) + 1000 AS VARCHAR) AS lat,
                                CAST(c_custkey + 10 AS VARCHAR) AS long, c_mktsegment AS city, n_name AS country,
                                'Zone/' || c_nationkey AS timezone
                         FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}
