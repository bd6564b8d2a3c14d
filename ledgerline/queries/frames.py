"""Frames in the shapes of the pipelines, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.charts import RAW_COLUMNS
from ledgerline.sources.readers import read_table


def chart_text(spark: SparkSession, sf: str) -> DataFrame:
    """Raw chart rows, all text, one per order; priority and status decide which cells are malformed."""
    orders = read_table(spark, sf, "orders")
    customer = read_table(spark, sf, "customer")
    price, priority, status = F.col("o_totalprice"), F.col("o_orderpriority"), F.col("o_orderstatus")
    whole_price = F.floor(price).cast("string")
    cells = {
        "id": F.col("o_orderkey"),
        "Unnamed0": F.col("o_orderkey"),
        "title": F.lit("order"),
        "rank": F.when(status == "P", "n/a").when(status == "F", "1").otherwise("12.0"),
        "date": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "artist": F.col("c_name"),
        "url": F.concat(F.lit("orders/"), F.col("o_orderkey")),
        "region": F.col("c_mktsegment"),
        "chart": F.when(status == "O", "viral50").otherwise("top200"),
        "trend": priority,
        "streams": F.when(priority == "5-LOW", "")
        .when(priority == "4-NOT SPECIFIED", F.lit(None).cast("string"))
        .when(priority == "3-MEDIUM", F.concat(whole_price, F.lit(".0")))
        .otherwise(whole_price),
        "track_id": F.col("o_custkey"),
        "album": F.col("c_mktsegment"),
        "popularity": F.floor(price / 5000),
        "duration_ms": whole_price,
        "explicit": F.when(status == "F", "True").when(status == "O", "False").otherwise("1.0"),
        "release_date": F.when(priority == "3-MEDIUM", "1999").otherwise(
            F.date_format(F.date_sub("o_orderdate", F.col("o_custkey").cast("int")), "yyyy-MM-dd")
        ),
        "available_markets": F.lit("['AR', 'AU']"),
        "af_danceability": price / 1000000,
        "af_energy": F.when(priority == "2-HIGH", "high").otherwise((F.col("c_acctbal") / 10000).cast("string")),
    }
    named = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return named.select(*[cells[c].cast("string").alias(c) for c in RAW_COLUMNS if c in cells])
