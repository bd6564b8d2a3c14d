"""Sensor readings of people, and the extract of them that may be shared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import air_quality_class, location_parts
from ledgerline.operators.privacy import jitter_time, pseudonymise, reduce_precision
from ledgerline.sources.writers import write_csv

# The parts of a location text, in order.
LOCATION_FIELDS = ["lat", "long", "city", "country", "timezone"]


def parsed_readings(df: DataFrame) -> DataFrame:
    """Location text to columns, and the class of each air-quality reading."""
    placed = df.withColumn("_place", location_parts(F.col("location"), LOCATION_FIELDS))
    return (
        placed.select("*", "_place.*")
        .drop("_place", "location")
        .withColumn("air_quality_category", air_quality_class(F.col("air_quality_index")))
    )


def protected_extract(df: DataFrame, key: str, seed: str = "extract") -> DataFrame:
    """Pseudonymous users, places of about 100 m and shifted times; no raw identifying column is left."""
    shifted = jitter_time(parsed_readings(df), "timestamp", ["user_id"], seed)
    coarse = reduce_precision(shifted, ["lat", "long"], 3)
    return pseudonymise(coarse, "user_id", key)


def write_extract(df: DataFrame, path: str, key: str) -> None:
    write_csv(protected_extract(df, key), path)
