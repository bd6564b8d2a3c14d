"""Sorting and the first rows of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows; every task keeps only ``n`` before anything is moved."""
    return df.orderBy(*order).limit(n)


def any_row(df: DataFrame) -> DataFrame:
    """One row, whichever comes first; reads no further than needed."""
    return df.limit(1)


def emissions_ranking(df: DataFrame, n: int | None = None) -> DataFrame:
    """Year, emissions and land temperature, largest emissions first."""
    columns = df.select("Year", "TotalEmissions", "LandMaxTemperature")
    ordered = columns.orderBy(columns["TotalEmissions"].desc())
    return ordered if n is None else ordered.limit(n)
