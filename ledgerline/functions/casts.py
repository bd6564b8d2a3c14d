"""Conversions that give NULL on bad input instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: timestamp text with six fraction digits and an offset.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_int(c: Column | str) -> Column:
    """Text to int.  ``'12.0'`` is 12, ``'x'`` and ``''`` are NULL."""
    return _col(c).try_cast("double").try_cast("int")


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def to_float(c: Column | str) -> Column:
    return _col(c).try_cast("float")


def to_bool(c: Column | str) -> Column:
    return _col(c).try_cast("boolean")


def to_day(c: Column | str) -> Column:
    """``yyyy-MM-dd`` text to date.

    Plain dates are cast and text without digits is NULL at once: the pattern's parser, which
    throws and catches an exception for every misfit, only sees the rest.
    """
    text = _col(c)
    parsed = F.when(text.rlike(r"[0-9]"), F.try_to_date(text, "yyyy-MM-dd"))
    return F.when(text.rlike(r"\A(?!0000)[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date")).otherwise(parsed)


def iso_timestamp(c: Column | str) -> Column:
    """ISO-8601 text, with or without fraction, to timestamp."""
    return F.try_to_timestamp(_col(c))


def exact_timestamp(c: Column | str) -> Column:
    """Text with exactly six fraction digits and an offset to timestamp."""
    return F.try_to_timestamp(_col(c), F.lit(ISO_MICROS))


def instant(c: Column | str) -> Column:
    """Zone-less timestamp to instant in the session time zone."""
    return _col(c).cast("timestamp")


def wall_clock(c: Column | str) -> Column:
    """Instant to zone-less timestamp in the session time zone."""
    return _col(c).cast("timestamp_ntz")


def epoch_seconds(c: Column | str) -> Column:
    return F.unix_seconds(instant(c))


def from_epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(_col(c))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
