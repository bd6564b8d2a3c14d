"""Column expressions shared by several pipelines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions.casts import epoch_seconds, instant

# Upper bounds of the air-quality classes 1 to 5; above is class 6.
AIR_QUALITY_BOUNDS = [50, 100, 150, 200, 300]

# Message direction by message type.
DIRECTION = {2: "Request", 3: "Response"}


def hours_between(start: Column | str, stop: Column | str) -> Column:
    """Whole seconds from start to stop as hours, two decimals."""
    return F.round((epoch_seconds(stop) - epoch_seconds(start)) / F.lit(3600.0), 2)


def energy_used(start: Column, stop: Column, unit: str = "kWh") -> Column:
    """Meter difference: kWh with two decimals, or the raw Wh as double."""
    if unit == "kWh":
        return F.round((stop - start) / F.lit(1000.0), 2)
    if unit == "Wh":
        return (stop - start).cast("double")
    raise ValueError(f"unknown unit {unit!r}")


def air_quality_class(score: Column) -> Column:
    """Class 1 to 6.  NULL scores fall through every bound, as in a chain of comparisons."""
    ladder = F.when(score <= AIR_QUALITY_BOUNDS[0], 1)
    for cls, bound in enumerate(AIR_QUALITY_BOUNDS[1:], start=2):
        ladder = ladder.when(score <= bound, cls)
    return ladder.otherwise(6)


def message_label(action: Column, message_type: Column) -> Column:
    """Action plus direction, such as ``StartTransactionRequest``; NULL for other types."""
    direction = F.lit(None).cast("string")
    for number, name in DIRECTION.items():
        direction = F.when(message_type == number, name).otherwise(direction)
    return F.concat(action, direction)


def alphanumeric(text: Column) -> Column:
    return F.regexp_replace(text, "[^a-zA-Z0-9]", "")


def calendar_parts(ts: Column | str, minute: bool = True) -> dict[str, Column]:
    """year, month, day and, for minute partitions, hour and minute."""
    at = instant(ts)
    parts = {"year": F.year(at), "month": F.month(at), "day": F.dayofmonth(at)}
    if minute:
        parts |= {"hour": F.hour(at), "minute": F.minute(at)}
    return parts


def scaled_mean(measure: Column) -> Column:
    """(mean - min) / (max - min) of a group; NULL when all values are equal."""
    low, high = F.min(measure), F.max(measure)
    return F.try_divide(F.avg(measure) - low, high - low)


def uniform_bits(*parts: Column, salt: str) -> Column:
    """A number in [0, 2^32) fixed by its inputs, so that re-run tasks agree."""
    text = F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def scaled_bits(bits: Column, width: int) -> Column:
    """A 32-bit number scaled to [0, width), in whole numbers."""
    return F.shiftright(bits * F.lit(width).cast("long"), 32)


def location_parts(text: Column, names: list[str]) -> Column:
    """Parse ``('1.5', '2.5', 'City', 'CC', 'Zone')`` into a struct.

    Brackets go first, then the pieces between quotes count when more than one
    character is left without blanks and commas.  Missing pieces are NULL.
    """
    pieces = F.filter(
        F.split(F.regexp_replace(text, r"^[\[(]+|[\])]+$", ""), "'"),
        lambda p: F.length(F.regexp_replace(p, "[ ,]", "")) > 1,
    )
    # A one-element array around the pieces, so that they are split once and not once per name.
    named = F.transform(
        F.array(pieces), lambda p: F.struct(*[F.get(p, F.lit(i)).alias(n) for i, n in enumerate(names)])
    )
    return F.get(named, F.lit(0))
