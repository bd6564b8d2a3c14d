"""Privacy transforms, all from built-in functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.casts import instant, to_double
from ledgerline.functions.scalars import scaled_bits, uniform_bits

# Shorter ids are filled up with this letter to this length.
PAD_LETTER, PAD_LENGTH = "X", 4

# Bounds of the time shift, in seconds and in minutes.
SHIFT_SECONDS, SHIFT_MINUTES = (1, 60), (1, 20)


def padded(column: str):
    text = F.col(column).cast("string")
    return F.when(F.length(text) < PAD_LENGTH, F.rpad(text, PAD_LENGTH, PAD_LETTER)).otherwise(text)


def pseudonymise(df: DataFrame, column: str, key: str) -> DataFrame:
    """Replace an id by a keyed hash: equal ids stay equal, and nobody can go back."""
    return df.withColumn(column, F.sha2(F.concat(F.lit(key), padded(column)), 256))


def encrypt_id(df: DataFrame, column: str, key: str) -> DataFrame:
    """Replace an id by its encryption: equal ids stay equal, and the holder of the key can go back.

    The key has 16, 24 or 32 characters.
    """
    return df.withColumn(column, F.base64(F.aes_encrypt(padded(column), F.lit(key), F.lit("ECB"), F.lit("PKCS"))))


def decrypt_id(df: DataFrame, column: str, key: str) -> DataFrame:
    """Undo ``encrypt_id``; the padding of short ids stays."""
    plain = F.aes_decrypt(F.unbase64(column), F.lit(key), F.lit("ECB"), F.lit("PKCS"))
    return df.withColumn(column, plain.cast("string"))


def reduce_precision(df: DataFrame, columns: list[str], digits: int = 3, half_even: bool = False) -> DataFrame:
    """Round numbers, given as text or as numbers."""
    round_to = F.bround if half_even else F.round
    return df.withColumns({c: round_to(to_double(c), digits) for c in columns})


def jitter_time(df: DataFrame, column: str, with_columns: list[str], seed: str) -> DataFrame:
    """Move each time forward by 1 to 60 seconds plus 1 to 20 minutes.

    The shift is drawn from a hash of seed, time and ``with_columns``, so a job run
    again, or a task run again, gives the same times.
    """

    def micros(bounds: tuple[int, int], unit: int, name: str):
        low, high = bounds
        drawn = uniform_bits(F.unix_micros(instant(column)), *[F.col(c) for c in with_columns], salt=f"{seed}-{name}")
        return F.lit(low * unit) + scaled_bits(drawn, (high - low) * unit)

    shift = micros(SHIFT_SECONDS, 1_000_000, "s") + micros(SHIFT_MINUTES, 60_000_000, "m")
    return df.withColumn(column, F.timestamp_micros(F.unix_micros(instant(column)) + shift))
