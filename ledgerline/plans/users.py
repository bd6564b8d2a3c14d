"""A users table: made from ids, loaded, changed, versioned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scalars import uniform_bits

# Word lists the made-up users are drawn from.
FIRST_NAMES = "Ada Ben Cleo Dan Eva Finn Gita Hugo Iris Jon Kira Leo Mona Nils Olga Paul".split()
LAST_NAMES = "Adler Berg Cole Dietz Ekman Fox Grant Hale Ito Jansen Kaya Lund Moreau Novak Okoye Park".split()
STREETS = "Hill Lake Mill Park River Station Garden Harbour".split()

# Columns of the users table.
USERS = """
    id bigint, creation_date timestamp, firstname string, lastname string,
    email string, address string, gender int, age_group int
"""

SECONDS_PER_DAY = 86_400


def make_users(ids: DataFrame, key: str, month_start: str, days: int = 30, seed: str = "users") -> DataFrame:
    """One made-up user per id, the same for the same id and seed.

    Gender is a uniform number plus 0.2, rounded; age group ten times a uniform
    number, rounded; the creation date lies in the given month.
    """

    def bits(name: str) -> Column:
        return uniform_bits(F.col(key), salt=f"{seed}-{name}")

    def pick(words: list[str], name: str) -> Column:
        return F.get(F.array(*[F.lit(w) for w in words]), (bits(name) % len(words)).cast("int"))

    def uniform(name: str) -> Column:
        return bits(name) / F.lit(float(1 << 32))

    first, last = pick(FIRST_NAMES, "first"), pick(LAST_NAMES, "last")
    created = F.unix_seconds(F.lit(month_start).cast("timestamp")) + bits("created") % (days * SECONDS_PER_DAY)
    number = (bits("number") % 200 + 1).cast("string")
    return ids.select(
        F.col(key).cast("long").alias("id"),
        F.timestamp_seconds(created).alias("creation_date"),
        first.alias("firstname"),
        last.alias("lastname"),
        F.lower(F.concat(first, F.lit("."), last, F.lit("@example.com"))).alias("email"),
        F.concat(number, F.lit(" "), pick(STREETS, "street"), F.lit(" Street")).alias("address"),
        F.round(uniform("gender") + 0.2).cast("int").alias("gender"),
        F.round(uniform("age") * 10).cast("int").alias("age_group"),
    )


def mean_age_group(users: DataFrame) -> DataFrame:
    """Mean age group by gender, two decimals.  Works on streams in complete mode."""
    return users.groupBy("gender").agg(F.round(F.avg("age_group"), 2).alias("mean_age_group"))
