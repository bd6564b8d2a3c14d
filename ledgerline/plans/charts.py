"""Music charts: raw text rows to clean rows to the questions asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.casts import to_bool, to_day, to_float, to_int
from ledgerline.operators import aggregates as agg
from ledgerline.sources.writers import LAYER_CODEC, split_quality, write_parquet, write_with_quarantine

# Columns of a raw chart row, all text.
RAW_COLUMNS = """
    id Unnamed0 title rank date artist url region chart trend streams track_id album popularity duration_ms
    explicit release_date available_markets af_danceability af_energy af_key af_loudness af_mode af_speechiness
    af_acousticness af_instrumentalness af_liveness af_valence af_tempo af_time_signature
""".split()
RAW_SCHEMA = ", ".join(f"{c} string" for c in RAW_COLUMNS)

# Columns that are not kept, and the types of those that are not text.
DROPPED = ["Unnamed0", "Unnamed: 0", "url", "available_markets"]
# Headers of files that were written with a nameless index column.
HEADERS = {"id": "_c0", "Unnamed0": "Unnamed: 0"}
BATCH_COLUMNS = [HEADERS.get(c, c) for c in RAW_COLUMNS]
CONVERSIONS = {
    "rank": to_int,
    "date": to_day,
    "streams": to_int,
    "popularity": to_int,
    "duration_ms": to_int,
    "explicit": to_bool,
    "release_date": to_day,
    "af_danceability": to_float,
    "af_energy": to_float,
}
# Columns that are correlated, features that are profiled, and rows of a frequent artist.
CORRELATED = """
    popularity af_danceability af_energy af_key af_loudness af_mode af_speechiness af_acousticness
    af_instrumentalness af_liveness af_valence af_tempo af_time_signature
""".split()
PROFILED = "danceability energy loudness speechiness acousticness liveness valence tempo".split()
FREQUENT = 1000


def clean(raw: DataFrame) -> DataFrame:
    """Typed columns; text that does not fit its type becomes NULL.  Works on streams too.

    Takes the names of a stream's schema and those of files with a nameless index column.
    """
    raw = raw.withColumnRenamed(HEADERS["id"], "id")
    typed = {c: convert(c) for c, convert in CONVERSIONS.items() if c in raw.columns}
    return raw.drop(*DROPPED).withColumns(typed)


def with_streams(df: DataFrame) -> DataFrame:
    return df.where(F.col("streams").isNotNull())


def split_streams(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a stream count, and the rows set aside for lack of one."""
    return split_quality(df, F.col("streams").isNotNull())


def regional_profile(df: DataFrame) -> DataFrame:
    """Mean of each audio feature per region, scaled to the range the feature has there."""
    numbers = df.select("region", *[F.col(f"af_{name}").try_cast("double").alias(name) for name in PROFILED])
    return agg.scaled_means(numbers, ["region"], {name: name for name in PROFILED})


def feature_correlation(df: DataFrame) -> DataFrame:
    """Correlation of popularity and audio features over rows that have all of them and are popular at all."""
    numbers = df.select(*[F.col(c).try_cast("double").alias(c) for c in CORRELATED])
    return agg.correlation_matrix(numbers.where(F.col("popularity") != 0), CORRELATED)


def artist_popularity(df: DataFrame, more_than: int = FREQUENT) -> DataFrame:
    """Mean popularity of artists with many chart rows, most popular first."""
    rated = df.where(F.col("artist").isNotNull() & F.col("popularity").isNotNull() & (F.col("popularity") != 0))
    mean = agg.frequent_means(rated, ["artist"], more_than, "popularity", "average_popularity")
    return mean.orderBy(F.col("average_popularity").desc())


def _top200_years(df: DataFrame) -> DataFrame:
    dated = df.where((F.col("chart") == "top200") & F.col("release_date").isNotNull())
    return dated.select(F.year("date").alias("date_year"), F.year("release_date").alias("release_year"))


def release_date_gaps(df: DataFrame) -> DataFrame:
    return agg.null_share(df.where(F.col("chart") == "top200"), "release_date")


def release_year_share(df: DataFrame) -> DataFrame:
    return agg.share_of_group(_top200_years(df), "date_year", "release_year")


def release_year_top3(df: DataFrame) -> DataFrame:
    return agg.top_and_others(_top200_years(df), "date_year", "release_year", 3)


def favourite_artists(df: DataFrame) -> DataFrame:
    """The most popular artist of each region and year."""
    return agg.greatest_by(df.withColumn("year", F.year("date")), ["region", "year"], "popularity", "artist")


def favourite_artist_means(df: DataFrame) -> DataFrame:
    """Joint credits split into single artists, mean popularity per region, year and artist."""
    return agg.exploded_mean(favourite_artists(df), ["region", "year"], "artist", ", ", "popularity", "popularity")


def yearly_popularity(df: DataFrame) -> DataFrame:
    """Mean over the artists of a year of their mean popularity."""
    per_artist = agg.exploded_mean(favourite_artists(df), ["year"], "artist", ", ", "popularity", "popularity")
    return per_artist.groupBy("year").agg(F.avg("popularity").alias("overall_popularity"))


QUESTIONS = (
    regional_profile,
    feature_correlation,
    artist_popularity,
    release_date_gaps,
    release_year_share,
    release_year_top3,
    favourite_artists,
    favourite_artist_means,
    yearly_popularity,
)


def build_silver(raw: DataFrame, base: str) -> DataFrame:
    """Bronze and the checked rows under ``base``; returns the silver table.

    Rows are checked in one pass, which writes those with a stream count, the silver table, to
    ``checked/quality=good`` and the others to ``checked/quality=quarantine``.
    """
    spark = raw.sparkSession
    write_parquet(raw, f"{base}/bronze", compression=LAYER_CODEC)
    write_with_quarantine(clean(spark.read.parquet(f"{base}/bronze")), F.col("streams").isNotNull(), f"{base}/checked", LAYER_CODEC)
    return spark.read.parquet(f"{base}/checked").where("quality = 'good'").drop("quality")


def build_layers(raw: DataFrame, base: str) -> dict[str, DataFrame]:
    """Bronze, checked rows (silver and quarantine) and the gold tables under ``base``."""
    silver, spark = build_silver(raw, base), raw.sparkSession
    for question in QUESTIONS:
        write_parquet(question(silver), f"{base}/gold/{question.__name__}")
    return {q.__name__: spark.read.parquet(f"{base}/gold/{q.__name__}") for q in QUESTIONS}
