"""Charts from CSV files to gold tables: all features, all questions, and the layers as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans import charts
from ledgerline.session import scratch_path
from ledgerline.sources.readers import read_csv, read_table
from ledgerline.sources.writers import write_csv

FREQUENT = 40
# Rows of a CSV file, some 100 MB of text.
FILE_ROWS = 500_000


def chart_files(spark: SparkSession, sf: str) -> DataFrame:
    """Chart rows, one per order line, written as CSV files with a nameless index column and read back as text."""
    # Orders meet their customers first, so the lines, the largest table, are only shuffled once.
    orders = read_table(spark, sf, "orders").join(read_table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = read_table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    number, order, quantity = F.col("l_linenumber"), F.col("l_orderkey"), F.col("l_quantity")
    day = lambda c: F.to_date(c).cast("string")
    cells = {
        "_c0": order * 8 + number,
        "Unnamed: 0": order,
        "title": F.concat(F.lit('The "best", part '), number),
        "rank": number,
        "date": day("l_shipdate"),
        # Every second line is a joint credit.
        "artist": F.when(number % 2 == 0, F.concat(F.col("c_name"), F.lit(", Guest "), F.col("l_suppkey") % 5)).otherwise(F.col("c_name")),
        "url": F.lit("x"),
        "region": F.col("c_mktsegment"),
        "chart": F.when(F.col("l_linestatus") == "O", "viral50").otherwise("top200"),
        "trend": F.col("l_returnflag"),
        "streams": F.when(order % 9 == 0, None).otherwise(F.floor("l_extendedprice")),
        "track_id": F.col("l_partkey"),
        "album": F.col("l_returnflag"),
        "popularity": F.floor(quantity) - 1,
        "duration_ms": number * 1000,
        "explicit": F.when(number % 2 == 0, "True").otherwise("False"),
        "release_date": F.when(order % 5 == 0, "unknown").otherwise(day("o_orderdate")),
        "available_markets": F.lit("[]"),
        "af_danceability": F.col("l_discount"),
        "af_energy": F.col("l_tax"),
        "af_key": number,
        "af_loudness": -quantity / 2,
        "af_mode": number % 2,
        "af_speechiness": F.col("l_extendedprice") / 100000,
        "af_acousticness": F.col("o_totalprice") / 1000000,
        "af_instrumentalness": F.col("l_suppkey") % 10 / 10,
        "af_liveness": F.col("l_partkey") % 13,
        "af_valence": F.when(order % 23 == 0, None).otherwise(order % 17),
        "af_tempo": quantity * 3 + F.col("l_discount") * 100,
        "af_time_signature": number % 3 + 3,
    }
    path = scratch_path(spark, "chart-files")
    write_csv(rows.select(*[cells[c].cast("string").alias(c) for c in charts.BATCH_COLUMNS]), path, compression="gzip", file_rows=FILE_ROWS)
    return read_csv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in charts.BATCH_COLUMNS]))


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return charts.build_silver(chart_files(spark, sf), scratch_path(spark, "charts"))


def chart_batch_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned rows of files with batch headers; quoted text with commas survives the files."""
    kept = "id title rank date artist region chart streams popularity duration_ms explicit release_date af_danceability af_valence"
    return charts.clean(chart_files(spark, sf)).select(*kept.split())


def chart_regional_profile(spark: SparkSession, sf: str) -> DataFrame:
    profile = charts.regional_profile(_silver(spark, sf))
    return profile.withColumns({c: F.round(c, 6) for c in charts.PROFILED})


def chart_feature_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return charts.feature_correlation(_silver(spark, sf)).withColumn("correlation", F.round("correlation", 6))


def chart_artist_popularity(spark: SparkSession, sf: str) -> DataFrame:
    return charts.artist_popularity(_silver(spark, sf), FREQUENT).withColumn("average_popularity", F.round("average_popularity", 6))


def chart_release_date_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return charts.release_date_gaps(_silver(spark, sf)).withColumn("null_proportion", F.round("null_proportion", 6))


def chart_favourite_artist_means(spark: SparkSession, sf: str) -> DataFrame:
    return charts.favourite_artist_means(_silver(spark, sf)).withColumn("popularity", F.round("popularity", 6))


def chart_layers(spark: SparkSession, sf: str) -> DataFrame:
    """All layers written by one job: rows of bronze, of both parts of silver, and of some gold tables."""
    base = scratch_path(spark, "charts")
    gold = charts.build_layers(chart_files(spark, sf), base)
    checked = spark.read.parquet(f"{base}/checked").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))
    counts = [checked.select(F.col("quality").alias("layer"), "n")]
    for name, rows in {"bronze": spark.read.parquet(f"{base}/bronze"), **gold}.items():
        counts.append(rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("layer"), "n"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


QUERIES = {
    f.__name__: f
    for f in (
        chart_batch_clean,
        chart_regional_profile,
        chart_feature_correlation,
        chart_artist_popularity,
        chart_release_date_gaps,
        chart_favourite_artist_means,
        chart_layers,
    )
}

_ROWS = """
    WITH cells AS (
        SELECT CAST(l_orderkey * 8 + l_linenumber AS VARCHAR) AS id, 'The "best", part ' || l_linenumber AS title,
               CAST(l_linenumber AS INTEGER) AS rank, CAST(l_shipdate AS DATE) AS date,
               c_name || CASE WHEN l_linenumber % 2 = 0 THEN ', Guest ' || (l_suppkey % 5) ELSE '' END AS artist,
               c_mktsegment AS region, CASE l_linestatus WHEN 'O' THEN 'viral50' ELSE 'top200' END AS chart,
               CASE WHEN l_orderkey % 9 <> 0 THEN CAST(floor(l_extendedprice) AS INTEGER) END AS streams,
               CAST(floor(l_quantity) - 1 AS INTEGER) AS popularity, CAST(l_linenumber * 1000 AS INTEGER) AS duration_ms,
               l_linenumber % 2 = 0 AS explicit, CASE WHEN l_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS release_date,
               CAST(l_discount AS FLOAT) AS af_danceability, CAST(l_tax AS FLOAT) AS af_energy,
               CAST(l_linenumber AS DOUBLE) AS af_key, -l_quantity / 2 AS af_loudness, CAST(l_linenumber % 2 AS DOUBLE) AS af_mode,
               l_extendedprice / 100000 AS af_speechiness, o_totalprice / 1000000 AS af_acousticness,
               (l_suppkey % 10) / 10.0::DOUBLE AS af_instrumentalness, CAST(l_partkey % 13 AS DOUBLE) AS af_liveness,
               CASE WHEN l_orderkey % 23 <> 0 THEN CAST(l_orderkey % 17 AS DOUBLE) END AS af_valence,
               l_quantity * 3 + l_discount * 100 AS af_tempo, CAST(l_linenumber % 3 + 3 AS DOUBLE) AS af_time_signature
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey),
    good AS (SELECT * FROM cells WHERE streams IS NOT NULL),
    top AS (SELECT * FROM good WHERE chart = 'top200'),
    loved AS (
        SELECT region, year(date) AS year, artist, popularity FROM good WHERE date IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY region, year(date) ORDER BY popularity DESC, artist DESC) = 1),
    loved_names AS (
        SELECT region, CAST(year AS INTEGER) AS year, unnest(string_split(artist, ', ')) AS name, popularity FROM loved)
"""


def _profile() -> str:
    sides = [f"round((avg(af_{n}) - min(af_{n})) / (max(af_{n}) - min(af_{n})), 6) AS {n}" for n in charts.PROFILED]
    return f"SELECT region, {', '.join(sides)} FROM good GROUP BY region"


def _correlation() -> str:
    whole = " AND ".join(f"{c} IS NOT NULL" for c in charts.CORRELATED)
    pairs = [f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({a}, {b}), 6) AS correlation FROM kept" for a in charts.CORRELATED for b in charts.CORRELATED]
    return f", kept AS (SELECT * FROM good WHERE popularity <> 0 AND {whole}) " + " UNION ALL ".join(pairs)


_FREQUENT = f"""SELECT artist, round(avg(popularity), 6) AS average_popularity FROM good
                WHERE popularity <> 0 GROUP BY artist HAVING count(*) > {FREQUENT}"""

ORACLES = {
    "chart_batch_clean": _ROWS
    + """SELECT id, title, rank, date, artist, region, chart, streams, popularity, duration_ms, explicit, release_date,
                af_danceability, CAST(CAST(af_valence AS BIGINT) AS VARCHAR) AS af_valence FROM cells""",
    "chart_regional_profile": _ROWS + _profile(),
    "chart_feature_correlation": _ROWS + _correlation(),
    "chart_artist_popularity": _ROWS + _FREQUENT,
    "chart_release_date_gaps": _ROWS
    + """SELECT count(*) FILTER (release_date IS NULL) AS null_rows, count(release_date) AS value_rows,
                round(count(*) FILTER (release_date IS NULL) / count(*), 6) AS null_proportion FROM top""",
    "chart_favourite_artist_means": _ROWS
    + "SELECT region, year, name, round(avg(popularity), 6) AS popularity FROM loved_names GROUP BY ALL",
    "chart_layers": _ROWS
    + f"""SELECT 'bronze' AS layer, count(*) AS n FROM cells
          UNION ALL SELECT 'good', count(*) FROM good
          UNION ALL SELECT 'quarantine', count(*) FROM cells WHERE streams IS NULL
          UNION ALL SELECT 'regional_profile', count(DISTINCT region) FROM good
          UNION ALL SELECT 'feature_correlation', {len(charts.CORRELATED) ** 2}
          UNION ALL SELECT 'artist_popularity', count(*) FROM (
              SELECT artist FROM good WHERE popularity <> 0 GROUP BY artist HAVING count(*) > {charts.FREQUENT})
          UNION ALL SELECT 'release_date_gaps', 1
          UNION ALL SELECT 'release_year_share', count(*) FROM (
              SELECT DISTINCT year(date), year(release_date) FROM top WHERE release_date IS NOT NULL)
          UNION ALL SELECT 'release_year_top3', sum(least(n, 3) + 1)::BIGINT FROM (
              SELECT count(DISTINCT year(release_date)) AS n FROM top WHERE release_date IS NOT NULL GROUP BY year(date))
          UNION ALL SELECT 'favourite_artists', count(*) FROM loved
          UNION ALL SELECT 'favourite_artist_means', count(*) FROM (SELECT DISTINCT region, year, name FROM loved_names)
          UNION ALL SELECT 'yearly_popularity', count(DISTINCT year) FROM loved""",
}
