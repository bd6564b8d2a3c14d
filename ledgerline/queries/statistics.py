"""Aggregate, sort and top-k queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as agg
from ledgerline.operators.ranking import top_rows
from ledgerline.plans import charts
from ledgerline.queries.frames import chart_text
from ledgerline.sources.readers import read_table

MEASURES = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def group_stats(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem")
    return _rounded(agg.group_summary(lines, ["l_returnflag", "l_linestatus"], "l_quantity"), 4, "avg")


def group_count(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem")
    return lines.groupBy("l_suppkey").agg(F.count("l_orderkey").alias("n")).orderBy(F.col("n").desc())


def global_count(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "lineitem").agg(F.count("*").alias("n"))


def round_avg(spark: SparkSession, sf: str) -> DataFrame:
    customer = read_table(spark, sf, "customer")
    return customer.groupBy("c_mktsegment").agg(F.round(F.avg("c_acctbal"), 2).alias("mean"))


def normalized_mean(spark: SparkSession, sf: str) -> DataFrame:
    scaled = agg.scaled_means(read_table(spark, sf, "lineitem"), ["l_returnflag"], MEASURES)
    return _rounded(scaled, 6, *MEASURES)


def argmax_per_group(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = read_table(spark, sf, "orders"), read_table(spark, sf, "customer")
    named = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).withColumn("year", F.year("o_orderdate"))
    return agg.greatest_by(named, ["c_mktsegment", "year"], "o_totalprice", "c_name")


def percent_of_group(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return _rounded(agg.share_of_group(orders, "year", "o_orderpriority"), 6, "percentage")


def top3_and_others(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    return _rounded(agg.top_and_others(orders, "year", "o_orderpriority"), 6, "percentage")


def correlation_pairs(spark: SparkSession, sf: str) -> DataFrame:
    lines = read_table(spark, sf, "lineitem").select(*[F.col(c).alias(n) for n, c in MEASURES.items()])
    return _rounded(agg.correlation_matrix(lines, list(MEASURES)), 6, "correlation")


def null_proportion(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").withColumn("priority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return _rounded(agg.null_share(orders, "priority"), 6, "null_proportion")


def artists_with_volume(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = read_table(spark, sf, "orders"), read_table(spark, sf, "customer")
    named = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    rated = named.select(F.col("c_name").alias("artist"), cents.alias("cents")).where(F.col("cents") != 0)
    return agg.frequent_means(rated, ["artist"], 10, "cents", "mean_cents").orderBy(F.col("mean_cents").desc())


def exploded_mean(spark: SparkSession, sf: str) -> DataFrame:
    part, lines = read_table(spark, sf, "part"), read_table(spark, sf, "lineitem")
    sold = lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return _rounded(agg.exploded_mean(sold, ["p_brand"], "p_name", " ", "l_extendedprice", "mean_price"), 4, "mean_price")


def exploded_mean_by_year(spark: SparkSession, sf: str) -> DataFrame:
    part, lines = read_table(spark, sf, "part"), read_table(spark, sf, "lineitem")
    sold = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).withColumn("year", F.year("l_shipdate"))
    per_name = agg.exploded_mean(sold, ["year"], "p_name", " ", "l_extendedprice", "mean_price")
    return per_name.groupBy("year").agg(F.round(F.avg("mean_price"), 4).alias("overall"))


def distribution_stats(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(agg.distribution(read_table(spark, sf, "orders"), "o_totalprice"), 4, "value")


def histogram(spark: SparkSession, sf: str) -> DataFrame:
    return agg.histogram(read_table(spark, sf, "orders"), "o_totalprice", 0.0, 500000.0, 20)


def distinct_sorted(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select("event_type").distinct().sort("event_type")


def global_sort_topk(spark: SparkSession, sf: str) -> DataFrame:
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return top_rows(orders, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 10)


def global_sort(spark: SparkSession, sf: str) -> DataFrame:
    customer = read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return customer.sort(F.col("c_acctbal").asc(), F.col("c_custkey").asc())


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return charts.with_streams(charts.clean(chart_text(spark, sf)))


def chart_release_year_share(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(charts.release_year_share(_clean(spark, sf)), 6, "percentage")


def chart_release_year_top3(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(charts.release_year_top3(_clean(spark, sf)), 6, "percentage")


def chart_favourite_artists(spark: SparkSession, sf: str) -> DataFrame:
    return charts.favourite_artists(_clean(spark, sf))


def chart_yearly_popularity(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(charts.yearly_popularity(_clean(spark, sf)), 6, "overall_popularity")


QUERIES = {
    f.__name__: f
    for f in (
        group_stats,
        group_count,
        global_count,
        round_avg,
        normalized_mean,
        argmax_per_group,
        percent_of_group,
        top3_and_others,
        correlation_pairs,
        null_proportion,
        artists_with_volume,
        exploded_mean,
        exploded_mean_by_year,
        distribution_stats,
        histogram,
        distinct_sorted,
        global_sort_topk,
        global_sort,
        chart_release_year_share,
        chart_release_year_top3,
        chart_favourite_artists,
        chart_yearly_popularity,
    )
}


def _shares(source: str, group: str, member: str) -> str:
    return f"""
        SELECT {group}, {member}, count(*) AS member_count,
               CAST(sum(count(*)) OVER (PARTITION BY {group}) AS BIGINT) AS group_count
        FROM ({source}) GROUP BY {group}, {member}
    """


def _share_sql(source: str, group: str, member: str) -> str:
    return f"""SELECT *, round(member_count / group_count * 100, 6) AS percentage
               FROM ({_shares(source, group, member)})"""


def _top3_sql(source: str, group: str, member: str) -> str:
    return f"""
        WITH placed AS (
            SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY member_count DESC, {member}) AS place
            FROM ({_shares(source, group, member)}))
        SELECT {group}, CAST({member} AS VARCHAR) AS member,
               round(member_count / group_count * 100, 6) AS percentage FROM placed WHERE place <= 3
        UNION ALL
        SELECT {group}, 'Others', round(sum(CASE WHEN place > 3 THEN member_count ELSE 0 END)
               / max(group_count) * 100, 6) FROM placed GROUP BY {group}
    """


YEARS = "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority FROM orders"

CHART = """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS date_year, c_name AS artist, c_mktsegment AS region,
           CASE WHEN o_orderpriority <> '3-MEDIUM' THEN
                CAST(year(o_orderdate - to_days(CAST(o_custkey AS INTEGER))) AS INTEGER) END AS release_year,
           CAST(floor(o_totalprice / 5000) AS INTEGER) AS popularity, o_orderstatus
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED')
"""
TOP200 = f"SELECT * FROM ({CHART}) WHERE o_orderstatus <> 'O' AND release_year IS NOT NULL"
FAVOURITES = f"""
    SELECT region, date_year AS year, artist, popularity FROM ({CHART})
    QUALIFY row_number() OVER (PARTITION BY region, date_year ORDER BY popularity DESC, artist DESC) = 1
"""
_EXPR = {"quantity": "l_quantity", "price": "l_extendedprice", "discount": "l_discount", "tax": "l_tax"}

ORACLES = {
    "group_stats": """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum, round(avg(l_quantity), 4) AS avg,
                             min(l_quantity) AS min, max(l_quantity) AS max FROM lineitem GROUP BY ALL""",
    "group_count": "SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY l_suppkey ORDER BY n DESC",
    "global_count": "SELECT count(*) AS n FROM lineitem",
    "round_avg": "SELECT c_mktsegment, round(avg(c_acctbal), 2) AS mean FROM customer GROUP BY c_mktsegment",
    "normalized_mean": "SELECT l_returnflag, "
    + ", ".join(f"round((avg({c}) - min({c})) / (max({c}) - min({c})), 6) AS {n}" for n, c in _EXPR.items())
    + " FROM lineitem GROUP BY l_returnflag",
    "argmax_per_group": """
        SELECT c_mktsegment, CAST(year(o_orderdate) AS INTEGER) AS year, c_name, o_totalprice
        FROM orders JOIN customer ON o_custkey = c_custkey
        QUALIFY row_number() OVER (PARTITION BY c_mktsegment, year(o_orderdate)
                                   ORDER BY o_totalprice DESC, c_name DESC) = 1""",
    "percent_of_group": _share_sql(YEARS, "year", "o_orderpriority"),
    "top3_and_others": _top3_sql(YEARS, "year", "o_orderpriority"),
    "correlation_pairs": " UNION ALL ".join(
        f"SELECT '{a}' AS left_column, '{b}' AS right_column, round(corr({x}, {y}), 6) AS correlation FROM lineitem"
        for a, x in _EXPR.items()
        for b, y in _EXPR.items()
    ),
    "null_proportion": """
        SELECT count(*) FILTER (o_orderpriority = '5-LOW') AS null_rows,
               count(*) FILTER (o_orderpriority <> '5-LOW') AS value_rows,
               round(count(*) FILTER (o_orderpriority = '5-LOW') / count(*), 6) AS null_proportion FROM orders""",
    "artists_with_volume": """
        SELECT c_name AS artist, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS mean_cents
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_totalprice <> 0 GROUP BY c_name HAVING count(*) > 10 ORDER BY mean_cents DESC""",
    "exploded_mean": """
        SELECT p_brand, name, round(avg(l_extendedprice), 4) AS mean_price FROM (
            SELECT p_brand, unnest(string_split(p_name, ' ')) AS name, l_extendedprice
            FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY p_brand, name""",
    "exploded_mean_by_year": """
        SELECT year, round(avg(mean_price), 4) AS overall FROM (
            SELECT year, name, avg(l_extendedprice) AS mean_price FROM (
                SELECT CAST(year(l_shipdate) AS INTEGER) AS year, unnest(string_split(p_name, ' ')) AS name,
                       l_extendedprice
                FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY year, name) GROUP BY year""",
    "distribution_stats": """
        WITH s AS (SELECT CAST(count(*) AS DOUBLE) AS count, avg(o_totalprice) AS mean, min(o_totalprice) AS low,
                          max(o_totalprice) AS high, max(o_totalprice) - min(o_totalprice) AS range,
                          quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
                          quantile_cont(o_totalprice, 0.75) AS q3 FROM orders)
        SELECT statistic, round(value, 4) AS value FROM s
        UNPIVOT (value FOR statistic IN (count, mean, low, high, range, q1, median, q3))""",
    "histogram": """SELECT least(CAST(floor(20 * (o_totalprice - 0.0) / (500000.0 - 0.0)) AS BIGINT) + 1, 21) AS bin,
                           count(*) AS n, 0.0 + (bin - 1) * CAST(25000 AS DOUBLE) AS bin_from
                    FROM orders GROUP BY 1""",
    "distinct_sorted": "SELECT DISTINCT event_type FROM events ORDER BY event_type",
    "global_sort_topk": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
                           ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "global_sort": "SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal, c_custkey",
    "chart_release_year_share": _share_sql(TOP200, "date_year", "release_year"),
    "chart_release_year_top3": _top3_sql(TOP200, "date_year", "release_year"),
    "chart_favourite_artists": FAVOURITES,
    "chart_yearly_popularity": f"""
        SELECT year, round(avg(m), 6) AS overall_popularity FROM (
            SELECT year, name, avg(popularity) AS m FROM (
                SELECT year, popularity, unnest(string_split(artist, ', ')) AS name FROM ({FAVOURITES}))
            GROUP BY year, name) GROUP BY year""",
}
