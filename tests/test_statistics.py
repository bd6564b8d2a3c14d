import math

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import aggregates as agg
from ledgerline.operators import windows as win
from ledgerline.operators.skew import HotKeyPolicy
from ledgerline.operators.ranking import emissions_ranking, top_rows
from ledgerline.plans import charts
from ledgerline.queries import chart_layers



@pytest.fixture(scope="module")
def demo(spark):
    """Ties in grade and in step."""
    rows = [("p", 1, 1), ("p", 2, 1), ("p", 3, 2), ("p", 4, 3), ("q", 5, 7), ("q", 6, 7), ("q", 7, 9), ("r", 8, None)]
    return spark.createDataFrame(rows, "k string, id int, grade int")


def test_rank_functions_on_ties(demo):
    ranked = win.rank_rows(demo, ["k"], ["grade"], ["id"])
    rows = [tuple(r)[3:] for r in ranked.orderBy("id").collect()]
    assert rows == [
        (1, 1, 1, 0.0, 1),
        (2, 1, 1, 0.0, 1),
        (3, 3, 2, 2 / 3, 2),
        (4, 4, 3, 1.0, 2),
        (1, 1, 1, 0.0, 1),
        (2, 1, 1, 0.0, 1),
        (3, 3, 2, 1.0, 2),
        (1, 1, 1, 0.0, 1),
    ]


def test_running_total_shares_peers_and_rolling_mean_does_not(demo):
    total = win.running_total(demo, ["k"], ["grade"], ["id"], "id", "t").orderBy("id")
    assert [r.t for r in total.collect()] == [3, 3, 6, 10, 11, 11, 18, 8]
    mean = win.rolling_mean(demo, ["k"], ["id"], "grade", 1, 1, "m").orderBy("id")
    assert [r.m for r in mean.collect()] == [1.0, 4 / 3, 2.0, 2.5, 7.0, 23 / 3, 8.0, None]


def test_shift_off_the_edge(demo):
    got = win.shift_columns(demo, ["k"], ["id"], {"a": ("id", 1), "b": ("id", 2, 0), "c": ("grade", -1)}).orderBy("id")
    assert [(r.a, r.b, r.c) for r in got.collect()][:5] == [(None, 0, 1), (1, 0, 2), (2, 1, 3), (3, 2, None), (None, 0, 7)]


def test_islands(spark):
    values = [0, 0, 5, 5, 0, 3, 0, 0]
    frame = spark.createDataFrame([("k", i * 60, v) for i, v in enumerate(values)] + [("z", 0, 4)], "k string, s long, v int")
    frame = frame.withColumn("ts", F.timestamp_seconds("s"))
    islands = win.state_islands(frame, "k", "ts", F.col("v") > 0)
    got = [tuple(r) for r in islands.where("k = 'k'").orderBy("island").select("island", "state", "readings").collect()]
    assert got == [(0, 0, 2), (1, 1, 2), (2, 0, 1), (3, 1, 1), (4, 0, 2)]
    idle = win.idle_time(frame, "k", "ts", F.col("v") > 0, "h").collect()
    assert [tuple(r) for r in idle] == [("k", 0.03)]


def test_idle_time_equals_islands(spark, sf):
    from ledgerline.sources.readers import read_table

    events = read_table(spark, sf, "events")
    busy = F.col("value") > 50
    seconds = F.unix_seconds("last_ts") - F.unix_seconds("first_ts")
    by_islands = (
        win.state_islands(events, "user_id", "ts", busy)
        .where("state = 0")
        .groupBy("user_id")
        .agg(F.round(F.sum(seconds) / 3600.0, 2).alias("h"))
    )
    direct = win.idle_time(events, "user_id", "ts", busy, "h", HotKeyPolicy(share=1 / 32, sample_per_slice=10))
    assert direct.exceptAll(by_islands).isEmpty() and by_islands.exceptAll(direct).isEmpty()


def test_argmax_ties_and_nulls(spark):
    rows = [("r", 5, "a"), ("r", 5, "b"), ("r", None, "z"), ("s", None, "x"), ("s", None, "y")]
    got = agg.greatest_by(spark.createDataFrame(rows, "g string, p int, a string"), ["g"], "p", "a")
    assert {tuple(r) for r in got.collect()} == {("r", "b", 5), ("s", "y", None)}


def test_shares_top_and_others(spark):
    rows = [("g", m) for m, n in dict(a=5, b=4, c=4, d=2, e=1).items() for _ in range(n)] + [("h", "a"), ("h", None)]
    frame = spark.createDataFrame(rows, "g string, m string")
    top = {(r.g, r.member): r.percentage for r in agg.top_and_others(frame, "g", "m").collect()}
    assert top == {
        ("g", "a"): 31.25, ("g", "b"): 25.0, ("g", "c"): 25.0, ("g", "Others"): 18.75,
        ("h", "a"): 50.0, ("h", None): 50.0, ("h", "Others"): 0.0,
    }
    share = {(r.g, r.m): (r.member_count, r.group_count) for r in agg.share_of_group(frame, "g", "m").collect()}
    assert share[("g", "a")] == (5, 16) and share[("h", None)] == (1, 2)


def test_null_share(spark):
    frame = spark.createDataFrame([(1,), (None,), (3,), (None,)], "a int")
    assert tuple(agg.null_share(frame, "a").first()) == (2, 2, 0.5)
    assert tuple(agg.null_share(frame.where("a > 9"), "a").first()) == (0, 0, None)


def test_correlation_skips_rows_with_nulls(spark):
    rows = [(1.0, 2.0, 3.0), (2.0, 4.0, 1.0), (3.0, 6.0, 2.0), (9.0, None, 0.0)]
    got = {(r[0], r[1]): r[2] for r in agg.correlation_matrix(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    assert len(got) == 9 and math.isclose(got[("a", "b")], 1.0) and math.isclose(got[("c", "a")], -0.5)
    assert got[("a", "c")] == got[("c", "a")] and math.isclose(got[("c", "c")], 1.0)


@pytest.mark.parametrize("accuracy", [10_000, 20])
@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], [5.0] * 50 + [1.0] * 20 + [9.0], [float(i * 37 % 101) for i in range(101)], [None, 2.0, 8.0, None]])
def test_exact_quantiles(spark, values, accuracy):
    import numpy as np

    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = agg.exact_quantiles(frame, "v", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}, accuracy).first()
    want = np.quantile([v for v in values if v is not None], [0, 0.25, 0.5, 0.9, 1])
    assert np.allclose(list(got), want)


def test_quantiles_of_nothing(spark):
    got = agg.exact_quantiles(spark.createDataFrame([(None,)], "v double"), "v", {"m": 0.5}).first()
    assert got[0] is None


def test_histogram_edges(spark):
    frame = spark.createDataFrame([(v,) for v in (-1.0, 0.0, 0.5, 1.0, 9.99, 10.0, None)], "v double")
    got = {r.bin: (r.n, r.bin_from) for r in agg.histogram(frame, "v", 0, 10, 10).collect()}
    assert got == {0: (1, -1.0), 1: (2, 0.0), 2: (1, 1.0), 10: (1, 9.0), 11: (1, 10.0)}


def test_keep_frequent(spark):
    frame = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 5, "k string")
    assert [r[0] for r in agg.keep_frequent(frame, ["k"], 2).collect()] == ["a"] * 3


def test_means_of_frequent_keys(spark):
    frame = spark.createDataFrame([("a", 1)] * 2 + [("a", 4), ("b", 1), ("b", 2)] + [(None, 7)] * 5, "k string, v int")
    assert [tuple(r) for r in agg.frequent_means(frame, ["k"], 2, "v", "m").collect()] == [("a", 2.0)]


def test_quantiles_of_many_rows_look_into_brackets_only(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    values = np.concatenate([np.round(rng.normal(size=30_000), 2), np.full(9_000, 0.25), [float("inf")] * 3, [-1e300]])
    frame = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(6)
    wanted = {"a": 0.001, "b": 0.25, "c": 0.5, "d": 0.9, "e": 0.9999}
    got = agg.exact_quantiles(frame, "v", wanted, 500).first()
    assert np.allclose(list(got), np.quantile(values, list(wanted.values())))
    with_nan = frame.union(spark.createDataFrame([(float("nan"),)] * 20_000, "v double"))
    got = agg.exact_quantiles(with_nan, "v", {"m": 0.5, "n": 0.99}, 500).first()
    assert got["m"] == np.sort(values)[29501:29503].mean() and np.isnan(got["n"])


def test_distribution_takes_two_passes(spark):
    frame = spark.range(1001).select(F.col("id").cast("double").alias("v"))
    got = dict(agg.distribution(frame, "v").collect())
    assert got == {"count": 1001.0, "mean": 500.0, "low": 0.0, "high": 1000.0, "range": 1000.0, "q1": 250.0, "median": 500.0, "q3": 750.0}


def test_top_rows_plan_keeps_n_per_task(demo):
    top = top_rows(demo, [F.col("grade").desc_nulls_last(), F.col("id")], 2)
    assert [r.id for r in top.collect()] == [7, 5]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().toString()


def test_emissions_ranking(spark):
    rows = [(1990, 5.0, 20.1, "x"), (1991, 7.0, 20.3, "x"), (1992, 6.0, 20.2, "x")]
    frame = spark.createDataFrame(rows, "Year int, TotalEmissions double, LandMaxTemperature double, other string")
    assert [r.Year for r in emissions_ranking(frame).collect()] == [1991, 1992, 1990]
    assert emissions_ranking(frame, 1).columns == ["Year", "TotalEmissions", "LandMaxTemperature"]


def chart_rows(spark):
    base = {c: None for c in charts.RAW_COLUMNS}
    rows = []
    for i, (artist, popularity, streams, region, day, released, danceability) in enumerate(
        [
            ("Ann, Bob", "80", "10", "DE", "2020-01-01", "2019-05-01", "0.5"),
            ("Ann", "90.0", "20", "DE", "2020-02-01", "2020-01-01", "0.7"),
            ("Cat", "70", "", "DE", "2020-02-01", "2018", "0.9"),
            ("Bob", "0", "5", "FR", "2021-02-01", "2020-01-01", "bad"),
            ("Bob", "60", "7", "FR", "2021-03-01", None, "0.2"),
            ("Dan, Ann", "60", "8", "FR", "2021-03-01", "2020-03-03", "0.4"),
        ]
    ):
        row = dict(base, id=str(i), artist=artist, popularity=popularity, streams=streams, region=region, date=day,
                   release_date=released, af_danceability=danceability, chart="top200", explicit="True", rank=str(i + 1))
        for c in charts.CORRELATED:
            row[c] = row[c] or str(1 + i * i % 5)
        rows.append(tuple(row[c] for c in charts.RAW_COLUMNS))
    return spark.createDataFrame(rows, charts.RAW_SCHEMA)


def test_chart_layers(spark, tmp_path):
    gold = charts.build_layers(chart_rows(spark), str(tmp_path))
    quarantine = spark.read.parquet(f"{tmp_path}/checked/quality=quarantine")
    assert [r.artist for r in quarantine.collect()] == ["Cat"]
    assert not {"url", "available_markets", "Unnamed0"} & set(quarantine.columns)
    favourites = {(r.region, r.year): (r.artist, r.popularity) for r in gold["favourite_artists"].collect()}
    assert favourites == {("DE", 2020): ("Ann", 90), ("FR", 2021): ("Dan, Ann", 60)}
    means = {(r.region, r.name): r.popularity for r in gold["favourite_artist_means"].collect()}
    assert means == {("DE", "Ann"): 90.0, ("FR", "Dan"): 60.0, ("FR", "Ann"): 60.0}
    assert {r.year: r.overall_popularity for r in gold["yearly_popularity"].collect()} == {2020: 90.0, 2021: 60.0}
    assert tuple(gold["release_date_gaps"].first()) == (1, 4, 0.2)
    assert {(r.date_year, r.release_year): r.percentage for r in gold["release_year_share"].collect()} == {
        (2020, 2019): 50.0, (2020, 2020): 50.0, (2021, 2020): 100.0,
    }
    profile = {r.region: r.danceability for r in gold["regional_profile"].collect()}
    assert math.isclose(profile["DE"], 0.5, rel_tol=1e-6) and math.isclose(profile["FR"], 0.5, rel_tol=1e-6)
    assert gold["feature_correlation"].count() == 169
    assert gold["artist_popularity"].count() == 0
    silver = spark.read.parquet(f"{tmp_path}/checked/quality=good")
    liked = charts.artist_popularity(silver, 0).collect()
    assert [r.artist for r in liked][0] == "Ann" and "Cat" not in [r.artist for r in liked]


def test_correlation_is_plain_sums(spark):
    """Far from zero, with a constant, one row and no row; the second pass has a sum for each pair, which Spark compiles."""
    rows = [(1e9 + i, float(i * i % 7), float(i % 5), 0.1) for i in range(50)] + [(None, 1.0, 2.0, 3.0), (1.0, float("nan"), 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, d double")
    got = agg.correlation_matrix(frame, ["a", "b", "c"])
    assert "corr(" not in got._jdf.queryExecution().executedPlan().toString()
    whole = frame.select("a", "b", "c").dropna()
    want = {(x, y): whole.agg(F.corr(x, y)).first()[0] for x in "abc" for y in "abc"}
    have = {(r.left_column, r.right_column): r.correlation for r in got.collect()}
    assert have.keys() == want.keys() and all(math.isclose(have[k], want[k], abs_tol=1e-9) for k in want)
    for few in (0, 1):
        assert {r.correlation for r in agg.correlation_matrix(frame.limit(few), ["a", "b", "c"]).collect()} == {None}
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        constant = agg.correlation_matrix(frame.where("a > 1"), ["c", "d"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", ansi)
    assert {(r.left_column, r.right_column): r.correlation for r in constant} == {("c", "c"): 1.0, ("c", "d"): None, ("d", "c"): None, ("d", "d"): None}


def test_chart_files_are_small_and_lines_are_shuffled_once(spark, sf, monkeypatch):
    monkeypatch.setattr(chart_layers, "FILE_ROWS", 500)
    plans = []
    write = chart_layers.write_csv
    monkeypatch.setattr(chart_layers, "write_csv", lambda df, *a, **k: (plans.append(df), write(df, *a, **k)))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        files = chart_layers.chart_files(spark, sf)
        plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # A wide row of a line has its price: it passes one exchange only.
    assert [line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line] and not [
        line for line in plan.splitlines() if "Exchange hashpartitioning(o_custkey" in line and "l_" in line
    ]
    assert plan.count("Exchange hashpartitioning") == 4
    names = files.inputFiles()
    assert all(n.endswith(".csv.gz") for n in names)
    assert max(r["count"] for r in files.groupBy(F.input_file_name()).count().collect()) <= 500
