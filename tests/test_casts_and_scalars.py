from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import casts
from ledgerline.functions import scalars as sc
from ledgerline.functions.search import count_at_or_below
from ledgerline.plans.sensors import LOCATION_FIELDS


def one(spark, expr, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(expr.alias("r")).first()[0]


@pytest.mark.parametrize(
    "text, value",
    [("12", 12), ("12.0", 12), ("-3.9", -3), ("x", None), ("", None), (None, None), (" 7 ", 7), ("9999999999", None)],
)
def test_int_from_text(spark, text, value):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(casts.to_int("t")).first()[0] == value


@pytest.mark.parametrize("text, value", [("True", True), ("false", False), ("1.0", None), ("", None), (None, None)])
def test_bool_from_text(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(casts.to_bool("t")).first()[0] is value


@pytest.mark.parametrize("text, value", [("2020-02-29", date(2020, 2, 29)), ("1999", None), ("2021-02-29", None)])
def test_day_from_text(spark, text, value):
    assert spark.createDataFrame([(text,)], "t string").select(casts.to_day("t")).first()[0] == value


def test_timestamp_text_with_and_without_fraction(spark):
    rows = [("2023-01-01T10:00:00.123456+00:00",), ("2023-01-01T10:00:00+00:00",), ("soon",), (None,)]
    got = spark.createDataFrame(rows, "t string").select(casts.iso_timestamp("t"), casts.exact_timestamp("t")).collect()
    assert [r[0] for r in got] == [datetime(2023, 1, 1, 10, 0, 0, 123456), datetime(2023, 1, 1, 10), None, None]
    assert [r[1] for r in got] == [datetime(2023, 1, 1, 10, 0, 0, 123456), None, None, None]


def test_epoch_of_times_before_1970_rounds_down(spark):
    frame = spark.createDataFrame([("1969-12-31 23:59:59.5",)], "t string")
    assert frame.select(casts.epoch_seconds(F.col("t").cast("timestamp"))).first()[0] == -1


def test_hours_and_energy(spark):
    frame = spark.sql(
        "SELECT timestamp'2023-01-01 00:00:00' a, timestamp'2023-01-01 01:20:00' b, 1000 m, 3456 n, cast(null as int) z"
    )
    got = frame.select(
        sc.hours_between("a", "b"),
        sc.hours_between("b", "a"),
        sc.energy_used(F.col("m"), F.col("n")),
        sc.energy_used(F.col("m"), F.col("n"), "Wh"),
        sc.energy_used(F.col("z"), F.col("n")),
    ).first()
    assert tuple(got) == (1.33, -1.33, 2.46, 2456.0, None)
    with pytest.raises(ValueError):
        sc.energy_used(F.col("m"), F.col("n"), "J")


def test_air_quality_bounds_belong_to_the_lower_class(spark):
    scores = [0, 50, 50.5, 100, 150, 200, 300, 300.1]
    frame = spark.createDataFrame([(float(s),) for s in scores], "s double")
    assert [r[0] for r in frame.select(sc.air_quality_class(F.col("s"))).collect()] == [1, 1, 2, 2, 3, 4, 5, 6]


def test_message_label(spark):
    frame = spark.createDataFrame([("Start", 2), ("Start", 3), ("Start", 4), ("Start", None)], "a string, t int")
    labels = [r[0] for r in frame.select(sc.message_label(F.col("a"), F.col("t"))).collect()]
    assert labels == ["StartRequest", "StartResponse", None, None]


def test_constant_measure_has_no_scaled_mean(spark):
    frame = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (8.0, 5.0), (None, 5.0)], "a double, b double")
    assert tuple(frame.agg(sc.scaled_mean(F.col("a")), sc.scaled_mean(F.col("b"))).first()) == ((4.0 - 1) / 7, None)


@pytest.mark.parametrize("opener, closer", [("(", ")"), ("[(", ")]"), ("", "")])
def test_location_openers_do_not_shift_fields(spark, opener, closer):
    text = opener + "'52.5', '13.4', 'Berlin', 'DE', 'Europe/Berlin'" + closer
    got = one(spark, sc.location_parts(F.col("t"), LOCATION_FIELDS), t=text)
    assert tuple(got) == ("52.5", "13.4", "Berlin", "DE", "Europe/Berlin")


def test_location_skips_short_pieces_and_fills_with_null(spark):
    got = one(spark, sc.location_parts(F.col("t"), LOCATION_FIELDS), t="('52.5', 'x', '13.4')")
    assert tuple(got) == ("52.5", "13.4", None, None, None)


def test_uniform_bits_spread_and_repeat(spark):
    frame = spark.range(4000).select(sc.uniform_bits(F.col("id"), salt="s").alias("b"))
    low, high, mean, distinct = frame.agg(F.min("b"), F.max("b"), F.avg("b"), F.count_distinct("b")).first()
    assert 0 <= low < 2**24 and 2**32 - 2**24 < high < 2**32
    assert abs(mean / 2**32 - 0.5) < 0.03 and distinct > 3990
    assert frame.exceptAll(spark.range(4000).select(sc.uniform_bits(F.col("id"), salt="s").alias("b"))).isEmpty()


def test_binary_search_counts(spark):
    points = [3.0, 3.0, 5.0, 9.0, 12.0]
    values = [None, 1.0, 3.0, 4.0, 5.0, 9.5, 12.0, 99.0]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    counted = count_at_or_below(F.array(*[F.lit(p) for p in points]), F.col("v"), len(points))
    assert [r[0] for r in frame.select(counted).collect()] == [0, 0, 2, 2, 3, 4, 5, 5]


def test_days_are_those_of_the_pattern(spark):
    texts = "2020-02-29 2021-02-29 0000-01-01 0001-01-01 9999-12-31 12020-01-01 +12020-01-01 -2020-01-01 2020-1-1 2020-01-01T00:00:00 unknown epoch".split()
    texts += [" 2020-01-01", "2020-01-01 ", "2020-01-01\n", "", " ", "٢٠٢٠-٠١-٠١", "２０２０-01-01", "2020", "20200101", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    plan = frame.select(casts.to_day("t").alias("d"), F.try_to_date("t", "yyyy-MM-dd").alias("want"), "t")
    assert [(r.t, r.d) for r in plan.select("t", F.col("d").cast("string")).collect()] == [(r.t, r.want) for r in plan.select("t", F.col("want").cast("string")).collect()]
