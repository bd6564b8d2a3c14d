"""Every sliced plan must give what the plain window gives."""

import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import windows as win
from ledgerline.operators.skew import HotKeyPolicy, cut_hot_keys, enrich, find_hot_keys
from tests.conftest import explained

SMALL = HotKeyPolicy(share=1 / 64, sample_per_slice=10)
PLAIN = HotKeyPolicy(share=1.0)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 'hot' has over a third of the rows, NULL keys and NULL values occur, values repeat a lot."""
    rnd = random.Random(5)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else (None if i % 3 == 1 and i % 4 == 0 else f"k{rnd.randrange(40)}")
        grade = None if rnd.random() < 0.02 else rnd.choice(["a", "b", "b", "b", "b", "b", "c", "d"])
        value = None if rnd.random() < 0.1 else float(rnd.randrange(1000))
        rows.append((i, key, rnd.randrange(10**6) * 7 + i % 7, grade, value))
    frame = spark.createDataFrame(rows, "id long, k string, t long, grade string, v double").repartition(5)
    frame = frame.checkpoint()
    return frame


def same(a, b):
    def rows(df):
        return sorted(
            [tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()],
            key=repr,
        )

    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a.select(sorted(a.columns))) == rows(b.select(sorted(b.columns)))


def test_finds_hot_keys_and_cuts_them(skewed):
    hot, _ = find_hot_keys(skewed, ["k"], SMALL)
    assert 2 <= len(hot) <= 64
    cuts = cut_hot_keys(skewed, ["k"], ["grade", "id"], SMALL)
    sliced = cuts.slice_of(skewed)
    largest = sliced.groupBy("k", "_slice").count().where("_slice > 0").agg(F.max("count")).first()[0]
    assert largest < 250
    assert sliced.count() == skewed.count()
    assert cut_hot_keys(skewed, ["k"], ["t"], PLAIN) is None


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("tiles", [2, 7])
def test_ranks(skewed, descending, tiles):
    args = (["k"], ["grade"], ["id"])
    same(
        win.rank_rows(skewed, *args, tiles=tiles, descending=descending, policy=SMALL),
        win.rank_rows(skewed, *args, tiles=tiles, descending=descending, policy=PLAIN),
    )


def test_shift(skewed):
    shifts = {"p1": ("v", 1), "p2": ("id", 2, 0), "n1": ("v", -1), "n3": ("grade", -3)}
    same(
        win.shift_columns(skewed, ["k"], ["t", "id"], shifts, SMALL),
        win.shift_columns(skewed, ["k"], ["t", "id"], shifts, PLAIN),
    )


def test_shift_with_slices_smaller_than_reach(skewed):
    tiny = HotKeyPolicy(share=1 / 2000, sample_per_slice=10)
    shifts = {"p5": ("id", 5), "n4": ("id", -4)}
    same(
        win.shift_columns(skewed, ["k"], ["t", "id"], shifts, tiny),
        win.shift_columns(skewed, ["k"], ["t", "id"], shifts, PLAIN),
    )


def test_rolling_mean(skewed):
    args = (["k"], ["t", "id"], "v", 1, 1, "m")
    same(win.rolling_mean(skewed, *args, policy=SMALL), win.rolling_mean(skewed, *args, policy=PLAIN))


def test_running_total_shares_peers(skewed):
    for order, tie in ((["grade"], ["id"]), (["t", "id"], [])):
        args = (["k"], order, tie, "v", "total")
        same(win.running_total(skewed, *args, policy=SMALL), win.running_total(skewed, *args, policy=PLAIN))


def test_partition_stats(skewed):
    aggs = {"s": F.sum("v"), "a": F.avg("v"), "lo": F.min("v"), "hi": F.max("v")}
    same(win.partition_stats(skewed, ["k"], aggs, SMALL), win.partition_stats(skewed, ["k"], aggs, PLAIN))


def test_dense_index(skewed):
    a = win.dense_index(skewed, ["t", "id"], "n", start=10000, policy=SMALL)
    same(a, win.dense_index(skewed, ["t", "id"], "n", start=10000, policy=PLAIN))
    assert a.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()[0:] == (10000, 12999, 3000)


def test_idle_time(skewed):
    rows = skewed.dropDuplicates(["k", "t"])
    args = ("k", "t", F.col("v") > 400, "hours")
    same(win.idle_time(rows, *args, policy=SMALL), win.idle_time(rows, *args, policy=PLAIN))


def test_enrich(skewed):
    facts = skewed.where("k is not null and k <> 'k3'").groupBy("k").agg(F.count("*").alias("n"))
    for how in ("left", "inner"):
        same(enrich(skewed, facts, ["k"], how), skewed.join(facts, "k", how))
    same(enrich(skewed, facts.select("k"), ["k"], "left_semi"), skewed.join(facts.select("k"), "k", "left_semi"))


def test_enrich_shuffles_both_sides_by_the_spread_key(spark, skewed):
    # Only then adaptive execution can split a hot key, and NULL keys do not meet in one task.
    facts = skewed.groupBy("k").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        text = explained(enrich(skewed, facts, ["k"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"hashpartitioning\(k#\d+, _spread#\d+", text)) == 2


@pytest.mark.parametrize("kind", ["decimal(10,2)", "int", "bigint", "float", "double"])
def test_both_plans_have_one_result_type(skewed, kind):
    rows = skewed.withColumn("v", F.col("v").cast(kind))
    mean, total = (["k"], ["t", "id"], "v", 1, 1, "out"), (["k"], ["grade"], ["id"], "v", "out")
    for call, args in ((win.rolling_mean, mean), (win.running_total, total)):
        sliced, plain = call(rows, *args, policy=SMALL), call(rows, *args, policy=PLAIN)
        assert sliced.schema["out"].dataType == plain.schema["out"].dataType
        same(sliced, plain)


def test_islands(skewed):
    rows = skewed.dropDuplicates(["k", "t"])
    same(*[win.state_islands(rows, "k", "t", F.col("v") > 400, policy) for policy in (SMALL, PLAIN)])


def test_a_key_is_hot_above_what_a_task_sorts(spark):
    rows = spark.range(4000).withColumn("k", F.when(F.col("id") < 60, 0).otherwise(F.col("id"))).checkpoint()
    small = HotKeyPolicy(share=50 / 4000)
    assert len(find_hot_keys(rows, ["k"], small)[0]) == 1
    assert cut_hot_keys(rows, [], ["id"], small).count >= 40
    assert HotKeyPolicy(task_rows=50).limit(4000) == 50 and HotKeyPolicy(task_rows=50).limit(10**9) == 10**9 / 16384
    # Files of a few kilobytes hold no hot key, which takes no job to know.
    assert find_hot_keys(rows, ["k"])[0] == []


def test_shift_and_mean_broadcast_no_edges(skewed):
    """Copies of rows beside a slice travel with its rows; only the links of the slices are broadcast."""
    for frame in (
        win.shift_columns(skewed, ["k"], ["t", "id"], {"far": ("v", 40)}, SMALL),
        win.rolling_mean(skewed, ["k"], ["t", "id"], "v", 40, 3, "m", policy=SMALL),
    ):
        text = explained(frame)
        assert "_shift_" not in text and text.count("Window [") <= 4
    same(
        win.rolling_mean(skewed, ["k"], ["t", "id"], "v", 40, 3, "m", policy=SMALL),
        win.rolling_mean(skewed, ["k"], ["t", "id"], "v", 40, 3, "m", policy=PLAIN),
    )
    same(
        win.shift_columns(skewed, ["k"], ["t", "id"], {"far": ("v", 90, -1.0), "ahead": ("id", -75)}, SMALL),
        win.shift_columns(skewed, ["k"], ["t", "id"], {"far": ("v", 90, -1.0), "ahead": ("id", -75)}, PLAIN),
    )


def test_idle_time_with_readings_sent_again(skewed):
    rows = skewed.dropDuplicates(["k", "t"]).select("k", "t", "v")
    again = rows.unionByName(rows.where("t % 3 = 0"))
    args = ("k", "t", F.col("v") > 400, "hours")
    same(win.idle_time(again, *args, policy=SMALL), win.idle_time(rows, *args, policy=PLAIN))


def test_keys_are_made_for_sampled_rows_only(spark, skewed):
    """Keys given as columns of a rawer frame find the same cuts; only sampled rows meet the function that makes them."""
    raw = skewed.select(F.to_json(F.struct("k")).alias("body"))
    key = F.from_json("body", "k string")["k"]
    want, got = find_hot_keys(skewed, ["k"], SMALL), find_hot_keys(raw, [key], SMALL)
    assert set(got[0]) == set(want[0]) and got[1] == want[1]
    cuts = [cut_hot_keys(skewed, ["k"], ["grade", "id"], SMALL, hot_from) for hot_from in (None, (raw, [key]))]
    assert cuts[0].hot == cuts[1].hot and cuts[0].count == cuts[1].count
    # About a fifth of the 3,000 rows is drawn.
    made = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda k: made.add(1) or k, "string")
    find_hot_keys(skewed, [counted("k")], SMALL)
    assert 0 < made.value < 1500
