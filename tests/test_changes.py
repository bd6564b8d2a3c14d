import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import changes as ch
from ledgerline.operators import layout, privacy
from ledgerline.plans import sensors, users
from tests.conftest import partition_filters


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, None, 30), (4, "d", 40)], "id int, name string, n int")


def test_update_and_delete_treat_null_as_no_match(table):
    got = ch.update_where(table, F.col("n") > 15, {"n": F.lit(0), "name": F.concat("name", F.col("n").cast("string"))})
    assert rows(got) == [(1, "a", 10), (2, "b", None), (3, None, 0), (4, "d40", 0)]
    assert rows(ch.delete_where(table, F.col("n") > 15)) == [(1, "a", 10), (2, "b", None)]
    assert ch.delete_where(table).count() == 0


def test_merge(spark, table):
    source = spark.createDataFrame([("x", 2, 22), ("new", 9, None), (None, 1, None)], "name string, id int, n int")
    merged = ch.merge_upsert(table, source, ["id"])
    assert rows(merged) == sorted([(1, None, None), (2, "x", 22), (3, None, 30), (4, "d", 40), (9, "new", None)], key=repr)
    assert rows(ch.merge_upsert(merged, source, ["id"])) == rows(merged)
    assert rows(ch.merge_upsert(table, source, ["id"], "delete", "skip")) == [(3, None, 30), (4, "d", 40)]
    assert ch.merge_upsert(table, source, ["id"], "keep").count() == 5
    with pytest.raises(ValueError):
        ch.merge_upsert(table, source, ["id"], "replace")


def test_merge_null_keys_never_match(spark):
    target = spark.createDataFrame([(None, 1), (1, 1)], "id int, n int")
    source = spark.createDataFrame([(None, 2)], "id int, n int")
    assert rows(ch.merge_upsert(target, source, ["id"])) == sorted([(None, 1), (None, 2), (1, 1)], key=repr)


def test_merge_rejects_two_rows_for_one_target(spark, table):
    twice = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "id int, name string, n int")
    with pytest.raises(ch.AmbiguousMerge):
        ch.merge_upsert(table, twice, ["id"])
    unmatched = spark.createDataFrame([(8, "x", 1), (8, "y", 2)], "id int, name string, n int")
    assert ch.merge_upsert(table, unmatched, ["id"]).count() == 6


def test_merge_keeps_copies_of_a_target_key(spark):
    target = spark.createDataFrame([(1, "a")] * 100 + [(2, "b")], "id int, name string")
    got = ch.merge_upsert(target, spark.createDataFrame([(1, "z")], "id int, name string"), ["id"])
    assert rows(got.groupBy("name").count()) == [("b", 1), ("z", 100)]


def test_checks(table):
    assert ch.enforce_check(table, "id", F.col("id").isNotNull()) is table
    with pytest.raises(ch.CheckViolation, match="positive"):
        ch.enforce_check(table, "positive", F.col("n") < 40)
    assert rows(ch.violations(table, F.col("n") > 5)) == []
    assert rows(ch.violations(table, F.col("n") > 5, null_passes=False)) == [(2, "b", None)]


@pytest.fixture(scope="module")
def versions(spark, tmp_path_factory):
    """A log of random changes, and the table after each version as a dict."""
    rnd = random.Random(3)
    path = str(tmp_path_factory.mktemp("log") / "t")
    state, states = {}, []
    for version in range(6):
        changes = []
        for key in range(12):
            roll = rnd.random()
            if key not in state and roll < 0.6:
                state[key] = rnd.choice([None, 1, 2])
                changes.append((key, state[key], "insert"))
            elif key in state and roll < 0.3:
                changes.append((key, state.pop(key), "delete"))
            elif key in state and roll < 0.7:
                state[key] = rnd.choice([None, 1, 2])
                changes.append((key, state[key], "update"))
        frame = spark.createDataFrame(changes, "k int, v int, _op string")
        stamped = ch.stamped(frame, F.col("_op"), version, f"2024-01-0{version + 1} 00:00:00")
        ch.commit(stamped, path, version)
        ch.commit(stamped, path, version)  # a repeated commit changes nothing
        states.append(dict(state))
    return ch.read_log(spark, path), states


class TestLog:
    def test_as_of(self, versions):
        log, states = versions
        for version, state in enumerate(states):
            assert rows(ch.as_of(log, ["k"], version=version)) == sorted(state.items(), key=repr)
            assert rows(ch.as_of(log, ["k"], ts=f"2024-01-0{version + 1} 13:00:00")) == sorted(state.items(), key=repr)
        assert rows(ch.as_of(log, ["k"])) == sorted(states[-1].items(), key=repr)

    def test_diff_both_ways(self, versions):
        log, states = versions
        for old, new in ((0, 5), (2, 3), (4, 1), (3, 3)):
            want = []
            for key in set(states[old]) | set(states[new]):
                if key not in states[old]:
                    want.append((key, states[new][key], "insert"))
                elif key not in states[new]:
                    want.append((key, states[old][key], "delete"))
                elif states[old][key] != states[new][key]:
                    want.append((key, states[new][key], "update"))
            assert rows(ch.table_diff(log, ["k"], old, new)) == sorted(want, key=repr)

    def test_restore(self, versions):
        log, states = versions
        for target in (0, 3, 5):
            back = log.unionByName(ch.restore_changes(log, ["k"], target, 5, "2024-02-01 00:00:00"))
            assert rows(ch.as_of(back, ["k"])) == sorted(states[target].items(), key=repr)
            assert rows(ch.as_of(back, ["k"], version=5)) == sorted(states[5].items(), key=repr)

    def test_prune_keeps_later_states(self, versions):
        log, states = versions
        kept = ch.prune(log, ["k"], "2024-01-03 12:00:00")
        assert kept.count() < log.count()
        for version in (3, 4, 5):
            assert rows(ch.as_of(kept, ["k"], version=version)) == sorted(states[version].items(), key=repr)
        assert rows(ch.as_of(kept, ["k"], version=2)) == sorted(states[2].items(), key=repr)

    def test_history(self, versions):
        log, _ = versions
        got = ch.history(log).orderBy("_version").collect()
        assert [r._version for r in got] == list(range(6))
        assert sum(r.inserted + r.updated + r.deleted for r in got) == log.count()

    def test_reading_a_version_skips_later_folders(self, versions):
        log, _ = versions
        assert "_version#" in partition_filters(ch.as_of(log, ["k"], version=2))


def test_changes_of_update_delete_merge(spark, table):
    first = ch.stamped(table, ch.INSERT, 0, "2024-01-01 00:00:00")
    second = ch.update_changes(table, F.col("n") > 15, {"n": F.lit(0)}, 1, "2024-01-02 00:00:00")
    assert rows(second.select("id", "n", "_op")) == [(3, 0, "update"), (4, 0, "update")]
    source = spark.createDataFrame([(1, "m", 1), (7, "new", 7)], "id int, name string, n int")
    third = ch.merge_changes(table, source, ["id"], 2, "2024-01-03 00:00:00")
    fourth = ch.delete_changes(table, F.col("name") == "b", 3, "2024-01-04 00:00:00")
    log = first.unionByName(second).unionByName(third).unionByName(fourth)
    assert rows(ch.as_of(log, ["id"])) == sorted([(1, "m", 1), (3, None, 0), (4, "d", 0), (7, "new", 7)], key=repr)


def test_identity(table):
    got = ch.assign_identity(table, ["id"], "key")
    assert [r.key for r in got.orderBy("id").collect()] == [10000, 10001, 10002, 10003]
    assert ch.next_identity(got, "key") == 10004 and ch.next_identity(got.where("id > 9"), "key") == 10000


def test_generated_column_prunes(spark, table, tmp_path):
    generated = {"tens": F.floor(F.col("n") / 20)}
    ch.with_generated(table.na.fill(0), generated).write.partitionBy("tens").parquet(str(tmp_path / "g"))
    back = spark.read.parquet(str(tmp_path / "g"))
    got = ch.generated_equals(back, generated, F.col("n") == 30, {"tens": F.lit(1)})
    assert [r.id for r in got.collect()] == [3]
    assert "tens#" in partition_filters(got)


def test_clustering_keeps_rows_and_narrows_files(spark):
    df = spark.range(20_000).select(
        (F.col("id") * 7919 % 20_000).alias("a"), (F.col("id") * 104_729 % 20_000).alias("b"), F.lit("same").alias("c")
    )
    got = layout.cluster_layout(df, ["a", "b"], 16)
    assert got.exceptAll(df).isEmpty() and got.count() == df.count()
    width = (
        got.withColumn("p", F.spark_partition_id()).groupBy("p").agg((F.max("a") - F.min("a")).alias("a"), (F.max("b") - F.min("b")).alias("b"))
    )
    wide = width.agg(F.avg("a"), F.avg("b"), F.count("*")).first()
    assert wide[0] < 13_000 and wide[1] < 13_000 and wide[2] == 16


def test_clustering_spreads_equal_rows(spark):
    df = spark.range(8000).select(F.when(F.col("id") < 6000, "hot").otherwise(F.col("id").cast("string")).alias("s"), "id")
    sizes = layout.cluster_layout(df, ["s"], 8).groupBy(F.spark_partition_id()).count()
    assert sizes.agg(F.max("count")).first()[0] < 2500


@pytest.mark.parametrize("prefix", ["", "https://example.org/a/", "é"])
def test_text_is_cut_as_text(spark, prefix):
    df = spark.range(2000).select(F.concat(F.lit(prefix), F.lpad(F.col("id").cast("string"), 6, "0")).alias("s"))
    numbered = layout.with_cluster_number(df, ["s"], "n").orderBy("s").collect()
    assert [r.n for r in numbered] == sorted(r.n for r in numbered)
    assert len({r.n for r in numbered}) == 64


def test_clustering_by_many_columns_and_types(spark):
    columns = {
        "i": F.col("id"), "d": F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")), "t": F.timestamp_seconds("id"),
        "b": F.col("id") % 2 == 0, "m": F.col("id").cast("decimal(20,3)"), "x": F.when(F.col("id") % 3 > 0, F.col("id").cast("double")),
    }
    df = spark.range(500).select(*[c.alias(n) for n, c in columns.items()])
    got = layout.cluster_layout(df, list(columns), 4)
    assert got.exceptAll(df).isEmpty() and got.count() == 500


def test_pseudonyms(spark):
    df = spark.createDataFrame([("ab",), ("abXX",), ("abcd",), ("somebody",), ("somebody",), (None,)], "u string")
    hashed = [r.u for r in privacy.pseudonymise(df, "u", "k").collect()]
    assert hashed[0] == hashed[1] != hashed[2] and hashed[3] == hashed[4] and hashed[5] is None
    assert hashed != [r.u for r in privacy.pseudonymise(df, "u", "other").collect()]
    key = "0123456789abcdef"
    secret = privacy.encrypt_id(df, "u", key)
    assert [r.u for r in privacy.decrypt_id(secret, "u", key).collect()] == ["abXX", "abXX", "abcd", "somebody", "somebody", None]
    assert secret.select("u").distinct().count() == 4


def test_precision(spark):
    df = spark.createDataFrame([("52.52437",), ("0.0125",), ("n/a",), (None,)], "x string")
    assert [r.x for r in privacy.reduce_precision(df, ["x"], 3).collect()] == [52.524, 0.013, None, None]
    assert [r.x for r in privacy.reduce_precision(df, ["x"], 3, half_even=True).collect()][1] == 0.012


def test_jitter_bounds_and_repeatability(spark):
    df = spark.range(5000).select("id", F.timestamp_seconds(F.col("id") * 60 + 1_700_000_000).alias("ts"))
    moved = privacy.jitter_time(df, "ts", ["id"], "s")
    shift = moved.alias("m").join(df.alias("d"), "id").select((F.unix_micros("m.ts") - F.unix_micros("d.ts")).alias("us"))
    low, high, mean = shift.agg(F.min("us"), F.max("us"), F.avg("us")).first()
    assert 61_000_000 <= low < 90_000_000 and 1_230_000_000 < high < 1_260_000_000
    assert abs(mean / 1e6 - (30.5 + 630)) < 20
    assert moved.exceptAll(privacy.jitter_time(df.repartition(7), "ts", ["id"], "s")).isEmpty()
    assert not moved.exceptAll(privacy.jitter_time(df, "ts", ["id"], "t")).isEmpty()


def test_protected_extract(spark, tmp_path):
    df = spark.sql(
        """SELECT 'bo' AS user_id, timestamp'2020-01-01 00:00:00' AS timestamp,
                  "('52.52437', '13.41053', 'Berlin', 'DE', 'Europe/Berlin')" AS location, 120 AS air_quality_index"""
    )
    row = sensors.protected_extract(df, "k").first()
    assert (row.lat, row.long, row.city, row.air_quality_category) == (52.524, 13.411, "Berlin", 3)
    assert row.user_id != "bo" and "location" not in row
    sensors.write_extract(df, str(tmp_path / "x"), "k")
    back = spark.read.option("header", True).csv(str(tmp_path / "x"))
    assert back.count() == 1 and set(back.columns) == set(row.asDict())


def test_made_users(spark):
    made = users.make_users(spark.range(5000), "id", "2024-05-01 00:00:00")
    assert made.schema == spark.createDataFrame([], users.USERS).schema or [f.name for f in made.schema] == [
        c.split()[0] for c in users.USERS.split(",")
    ]
    assert made.exceptAll(users.make_users(spark.range(5000).repartition(9), "id", "2024-05-01 00:00:00")).isEmpty()
    share, ages = made.agg(F.avg("gender")).first()[0], rows(made.select("age_group").distinct())
    assert 0.66 < share < 0.74 and ages == [(i,) for i in sorted(range(11), key=lambda i: repr((i,)))]
    low, high = made.agg(F.min("creation_date"), F.max("creation_date")).first()
    assert low.month == high.month == 5
    assert users.mean_age_group(made).count() == 2
