import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import charging_schemas as shape
from ledgerline.plans import charts
from ledgerline.streaming import layers, status
from ledgerline.streaming.sinks import late_groups, stream_live, stream_to_parquet, stream_update
from ledgerline.streaming.sources import rate_stream, replay, replay_to, store_replayed, stream_files, stream_table
from tests.conftest import partition_filters
from tests.test_charging import log  # noqa: F401
from tests.test_statistics import chart_rows


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def notice(cp, state, minute, second=0):
    at = f"2023-01-01T{10 + minute // 60:02d}:{minute % 60:02d}:{second:02d}.000000+00:00"
    return (f"{cp}{minute}", 2, cp, "StatusNotification", at, json.dumps({"connector_id": 1, "status": state, "timestamp": at}))


def put(spark, path, notices):
    spark.createDataFrame(notices, shape.LOG).coalesce(1).write.mode("append").parquet(path)


def test_windows_close_behind_the_watermark_and_late_rows_drop(spark, tmp_path):
    source, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    put(spark, source, [notice("a", "Free", 1), notice("a", "Free", 4, 59), notice("a", "Busy", 5), notice("b", None, 2)])
    run = lambda: status.write_status_counts(stream_table(spark, source), out, ck).awaitTermination()
    run()
    assert not [p for p in (tmp_path / "out").glob("*.parquet") if spark.read.parquet(str(p)).count()]
    put(spark, source, [notice("a", "Free", 21)])
    run()
    closed = spark.read.parquet(out).select("charge_point_id", "status", F.minute("window.start"), "status_count")
    # a NULL status is a group of its own and counts no values
    want = sorted([("a", "Free", 0, 2), ("a", "Busy", 5, 1), ("b", None, 0, 0)], key=repr)
    assert rows(closed) == want
    put(spark, source, [notice("a", "Free", 2), notice("a", "Free", 12)])
    run()
    put(spark, source, [notice("a", "Free", 60)])
    run()
    late = [r for r in rows(spark.read.parquet(out).select("charge_point_id", "status", F.minute("window.start"), "status_count")) if r not in want]
    # the row of minute 2 came after the watermark (minute 11) and is gone
    assert late == [("a", "Free", 10, 1), ("a", "Free", 20, 1)]


def test_update_mode_shows_open_windows(spark, tmp_path):
    source = str(tmp_path / "in")
    put(spark, source, [notice("a", "Free", 1), notice("a", "Free", 2)])
    seen = {}

    def keep(changed, batch):
        seen[batch] = rows(changed.select("charge_point_id", "status_count"))

    counts = lambda: status.status_counts(status.status_rows(stream_table(spark, source)))
    stream_update(counts(), keep, str(tmp_path / "ck")).awaitTermination()
    put(spark, source, [notice("a", "Free", 3)])
    stream_update(counts(), keep, str(tmp_path / "ck")).awaitTermination()
    changed = [r for _, r in sorted(seen.items()) if r]
    assert changed == [[("a", 2)], [("a", 3)]]


def test_parquet_sink_refuses_update_mode(spark, tmp_path):
    put(spark, str(tmp_path / "in"), [notice("a", "Free", 1)])
    counts = status.status_counts(status.status_rows(stream_table(spark, str(tmp_path / "in"))))
    with pytest.raises(Exception, match="(?i)update"):
        counts.writeStream.format("parquet").outputMode("update").option("checkpointLocation", str(tmp_path / "ck")).start(str(tmp_path / "o"))


def test_stream_equals_batch_on_closed_windows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(spark, source, [notice(f"cp{i % 3}", "Free" if i % 2 else "Busy", i, i % 60) for i in range(120)])
    status.write_status_counts(stream_table(spark, source), out, str(tmp_path / "ck")).awaitTermination()
    batch = status.status_counts(status.status_rows(spark.read.parquet(source)))
    closed = batch.where(F.col("window.end") <= F.lit("2023-01-01 11:49:59").cast("timestamp"))
    assert rows(spark.read.parquet(out)) == rows(closed.select(spark.read.parquet(out).columns))


def test_live_totals(spark, tmp_path):
    spark.createDataFrame([(1, 5), (1, 6), (2, 9)], "gender int, age_group int").write.parquet(str(tmp_path / "u"))
    from ledgerline.plans.users import mean_age_group

    query = stream_live(mean_age_group(stream_table(spark, str(tmp_path / "u"))), "live_ages", "complete")
    query.awaitTermination()
    assert rows(spark.table("live_ages")) == [(1, 5.5), (2, 9.0)]


def test_rate_source_replays_a_table(spark, tmp_path):
    static = spark.createDataFrame([(0, "first"), (1, "second")], "index long, body string")
    stream = replay(rate_stream(spark, 10), static, restamp="write_timestamp")
    assert stream.isStreaming and set(stream.columns) == {"body", "write_timestamp"}
    query = stream_to_parquet(stream, str(tmp_path / "o"), str(tmp_path / "c"), trigger={"processingTime": "500 milliseconds"})
    try:
        for _ in range(60):
            query.awaitTermination(0.5)
            if sum(p["numInputRows"] for p in query.recentProgress) >= 5:
                break
    finally:
        query.stop()
    got = spark.read.parquet(str(tmp_path / "o"))
    assert {r.body for r in got.collect()} == {"first", "second", None}


def test_replay_drops_clock_without_restamp(spark):
    clock = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS timestamp, id AS value FROM range(3)")
    static = spark.createDataFrame([(0, "a", "old"), (2, "c", "old")], "index long, body string, timestamp string")
    assert rows(replay(clock, static)) == sorted([("a", "old"), (None, None), ("c", "old")], key=repr)


def test_bronze_partitions_and_minute_job(spark, log, tmp_path):  # noqa: F811
    source, bronze, base = (str(tmp_path / n) for n in ("in", "bronze", "silver"))
    log.write.parquet(source)
    typed = stream_table(spark, source).withColumn("write_timestamp", F.to_timestamp("write_timestamp"))
    layers.write_bronze(typed, bronze, str(tmp_path / "ck")).awaitTermination()
    back = spark.read.parquet(bronze)
    assert back.count() == log.count() and back.columns[-5:] == layers.MINUTE_PARTITIONS
    assert back.where("message_id = 's1'").first().write_timestamp_epoch == 1672576200
    minute = layers.last_minute(back, datetime(2023, 1, 1, 10, 1, 30))
    assert {r.message_id for r in minute.collect()} == {"a"} and "(minute#" in partition_filters(minute)
    written = layers.silver_minute(spark, bronze, base, datetime(2023, 1, 1, 10, 1, 30))
    assert written == ["StartTransactionRequest", "StartTransactionResponse"]
    starts = spark.read.parquet(f"{base}/StartTransactionRequest").first()
    assert (starts.meter_start, starts.charge_point_id, starts.day) == (100, "cp1", 1)
    assert layers.silver_minute(spark, bronze, base, datetime(2023, 1, 1, 10, 6)) == ["MeterValues" + "Request"]
    layers.silver_span(spark, bronze, base, datetime(2023, 1, 1, 10), datetime(2023, 1, 1, 11))
    before = {t: rows(spark.read.parquet(f"{base}/{t}")) for t in [*written, "MeterValuesRequest"]}
    assert len(before["StartTransactionRequest"]) > 1
    # A second run of a job, or one over more minutes, replaces what is there and adds nothing.
    layers.silver_minute(spark, bronze, base, datetime(2023, 1, 1, 10, 1, 30))
    layers.silver_span(spark, bronze, base, datetime(2023, 1, 1, 10), datetime(2023, 1, 1, 11))
    assert {t: rows(spark.read.parquet(f"{base}/{t}")) for t in before} == before
    assert layers.silver_minute(spark, bronze, base, datetime(2023, 1, 1, 9, 0)) == []


def test_chart_files_arrive_in_turn(spark, tmp_path):
    landing, bronze, silver = (str(tmp_path / n) for n in ("landing", "bronze", "silver"))
    raw = chart_rows(spark)

    def run():
        layers.chart_bronze(spark, landing, bronze, str(tmp_path / "c1")).awaitTermination()
        layers.chart_silver(spark, bronze, silver, str(tmp_path / "c2")).awaitTermination()
        return spark.read.parquet(silver)

    raw.where("region = 'DE'").coalesce(1).write.option("header", True).option("escape", "\\").csv(landing)
    assert run().count() == 2
    assert run().count() == 2
    raw.where("region = 'FR'").coalesce(1).write.mode("append").option("header", True).option("escape", "\\").csv(landing)
    got = run()
    assert rows(got) == rows(charts.with_streams(charts.clean(raw)).select(got.columns))


def test_files_are_taken_in_bounded_batches(spark, tmp_path):
    for i in range(4):
        spark.range(i, i + 1).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    query = stream_to_parquet(stream_files(spark, str(tmp_path / "in"), "parquet", "id long", 1), str(tmp_path / "o"), str(tmp_path / "c"))
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p.numInputRows]) >= 4
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == [(0,), (1,), (2,), (3,)]


def test_rows_later_than_the_watermark_are_dropped_and_counted(spark, tmp_path):
    """Four runs from one checkpoint: open windows are kept between runs, late rows never reach the result."""
    log, out, checkpoint = (str(tmp_path / n) for n in ("log", "out", "checkpoint"))
    minutes = [[0, 1, 12], [13, 2, 14], [40, 3], [41, 90, 12]]
    dropped = []
    for batch in minutes:
        frame = spark.createDataFrame([(m,) for m in batch], "m int").select(F.expr("timestamp'2024-01-01' + make_dt_interval(0, 0, m)").alias("ts"))
        frame.coalesce(1).write.mode("append").parquet(log)
        counts = status.windowed_counts(stream_table(spark, log), [F.lit("k").alias("k")], "ts", "ts", "n")
        query = stream_to_parquet(counts, out, checkpoint)
        query.awaitTermination()
        dropped.append(late_groups(query))
    got = {(r.window.start.minute, r.window.start.hour): r.n for r in spark.read.parquet(out).collect()}
    # Watermarks when the four batches begin: none, 0:02, 0:04, 0:30.  Minute 2 still counts, minute 3 too; the second 12 is late.
    assert dropped == [0, 0, 0, 1]
    assert got == {(0, 0): 4, (10, 0): 3, (40, 0): 2}


def test_replay_reads_only_what_the_ticks_point_at(spark, tmp_path):
    table, ticks, out, checkpoint = (str(tmp_path / n) for n in ("table", "ticks", "out", "checkpoint"))
    store_replayed(spark.range(100).select((F.col("id") * 10).alias("v")), ["v"], table)
    for low in (0, 60, 98):
        spark.range(low, low + 4).select(F.col("id").alias("value"), F.current_timestamp().alias("timestamp")).write.mode("append").parquet(ticks)
        replay_to(stream_table(spark, ticks), table, out, checkpoint).awaitTermination()
    assert rows(spark.read.parquet(out).select("batch", "v")) == sorted(
        [(0, v) for v in (0, 10, 20, 30)] + [(1, v) for v in (600, 610, 620, 630)] + [(2, v) for v in (980, 990, None, None)], key=repr
    )
