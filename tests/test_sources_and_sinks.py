import json
from datetime import date, datetime

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.plans import charging_schemas as shape
from ledgerline.session import scratch_path
from ledgerline.sources import catalog, readers, writers
from tests.conftest import explained, partition_filters


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_with_json_body_escapes_and_malformed_cells(spark, tmp_path):
    (tmp_path / "log.csv").write_text(
        "message_id,message_type,charge_point_id,action,write_timestamp,body\n"
        'a,2,cp,Start,2023-01-01T00:00:00.000000+00:00,"{\\"k\\": \\"x,y\\"}"\n'
        "b,two,cp,Start,,\n"
    )
    got = {r.message_id: r for r in readers.read_csv(spark, str(tmp_path), shape.LOG).collect()}
    assert json.loads(got["a"].body) == {"k": "x,y"}
    assert got["b"].message_type is None and got["b"].body is None and got["b"].charge_point_id == "cp"


def test_csv_union_with_and_without_schema(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.csv").write_text(f"id,v\n{i},{i}.5\n")
    paths = [str(tmp_path / f"{i}.csv") for i in range(3)]
    inferred = readers.read_csv_union(spark, paths)
    assert inferred.dtypes == [("id", "int"), ("v", "double")] and inferred.count() == 3
    assert rows(readers.read_csv_union(spark, paths, "id string, v string"))[0] == ("0", "0.5")


def test_json_array_with_index(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps([{"m": "a", "n": 1}, {"m": "b", "n": None}]))
    got = readers.read_json_records(spark, str(tmp_path / "r.json"), index_order=["m"])
    assert rows(got.select("index", "m", "n")) == [(0, "a", 1), (1, "b", None)]


def test_frame_and_row_id(spark):
    df = readers.with_row_id(readers.frame(spark, [("x",)] * 10, "a string").repartition(3))
    assert df.select("id").distinct().count() == 10


def test_table_times_are_instants_and_filters_reach_the_file(spark, sf):
    events = readers.read_table(spark, sf, "events")
    assert dict(events.dtypes)["ts"] == "timestamp"
    late = events.where(F.col("ts") >= "2024-01-20").select("event_id")
    assert "GreaterThanOrEqual(ts" in late._jdf.queryExecution().executedPlan().toString()
    raw = spark.read.parquet(f"{sf}/events.parquet")
    assert raw.select(F.col("ts").cast("timestamp")).exceptAll(events.select("ts")).isEmpty()
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        moved = readers.read_table(spark, sf, "events").select(F.col("ts").cast("timestamp_ntz"))
        assert moved.exceptAll(raw.select("ts")).isEmpty()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_write_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(spark.range(3), path)
    writers.write_parquet(spark.range(2), path)
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(AnalysisException):
        writers.write_parquet(spark.range(2), path, mode=None)


def log_rows(spark):
    data = [
        (f"m{i}", 2 + i % 2, f"cp{i % 3}", "Start" if i % 4 else "Stop", datetime(2023, 1, 1 + i % 2, i % 24, i % 60))
        for i in range(60)
    ] + [("odd", 4, "cp0", "Start", datetime(2023, 1, 1))]
    return spark.createDataFrame(data, "message_id string, message_type int, charge_point_id string, action string, write_timestamp timestamp")


def test_event_log_partitions_prune(spark, tmp_path):
    path = str(tmp_path / "log")
    log = log_rows(spark)
    writers.write_event_log(log, path)
    writers.write_event_log(log, path)
    back = spark.read.parquet(path)
    assert back.count() == 122
    one = readers.read_time_partition(back.where("charge_point_id = 'cp1'"), date(2023, 1, 2))
    assert one.count() == 2 * log.where("charge_point_id = 'cp1' AND to_date(write_timestamp) = '2023-01-02'").count()
    for part in ("(charge_point_id#", "(year#", "(month#", "(day#"):
        assert part in partition_filters(one)


def test_read_one_minute(spark, tmp_path):
    from ledgerline.functions.scalars import calendar_parts

    log = log_rows(spark).withColumns(calendar_parts("write_timestamp"))
    writers.write_partitioned(log, str(tmp_path / "m"), ["year", "month", "day", "hour", "minute"])
    back = spark.read.parquet(str(tmp_path / "m"))
    got = readers.read_time_partition(back, datetime(2023, 1, 2, 3, 3, 59))
    assert [r.message_id for r in got.collect()] == ["m3"]
    assert "(minute#" in partition_filters(got)


def test_actions_go_to_their_tables_in_one_write(spark, tmp_path):
    log = log_rows(spark)
    writers.write_actions(log, str(tmp_path / "a"))
    names = sorted(p.name for p in (tmp_path / "a").iterdir() if p.is_dir())
    # every fourth row is a request to stop; there are no stop responses
    assert names == [f"action_table={n}" for n in ("StartRequest", "StartResponse", "StopRequest")]
    back = spark.read.parquet(str(tmp_path / "a"))
    assert back.count() == 60 and back.where("action_table = 'StopRequest'").count() == 15


def test_fixed_files_json_csv_snapshot(spark, tmp_path):
    writers.write_json_lines(writers.fixed_files(spark.range(100), 5), str(tmp_path / "j"))
    assert len(list((tmp_path / "j").glob("part-*"))) == 5 and spark.read.json(str(tmp_path / "j")).count() == 100
    quoted = spark.createDataFrame([('say "hi", ok',), (None,)], "t string")
    writers.write_csv(quoted, str(tmp_path / "c"))
    assert rows(readers.read_csv(spark, str(tmp_path / "c"), "t string").na.drop()) == [('say "hi", ok',)]
    path = writers.write_snapshot(spark.range(4), str(tmp_path / "s"), date(2024, 5, 27))
    assert path.endswith("/2024-05-27") and spark.read.parquet(path).count() == 4


def test_schema_alignment_and_evolution(spark, tmp_path):
    target = spark.createDataFrame([], "a long, b string, c double").schema
    df = spark.createDataFrame([("5", 1)], "b string, d int")
    assert rows(writers.align_schema(df, target)) == [(None, "5", None)]
    assert writers.align_schema(df, target, extra=True).columns == ["a", "b", "c", "d"]
    both = writers.union_evolving(spark.range(1).toDF("a"), df)
    assert rows(both) == [(0, None, None), (None, "5", 1)]
    path = str(tmp_path / "e")
    spark.range(2).toDF("a").write.parquet(path)
    spark.range(1).selectExpr("id AS a", "'x' AS extra").write.mode("append").parquet(path)
    assert readers.read_parquet(spark, path, merge_schema=True).columns == ["a", "extra"]


def test_quarantine(spark, tmp_path):
    df = spark.createDataFrame([(1,), (None,), (-1,)], "v int")
    good, bad = writers.split_quality(df, F.col("v") > 0)
    assert rows(good) == [(1,)] and rows(bad) == [(-1,), (None,)]
    writers.write_with_quarantine(df, F.col("v") > 0, str(tmp_path / "q"))
    counts = spark.read.parquet(str(tmp_path / "q")).groupBy("quality").count()
    assert rows(counts) == [("good", 1), ("quarantine", 2)]


def test_emptiness_and_compaction(spark, tmp_path):
    assert writers.has_rows(spark.range(1)) and not writers.has_rows(spark.range(0))
    path, target = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(10_000).repartition(16).write.parquet(path)
    listed = writers.file_list(spark, path).agg(F.sum("file_size")).first()[0]
    assert listed == sum(f.stat().st_size for f in (tmp_path / "many").glob("*.parquet"))
    assert writers.compact(spark, path, target, file_bytes=30_000) in (2, 3, 4)
    assert 2 <= len(list((tmp_path / "few").glob("*.parquet"))) <= 4
    assert spark.read.parquet(target).exceptAll(spark.read.parquet(path)).isEmpty()


def test_compaction_keeps_partitions_and_order(spark, tmp_path):
    path, target = str(tmp_path / "many"), str(tmp_path / "few")
    frame = spark.range(3000).select("id", (F.col("id") % 3).cast("string").alias("k"), (F.col("id") % 2).alias("p q"))
    frame.repartitionByRange(10, "id").sortWithinPartitions("id").write.partitionBy("k", "p q").parquet(path)
    files = {str(f.parent.relative_to(tmp_path / "many")): 0 for f in (tmp_path / "many").rglob("*.parquet")}
    assert writers.compact(spark, path, target) == len(files) == 6
    few = [str(f.parent.relative_to(tmp_path / "few")) for f in (tmp_path / "few").rglob("*.parquet")]
    assert sorted(few) == sorted(files)
    for folder in few:
        ids = [r.id for r in spark.read.parquet(f"{target}/{folder}").collect()]
        assert ids == sorted(ids) and len(ids) == 500
    assert spark.read.parquet(target).exceptAll(spark.read.parquet(path)).isEmpty()


def test_replaced_partitions_leave_others(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string").write.partitionBy("k").parquet(path)
    writers.replace_partitions(spark.createDataFrame([(9, "b")], "v int, k string"), path, ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (9, "b")]


def test_routed_tables_are_pruned_when_the_job_runs(spark, tmp_path):
    log = [("m1", 2, "cp1", "StopTransaction", "2023-01-01T10:00:00Z", "{}"), ("m2", 3, "cp1", "StartTransaction", "2023-01-01T10:00:00Z", "{}")]
    frame = spark.createDataFrame(log, "message_id string, message_type int, charge_point_id string, action string, write_timestamp string, body string")
    base, names = str(tmp_path / "tables"), str(tmp_path / "list")
    writers.write_actions(frame, base, parts=["year"])
    writers.write_route_list(spark, base, names)
    got = writers.read_routes(spark, base, spark.read.parquet(names).where("message_type = 2"))
    assert [r.message_id for r in got.collect()] == ["m1"]
    assert "dynamicpruning" in explained(got)


def test_catalog(spark, tmp_path):
    assert catalog.clean_name("my table-01!") == "mytable01"
    with pytest.raises(ValueError):
        catalog.clean_name("--")
    writers.write_parquet(spark.range(3), str(tmp_path / "t1"))
    db = catalog.create_database(spark, "unit test", location=str(tmp_path / "db"))
    name = catalog.create_table(spark, db, "the-ids", str(tmp_path / "t1"))
    assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 3
    assert rows(catalog.describe(spark, name)) == [("id", "bigint")]
    catalog.create_table(spark, db, "the-ids", str(tmp_path / "t1"))
    catalog.replace_table(spark, db, "the-ids", spark.range(5), str(tmp_path / "t2"))
    assert spark.table(name).count() == 5 and spark.read.parquet(str(tmp_path / "t1")).count() == 3
    catalog.drop_table(spark, db, "the-ids")
    catalog.drop_table(spark, db, "the-ids")
    assert not spark.catalog.tableExists(f"{db}.theids")
    catalog.drop_database(spark, db)
    assert not spark.catalog.databaseExists(db)


def test_insert_select_casts_to_the_table(spark, tmp_path):
    path = str(tmp_path / "u")
    writers.write_parquet(spark.createDataFrame([(1, "a")], "id long, name string"), path)
    catalog.insert_select(spark.createDataFrame([(7, 2)], "name int, id int"), path, spark.read.parquet(path))
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "7")]


def test_copy_into_takes_each_file_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "1.json").write_text('{"id": 1}\n{"id": 2}\n')
    args = (spark, str(source), str(tmp_path / "table"), str(tmp_path / "ck"), "json", "id long")
    assert catalog.copy_into(*args) == 2
    assert catalog.copy_into(*args) == 0
    (source / "2.json").write_text('{"id": 3}\n')
    assert catalog.copy_into(*args) == 1
    assert rows(spark.read.parquet(str(tmp_path / "table"))) == [(1,), (2,), (3,)]


def test_rows_of_today(spark):
    df = spark.sql("SELECT current_date() AS d UNION ALL SELECT date_sub(current_date(), 1)")
    assert readers.rows_of_day(df, "d").count() == 1


class FakeSession:
    """Enough of a session to choose a scratch folder."""

    def __init__(self, master, **conf):
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda _: None})()
        self.conf = type("Conf", (), {"get": lambda _, key, default=None: conf.get(key.replace(".", "_"), default)})()


def test_scratch_lies_in_the_shared_folder():
    shared = FakeSession("spark://host", spark_checkpoint_dir="/shared/folder/")
    assert scratch_path(shared, "x").startswith("/shared/folder/ledgerline/x-")
    assert scratch_path(shared, "x") != scratch_path(shared, "x")
    with pytest.raises(ValueError):
        scratch_path(FakeSession("spark://host"), "x")
