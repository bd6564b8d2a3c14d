"""Landing, exporting, replacing and changing stored tables, each written and read back."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.casts import wall_clock
from ledgerline.operators import changes as ch
from ledgerline.operators.ranking import any_row
from ledgerline.plans.charging import unpack
from ledgerline.plans.charging_schemas import LOG, STATUS
from ledgerline.plans.users import USERS, make_users
from ledgerline.queries.tables import ORACLES as TABLES
from ledgerline.queries.tables import readings
from ledgerline.plans.sensors import write_extract
from ledgerline.session import scratch_path
from ledgerline.sources import catalog, readers, writers
from ledgerline.sources.readers import read_table

SECRET = "not-a-real-secret"


def csv_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as log messages in two CSV folders: JSON bodies with quotes and commas, cells that do not fit, one scan."""
    base, events = scratch_path(spark, "csv"), read_table(spark, sf, "events")
    body = F.to_json(F.struct(F.col("event_type").alias("status"), F.concat(F.lit('a "b", c\\d '), "event_id").alias("error_code")))
    text = events.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.when(F.col("event_id") % 11 == 0, "two").otherwise("2").alias("message_type"),
        F.concat(F.lit("cp-"), F.col("user_id")).alias("charge_point_id"),
        F.lit("StatusNotification").alias("action"),
        F.when(F.col("event_id") % 13 != 0, F.date_format("ts", "yyyy-MM-dd")).alias("write_timestamp"),
        body.alias("body"),
    )
    paths = [f"{base}/{n}" for n in range(2)]
    for n, path in enumerate(paths):
        writers.write_csv(text.where(F.col("message_id").cast("long") % 2 == n), path)
    log = unpack(readers.read_csv_union(spark, paths, LOG), STATUS)
    return log.select("message_id", "message_type", "charge_point_id", "write_timestamp", F.expr("new_body.status").alias("status"), F.expr("new_body.error_code").alias("code"))


def json_records(spark: SparkSession, sf: str) -> DataFrame:
    """A file with one JSON array, read as rows with a dense index; the array holds the nations."""
    path, nation = scratch_path(spark, "json"), read_table(spark, sf, "nation")
    array = nation.agg(F.to_json(F.collect_list(F.struct("n_nationkey", "n_name", "n_regionkey"))).alias("value"))
    array.coalesce(1).write.text(path)
    return readers.read_json_records(spark, path, nation.select("n_nationkey", "n_name", "n_regionkey").schema, ["n_name"])


def row_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of all rows of a table: as many as rows, and none twice."""
    numbered = readers.with_row_id(read_table(spark, sf, "lineitem"))
    return numbered.groupBy("id").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("ids"), F.max("n").alias("most"))


def exports(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines in a fixed number of files, a dated snapshot, and a second write that is refused."""
    base, orders = scratch_path(spark, "exports"), read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    writers.write_json_lines(writers.fixed_files(orders, 3), f"{base}/json")
    snapshot = writers.write_snapshot(orders, f"{base}/snapshots", date(2024, 5, 29))
    try:
        writers.write_parquet(orders, snapshot, mode=None)
        refused = False
    except AnalysisException:
        refused = True
    sums = [F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("price")]
    kept = {"json": spark.read.schema(orders.schema).json(f"{base}/json"), "snapshot": spark.read.parquet(f"{base}/snapshots/2024-05-29")}
    files = spark.read.text(f"{base}/json").select("_metadata.file_path").distinct().count()
    out = [rows.agg(*sums).select(F.lit(name).alias("export"), "n", "keys", "price") for name, rows in kept.items()]
    return reduce(DataFrame.unionByName, out).withColumns({"json_files": F.lit(files), "refused": F.lit(refused)})


def replaced_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table replaced by a query over itself."""
    base, orders = scratch_path(spark, "replaced"), read_table(spark, sf, "orders")
    database = catalog.create_database(spark, "ledger replace", location=f"{base}/database")
    catalog.drop_table(spark, database, "orders")
    name = catalog.replace_table(spark, database, "orders", orders.select("o_orderkey", "o_custkey", "o_totalprice"), f"{base}/v1")
    best = spark.sql(f"SELECT o_custkey, max(o_totalprice) AS best, count(*) AS n FROM {name} GROUP BY o_custkey")
    return spark.table(catalog.replace_table(spark, database, "orders", best, f"{base}/v2"))


def extract_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The protected extract as CSV files, read back."""
    path = scratch_path(spark, "extract")
    write_extract(readings(spark, sf), path, SECRET)
    schema = "event_id bigint, user_id string, air_quality_index double, lat double, long double, city string, country string, timezone string, air_quality_category int"
    back = spark.read.option("header", True).option("escape", "\\").csv(path)
    return back.select(*[F.col(c.split()[0]).cast(c.split()[1]).alias(c.split()[0]) for c in schema.split(", ")])


def small_looks(spark: SparkSession, sf: str) -> DataFrame:
    """Whether tables have rows, whether any row is one of the table's, and the rows of today."""
    orders, events = read_table(spark, sf, "orders"), read_table(spark, sf, "events")
    one = any_row(orders.select("o_orderkey"))
    today = readers.rows_of_day(events, "ts").count()
    looks = [
        ("orders have rows", int(writers.has_rows(orders))),
        ("rows before time", int(writers.has_rows(events.where("ts < timestamp'1900-01-01'")))),
        ("any row is one of them", orders.join(one, "o_orderkey", "left_semi").count()),
        ("rows of today", today),
    ]
    return spark.createDataFrame(looks, "look string, n long")


def user_life_cycle(spark: SparkSession, sf: str) -> DataFrame:
    """Users from raw files through load, update, delete, merge and restore; the table after each version."""
    base, keys = scratch_path(spark, "users"), ["id"]
    made = make_users(read_table(spark, sf, "customer").select("c_custkey"), "c_custkey", "2024-01-01 00:00:00")
    writers.write_json_lines(writers.fixed_files(made, 5), f"{base}/raw")
    catalog.copy_into(spark, f"{base}/raw", f"{base}/loaded", f"{base}/checkpoint", "json", USERS)
    users, path = spark.read.parquet(f"{base}/loaded"), f"{base}/log"

    def at(version: int) -> DataFrame:
        return ch.as_of(ch.read_log(spark, path), keys, version=version)

    def day(n: int) -> str:
        return f"2024-06-0{n} 00:00:00"

    ch.commit(ch.stamped(users, ch.INSERT, 0, day(1)), path, 0)
    ch.commit(ch.update_changes(at(0), F.col("age_group") == 4, {"firstname": F.lit("Four")}, 1, day(2)), path, 1)
    ch.commit(ch.delete_changes(at(1), F.col("age_group") == 5, 2, day(3)), path, 2)
    renamed = at(2).where("gender = 1").withColumn("firstname", F.lit("Marco"))
    new = at(2).where("age_group = 0").withColumn("id", F.col("id") + 1_000_000_000)
    source = ch.enforce_check(renamed.unionByName(new), "id_not_null", F.col("id").isNotNull())
    ch.commit(ch.merge_changes(at(2), source, keys, 3, day(4)), path, 3)
    ch.commit(ch.restore_changes(ch.read_log(spark, path), keys, 0, 3, day(5)), path, 4)
    return reduce(DataFrame.unionByName, [at(v).select(F.lit(v).alias("version"), "id", "firstname", "age_group", wall_clock("creation_date").alias("created")) for v in range(5)])


QUERIES = {f.__name__: f for f in (csv_log, json_records, row_ids, exports, replaced_table, extract_csv, small_looks, user_life_cycle)}

_EXPORT = "count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, round(sum(o_totalprice), 2) AS price, CAST(3 AS INTEGER) AS json_files, TRUE AS refused FROM orders"

ORACLES = {
    "csv_log": r"""
        SELECT CAST(event_id AS VARCHAR) AS message_id, CASE WHEN event_id % 11 <> 0 THEN CAST(2 AS INTEGER) END AS message_type,
               'cp-' || user_id AS charge_point_id, CASE WHEN event_id % 13 <> 0 THEN strftime(ts, '%Y-%m-%d') END AS write_timestamp,
               event_type AS status, 'a "b", c\d ' || event_id AS code FROM events""",
    "json_records": """SELECT n_nationkey, n_name, n_regionkey, row_number() OVER (ORDER BY n_name) - 1 AS index FROM nation""",
    "row_ids": "SELECT count(*) AS rows, count(*) AS ids, CAST(1 AS BIGINT) AS most FROM lineitem",
    "exports": f"SELECT 'json' AS export, {_EXPORT} UNION ALL SELECT 'snapshot', {_EXPORT}",
    "replaced_table": "SELECT o_custkey, max(o_totalprice) AS best, count(*) AS n FROM orders GROUP BY o_custkey",
    "extract_csv": f"SELECT * EXCLUDE (timestamp) FROM ({TABLES['protected_extract']})",
    "small_looks": """
        SELECT 'orders have rows' AS look, CAST(count(*) > 0 AS BIGINT) AS n FROM orders
        UNION ALL SELECT 'rows before time', CAST(count(*) > 0 AS BIGINT) FROM events WHERE ts < TIMESTAMP '1900-01-01'
        UNION ALL SELECT 'any row is one of them', least(1, count(*)) FROM orders
        UNION ALL SELECT 'rows of today', count(*) FROM events WHERE CAST(ts AS DATE) = current_date""",
    "user_life_cycle": f"""
        WITH v0 AS ({TABLES['gen_users']}),
        v1 AS (SELECT * REPLACE (CASE WHEN age_group = 4 THEN 'Four' ELSE firstname END AS firstname) FROM v0),
        v2 AS (SELECT * FROM v1 WHERE age_group <> 5),
        v3 AS (SELECT * REPLACE (CASE WHEN gender = 1 THEN 'Marco' ELSE firstname END AS firstname) FROM v2
               UNION ALL SELECT * REPLACE (id + 1000000000 AS id) FROM v2 WHERE age_group = 0),
        states AS (SELECT 0 AS version, * FROM v0 UNION ALL SELECT 1, * FROM v1 UNION ALL SELECT 2, * FROM v2
                   UNION ALL SELECT 3, * FROM v3 UNION ALL SELECT 4, * FROM v0)
        SELECT CAST(version AS INTEGER) AS version, id, firstname, age_group, creation_date AS created FROM states""",
}
