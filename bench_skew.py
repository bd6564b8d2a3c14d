"""Hot keys at work: the plain plan against the sliced one, on lines of which a third has one key.

Prints one JSON line.  BENCH_SF_DIR, BENCH_CPUS as in bench.py; BENCH_COPIES multiplies the lines.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerline.operators import windows as win  # noqa: E402
from ledgerline.operators.skew import HotKeyPolicy, cut_hot_keys, enrich  # noqa: E402
from ledgerline.session import build_session, scratch_path  # noqa: E402
from ledgerline.sources.readers import read_table  # noqa: E402

PLAIN = HotKeyPolicy(share=1.0)


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "20"))
    spark = build_session(
        "skew",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": "32",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    lines = read_table(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), "lineitem")
    copied = lines.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    row = F.xxhash64(*lines.columns, "copy")
    path = scratch_path(spark, "skewed")
    copied.select(
        F.when(F.col("l_returnflag") == "A", F.lit(-1)).otherwise(F.col("l_orderkey")).alias("key"),
        F.timestamp_micros(F.pmod(row, F.lit(10**15))).alias("ts"),
        row.alias("id"),
        F.col("l_linestatus").alias("grade"),
        F.col("l_extendedprice").alias("value"),
    ).repartition(16).write.parquet(path)
    df = spark.read.parquet(path)
    sliced = HotKeyPolicy(share=1 / 256)
    facts = df.groupBy("key").agg(F.max("value").alias("top")).persist()
    facts.count()

    shifts = {"before": ("value", 1), "after": ("value", -1)}
    work = {
        "rank_rows": lambda p: win.rank_rows(df.select("key", "ts", "id", "value"), ["key"], ["ts"], ["id"], policy=p),
        "rank_rows_many_peers": lambda p: win.rank_rows(df.select("key", "grade", "id"), ["key"], ["grade"], ["id"], policy=p),
        "shift_columns": lambda p: win.shift_columns(df, ["key"], ["ts", "id"], shifts, p),
        "running_total": lambda p: win.running_total(df, ["key"], ["ts"], ["id"], "value", "total", p),
        "partition_stats": lambda p: win.partition_stats(df, ["key"], {"top": F.max("value")}, p),
        "dense_index": lambda p: win.dense_index(df.select("ts", "id"), ["ts", "id"], "n", policy=p),
        "enrich": lambda p: enrich(df, facts, ["key"]),
    }
    cuts = cut_hot_keys(df, ["key"], ["ts", "id"], sliced)
    groups = cuts.slice_of(df).groupBy("key", "_slice").count()
    largest = {
        "plain": df.groupBy("key").count().agg(F.max("count")).first()[0],
        "sliced": groups.agg(F.max("count")).first()[0],
    }
    taken = {}
    for name, run in work.items():
        for label, policy in (("plain", PLAIN), ("sliced", sliced)):
            start = time.perf_counter()
            run(policy).write.format("noop").mode("overwrite").save()
            taken[f"{name}_{label}"] = round(time.perf_counter() - start, 2)
    print(json.dumps({"metric": "skewed_windows", "rows": df.count(), "largest_group_rows": largest, "unit": "sec", "queries": taken}))
    spark.stop()


if __name__ == "__main__":
    main()
