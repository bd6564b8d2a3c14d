"""Run registered queries against their SQL: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as contract  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tests.oracle import connect, duck_rows, spark_rows, type_gaps  # noqa: E402


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, sqls = contract.queries(), contract.oracle_sql()
    failed = 0
    for name in sys.argv[2:] or queries:
        t = time.time()
        try:
            df = queries[name](spark, sf)
            got = spark_rows(df)
            took = time.time() - t
            if name not in sqls:
                print(f"rows {name} {len(got[1])} {took:.2f}s")
                continue
            want = duck_rows(con, sqls[name])
            ok = got == want
            gaps = type_gaps(df, con, sqls[name])
            print(f"{'ok  ' if ok else 'FAIL'} {name} {len(got[1])}/{len(want[1])} {took:.2f}s {gaps or ''}")
            if not ok:
                failed += 1
                print("   ", got[0], want[0])
                diff = [(a, b) for a, b in zip(got[1], want[1]) if a != b][:3]
                for a, b in diff:
                    print("    spark", a, "\n    duck ", b)
        except Exception as e:  # noqa: BLE001
            failed += 1
            print("FAIL", name, type(e).__name__, str(e)[:1500])
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main() > 0)
