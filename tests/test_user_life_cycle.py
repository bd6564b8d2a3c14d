"""A users table from raw files through changes, history, restore and pruning."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import changes as ch
from ledgerline.plans.users import USERS, make_users
from ledgerline.sources.catalog import copy_into
from ledgerline.sources.writers import fixed_files, write_json_lines


def test_life_cycle(spark, tmp_path):
    raw, loaded, log_path = (str(tmp_path / n) for n in ("raw", "loaded", "log"))
    made = make_users(spark.range(200), "id", "2024-05-01 00:00:00")
    write_json_lines(fixed_files(made, 5), raw)
    assert copy_into(spark, raw, loaded, str(tmp_path / "ck"), "json", USERS) == 200
    users = spark.read.parquet(loaded)
    assert users.exceptAll(made.select(users.columns)).isEmpty()

    day = "2024-06-0{} 00:00:00".format
    keys = ["id"]
    ch.commit(ch.stamped(users, ch.INSERT, 0, day(1)), log_path, 0)

    def log():
        return ch.read_log(spark, log_path)

    ch.commit(ch.update_changes(ch.as_of(log(), keys), F.col("age_group") == 4, {"firstname": F.lit("Four")}, 1, day(2)), log_path, 1)
    ch.commit(ch.delete_changes(ch.as_of(log(), keys), F.col("age_group") == 5, 2, day(3)), log_path, 2)
    # Pinned: frames read before and after a commit may share scans in one plan.
    now = ch.as_of(log(), keys, version=2)
    assert now.where("age_group = 5").isEmpty() and now.where("age_group = 4 AND firstname <> 'Four'").isEmpty()

    updates = now.where("id < 3").withColumn("firstname", F.lit("Marco")).unionByName(
        now.orderBy("id").limit(1).withColumn("id", F.lit(99999).cast("long"))
    )
    ch.enforce_check(updates, "id_not_null", F.col("id").isNotNull())
    with pytest.raises(ch.CheckViolation):
        ch.enforce_check(updates.withColumn("id", F.lit(None).cast("long")), "id_not_null", F.col("id").isNotNull())
    merged = ch.merge_upsert(now, updates, keys)
    ch.commit(ch.merge_changes(now, updates, keys, 3, day(4)), log_path, 3)
    assert ch.as_of(log(), keys).exceptAll(merged.select(now.columns)).isEmpty()
    assert sorted(ch.as_of(log(), keys).collect()) == sorted(merged.select(now.columns).collect())

    ch.commit(ch.restore_changes(log(), keys, 0, 3, day(5)), log_path, 4)
    back = ch.as_of(log(), keys)
    assert back.count() == 200 and back.exceptAll(users.select(back.columns)).isEmpty()
    assert ch.as_of(log(), keys, version=0).count() == 200
    lines = {r._version: (r.inserted, r.updated, r.deleted) for r in ch.history(log()).collect()}
    assert lines[0] == (200, 0, 0) and lines[2][2] == users.where("age_group = 5").count() and set(lines) == set(range(5))

    kept = ch.prune(log(), keys, day(5))
    assert ch.as_of(kept, keys).exceptAll(back).isEmpty() and kept.count() < log().count()
    numbered = ch.assign_identity(back.drop("id").withColumn("old", F.monotonically_increasing_id()), ["old"], "id")
    assert numbered.agg(F.min("id"), F.max("id")).first()[0:] == (10000, 10199)
