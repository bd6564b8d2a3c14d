import json
from datetime import datetime

import pytest

from ledgerline.functions.casts import exact_timestamp
from ledgerline.operators.skew import HotKeyPolicy
from ledgerline.plans import charging as plan
from ledgerline.plans import charging_schemas as shape
from tests.conftest import explained

T0 = "2023-01-01T{}:00.000000+00:00"


def sample(value, phase=None, measurand="Power.Active.Import"):
    return {"value": value, "measurand": measurand, "phase": phase, "unit": "W"}


@pytest.fixture(scope="module")
def log(spark):
    rows = []

    def add(mid, kind, cp, action, minute, body):
        text = body if isinstance(body, str) or body is None else json.dumps(body)
        rows.append((mid, kind, cp, action, T0.format(minute), text))

    add("a", 2, "cp1", "StartTransaction", "10:00", {"connector_id": 1, "id_tag": "t", "meter_start": 100, "timestamp": T0.format("10:00")})
    add("a", 3, "cp1", "StartTransaction", "10:00", {"transaction_id": 1, "id_tag_info": {"status": "Accepted"}})
    # response without request, request without response, malformed response
    add("b", 3, "cp2", "StartTransaction", "10:01", {"transaction_id": 2, "id_tag_info": {"status": "Accepted"}})
    add("c", 2, "cp3", "StartTransaction", "10:02", {"connector_id": 1, "meter_start": 7, "timestamp": "late"})
    add("d", 3, "cp4", "StartTransaction", "10:03", "{not json")
    add("e", 3, "cp5", "StartTransaction", "10:04", {"transaction_id": "five", "id_tag_info": {"status": "Accepted"}})
    add("s1", 2, "cp1", "StopTransaction", "12:30", {"meter_stop": 5600, "timestamp": T0.format("12:30"), "transaction_id": 1, "transaction_data": []})
    add("s2", 2, "cp2", "StopTransaction", "12:31", {"meter_stop": 50, "timestamp": T0.format("12:31"), "transaction_id": 2})
    add("s9", 2, "cp9", "StopTransaction", "12:32", {"meter_stop": 60, "timestamp": T0.format("12:32"), "transaction_id": 9})

    def readings(mid, tx, pairs):
        values = [{"timestamp": T0.format(m), "sampled_value": [sample(v), sample("9", "L1"), sample("1", None, "Energy")]} for m, v in pairs]
        add(mid, 2, "cp1", "MeterValues", "10:05", {"connector_id": 1, "transaction_id": tx, "meter_value": values})

    # idle 10:00-10:30, busy, idle 11:00-11:06 with a junk value inside, busy, idle once
    readings("v1", 1, [("10:00", "0"), ("10:30", "0.0"), ("10:40", "5")])
    readings("v2", 1, [("11:00", "0"), ("11:03", "junk"), ("11:06", "0"), ("11:10", "3.456"), ("11:20", "0")])
    readings("v3", 2, [("10:00", "1"), ("11:00", "2")])
    readings("v4", 3, [])
    add("v5", 2, "cp1", "MeterValues", "10:06", {"connector_id": 1, "transaction_id": 4, "meter_value": None})
    return spark.createDataFrame(rows, shape.LOG)


def test_filter_keeps_one_action_and_direction(log):
    got = plan.messages(log, "StartTransaction", 3)
    assert got.count() == 4
    assert got.select("action", "message_type").distinct().collect() == [("StartTransaction", 3)]


def test_bad_fields_and_documents_become_null_and_rows_stay(log):
    got = {r.message_id: r for r in plan.start_responses(log).collect()}
    assert got["a"].transaction_id == 1 and got["a"].id_tag_info_status == "Accepted"
    assert got["d"].transaction_id is None and got["d"].id_tag_info_status is None
    assert got["e"].transaction_id is None and got["e"].id_tag_info_status == "Accepted"
    assert {r.message_id: r.timestamp for r in plan.start_requests(log).collect()}["c"] is None


def test_silver_columns(log):
    common = ["message_id", "message_type", "charge_point_id", "action", "write_timestamp"]
    assert plan.start_requests(log).dtypes[5:] == [
        ("connector_id", "int"), ("id_tag", "string"), ("meter_start", "int"), ("timestamp", "timestamp"), ("reservation_id", "int"),
    ]
    assert plan.stop_requests(log).dtypes[5:] == [
        ("meter_stop", "int"), ("timestamp", "timestamp"), ("transaction_id", "int"), ("reason", "string"), ("id_tag", "string"),
        ("transaction_data", "array<string>"),
    ]
    for make in (plan.start_requests, plan.start_responses, plan.stop_requests, plan.meter_samples):
        assert make(log).columns[:5] == common


def test_explode_drops_empty_and_null_arrays(log):
    samples = plan.meter_samples(log)
    assert {r[0] for r in samples.select("transaction_id").distinct().collect()} == {1, 2}
    assert samples.count() == 10 * 3
    main = plan.main_power(samples)
    assert main.count() == 10
    assert main.where("timestamp = timestamp'2023-01-01 11:10:00'").first().value == 3.46


def test_inner_and_left_matching(log):
    asked, named = plan.start_requests(log), plan.start_responses(log)
    inner = plan.matched_starts(named, asked, "inner").collect()
    assert [(r.charge_point_id, r.transaction_id, r.meter_start) for r in inner] == [("cp1", 1, 100)]
    left = plan.matched_starts(named, asked, "left")
    assert left.count() == 4 and left.where("meter_start IS NULL").count() == 3


def test_stops_take_keys_from_start_or_stop(log):
    starts = plan.matched_starts(plan.start_responses(log), plan.start_requests(log), "left")
    stops = plan.stop_requests(log)
    got = {r.meter_stop: (r.charge_point_id, r.transaction_id) for r in plan.matched_stops(stops, starts).collect()}
    assert got == {5600: ("cp1", 1), 50: ("cp2", 2), 60: (None, None)}
    kept = {r.meter_stop: (r.charge_point_id, r.transaction_id) for r in plan.matched_stops(stops, starts, True).collect()}
    assert kept[60] == ("cp9", None)


@pytest.mark.parametrize("policy", [HotKeyPolicy(), HotKeyPolicy(share=1 / 4, sample_per_slice=5)])
def test_parking_time(log, policy):
    got = {r.transaction_id: r.total_parking_time for r in plan.parking_time(plan.meter_samples(log), policy).collect()}
    # 30 minutes + 6 minutes; the junk value counts as not charging; the single reading adds nothing
    assert got == {1: 0.6}


def test_charge_records(log, tmp_path):
    short = {r.transaction_id: r for r in plan.charge_records_from_log(log).collect()}
    assert plan.charge_records_from_log(log).columns == plan.SHORT_RECORD
    one = short[1]
    assert (one.charge_point_id, one.total_time, one.total_energy, one.total_parking_time) == ("cp1", 2.5, 5500.0, 0.6)
    assert one.start_timestamp == datetime(2023, 1, 1, 10)
    gold = {r.transaction_id: r for r in plan.build_layers(log, str(tmp_path)).collect()}
    assert gold[1].total_energy == 5.5 and gold[1].meter_start == 100
    assert gold[2].meter_stop == 50 and gold[2].total_time is None and gold[2].total_parking_time is None
    assert gold[None].charge_point_id is None and gold[None].meter_stop == 60


def test_last_connection(log):
    got = plan.last_connection(log, exact_timestamp("write_timestamp"))
    rows = {r.charge_point_id: r for r in got.collect()}
    assert rows["cp1"].message_id == "s1" and rows["cp1"].converted_timestamp == datetime(2023, 1, 1, 12, 30)
    assert got.columns == log.columns + ["converted_timestamp"]
    assert got.count() == log.select("charge_point_id").distinct().count()


def test_latest_keeps_one_row_per_key_before_the_shuffle(log):
    text = explained(plan.last_connection(log, exact_timestamp("write_timestamp")))
    assert text.count("WindowGroupLimit") >= 2


def test_idle_time_takes_one_shuffle(spark, log, tmp_path):
    plan.meter_samples(log).write.parquet(str(tmp_path / "s"))
    text = explained(plan.parking_time(spark.read.parquet(str(tmp_path / "s"))))
    tree = text.split("\n\n\n")[0]
    assert tree.count("Exchange") == 1
    assert "EqualTo(measurand,Power.Active.Import)" in text and "IsNull(phase)" in text
