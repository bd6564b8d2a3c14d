"""What must hold for the plan of every registered query."""

import re

import pytest

from ledgerline.queries import all_queries
from tests.conftest import explained

# Streams write their result; the plan left is a plain scan.
LAZY = sorted(n for n in all_queries() if not n.endswith("_stream"))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, sf, name):
    plan = explained(all_queries()[name](spark, sf))
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert not re.search("EvalPython|InPandas|InArrow|SerializeFromObject", plan)


def scan_columns(plan):
    return [line.split("struct<")[1] for line in plan.splitlines() if line.startswith("ReadSchema")]


@pytest.mark.parametrize(
    "name, columns",
    [
        ("group_stats", {"l_quantity", "l_returnflag", "l_linestatus"}),
        ("win_running_total", {"o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"}),
        ("idle_time", {"user_id", "ts", "value"}),
        ("global_sort_topk", {"o_orderkey", "o_custkey", "o_totalprice"}),
        ("histogram", {"o_totalprice"}),
    ],
)
def test_scans_read_only_what_is_used(spark, sf, name, columns):
    for read in scan_columns(explained(all_queries()[name](spark, sf))):
        assert {c.split(":")[0] for c in read.strip(">").split(",") if ":" in c} <= columns


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("in_or_predicate", "Or(In(c_custkey, [1,2,99]),EqualTo(c_mktsegment,BUILDING))"),
        ("check_violations", "LessThan(c_acctbal,0.0)"),
        ("generated_partition", "EqualTo(o_orderdate"),
        ("rows_of_day", "LessThan(ts,2024-01-16"),
    ],
)
def test_filters_reach_the_scan(spark, sf, name, pushed):
    plan = explained(all_queries()[name](spark, sf))
    assert any(pushed in line for line in plan.splitlines() if line.startswith("PushedFilters"))


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("latest_per_user", 1),
        ("idle_time", 1),
        ("win_lag_lead", 1),
        ("win_rank", 1),
        ("win_running_total", 1),
        ("win_partition_agg", 1),
        ("as_of_version", 1),
        ("clean_chart_rows", 1),
        ("update_where", 0),
        ("delete_where", 0),
        ("math_basic", 0),
        ("jitter_time", 0),
        ("pseudonymise", 0),
    ],
)
def test_number_of_shuffles(spark, sf, name, shuffles):
    tree = explained(all_queries()[name](spark, sf)).split("\n\n\n")[0]
    assert len(re.findall("Exchange", tree)) <= shuffles
