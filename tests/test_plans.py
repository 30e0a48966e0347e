"""Physical plans: pruning, pushdown, join strategy, number of exchanges, no Python in the plan."""

import re

import pytest
from helpers import at

from gridops.operators import aggregate, clean, joins, ranking, rules, windows
from gridops.operators.layout import explain_plan
from gridops.plans.serve import network_summary
from gridops.sinks.writers import write_parquet, write_partitioned


@pytest.fixture(scope="module")
def stored(spark, tables, tmp_path_factory):
    """The hourly table as a later stage reads it."""
    path = str(tmp_path_factory.mktemp("plans") / "hourly")
    write_parquet(tables.hourly, path)
    return spark.read.parquet(path)


def exchanges(plan: str) -> int:
    tree = plan.split("\n\n")[0]
    return len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange", tree))


def test_scan_reads_only_needed_columns(tables):
    plan = explain_plan(tables.raw.select("internet"))
    schema = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "event_type", "value"}


def test_features_need_one_exchange(stored):
    plan = explain_plan(windows.build_features(stored))
    assert exchanges(plan) == 1 and "ReadSchema: struct<timestamp:timestamp_ntz,grid_id:int,internet:double,total_activity:double>" in plan


def test_alert_windows_share_one_exchange(stored):
    assert exchanges(explain_plan(rules.rule_alerts(stored))) == 1


def test_fixed_as_of_is_pushed_to_the_scan(stored):
    plan = explain_plan(ranking.hotspots(stored, at(30).isoformat()))
    assert "EqualTo(timestamp,2024-01-02T06:00)" in plan and "TakeOrderedAndProject" in plan
    window = explain_plan(clean.activity_window(stored, 7, at(30).isoformat()))
    assert "EqualTo(grid_id,7)" in window and "GreaterThanOrEqual(timestamp" in window


def test_newest_time_is_a_scalar_subquery(stored):
    plan = explain_plan(ranking.hotspots(stored))
    assert "Subqueries" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_sums_are_partial_before_the_shuffle(tables):
    plan = explain_plan(aggregate.hourly_grid_summary(tables.clean))
    assert plan.count("partial_sum") >= 5 and exchanges(plan) == 1


def test_top_k_per_hour_is_cut_before_the_shuffle(stored):
    assert explain_plan(ranking.hotspots_each_hour(stored, 3)).count("WindowGroupLimit") >= 2


def test_geometry_joins(stored, tables):
    assert "BroadcastHashJoin" in explain_plan(joins.enrich_geometry(stored, tables.geo))
    assert "SortMergeJoin" in explain_plan(joins.enrich_geometry_shuffle(stored, tables.geo))


def test_network_summary_scans_the_measures_once(stored):
    plan = explain_plan(network_summary(stored))
    tree = plan.split("\n\n")[0]
    assert tree.count("Scan parquet") == 1


def test_date_filter_prunes_partitions(spark, tables, tmp_path):
    path = str(tmp_path / "clean")
    write_partitioned(tables.clean, path)
    plan = explain_plan(spark.read.parquet(path).where("date = DATE'2024-01-05'").select("internet"))
    assert re.search(r"PartitionFilters: \[.*date.*2024-01-05", plan)


def test_no_python_runs_per_row(tables):
    frames = [tables.features, tables.alerts, tables.anomalies, tables.geo]
    assert not any("Python" in explain_plan(df) or "ArrowEval" in explain_plan(df) for df in frames)
