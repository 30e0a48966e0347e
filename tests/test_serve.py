import json
from datetime import timedelta

from helpers import at, hourly, rows
from pyspark.sql import functions as F

from gridops.operators.aggregate import alert_proportion, alert_top_grids, busiest_grid, peak_hour_of_day
from gridops.plans import serve
from gridops.schema import FEATURES


def test_network_summary(spark):
    df = hourly(spark, [(1, 0, 5.0), (1, 1, 1.0), (2, 0, 4.0), (3, 1, 0.0), (2, 25, 100.0)])
    row = serve.network_summary(df, at(24).isoformat()).first()
    assert (row.total_activity, row.active_grids, row.peak_hour, row.top_grid, row.as_of) == (10.0, 2, 0, 1, at(24))
    assert serve.network_summary(df).first().top_grid == 2
    assert serve.network_summary(df, at(-5).isoformat()).isEmpty()


def test_ties_go_to_the_lowest_key(spark):
    df = hourly(spark, [(2, 0, 5.0), (1, 1, 5.0), (3, 2, 5.0)])
    row = serve.network_summary(df).first()
    assert (row.peak_hour, row.top_grid) == (0, 1)
    assert peak_hour_of_day(df).first().hour == 0 and busiest_grid(df).first().grid_id == 1


def test_sums_that_differ_only_by_addition_order_tie(spark):
    df = hourly(spark, [(2, 0, 0.1), (2, 1, 0.2), (2, 2, 0.3), (1, 3, 0.6)])
    assert busiest_grid(df).first().grid_id == 1


def evidence(spark):
    grids = spark.createDataFrame([(1,), (2,)], "grid_id int")
    current = hourly(spark, [(1, 0, 5.0)])
    history = spark.createDataFrame([(1, None)], "grid_id int, points bigint")
    status = spark.createDataFrame([("hourly", True), ("risk", False)], "output string, available boolean")
    shared = {"network_summary": serve.network_summary(current), "status": status, "hotspots": status.where("false")}
    return serve.evidence_parts(grids, {"current": current, "history": history}, shared)


def test_gaps_and_packages(spark):
    parts = evidence(spark)
    gaps = {r.grid_id: [tuple(g) for g in r.gaps] for r in serve.evidence_gaps(parts, {"history": "daily"}, {"history": "current"}).collect()}
    assert gaps == {
        1: [("hotspots", "hotspots", "no rows")],
        2: [("current", "current", "no rows"), ("history", "daily", "skipped, current is missing"), ("hotspots", "hotspots", "no rows")],
    }
    got = {r.grid_id: json.loads(r.package) for r in serve.evidence_package(parts, ["history"]).collect()}
    assert got[1]["current_evidence"]["network_summary"][0]["top_grid"] == 1
    assert [r["available"] for r in got[2]["current_evidence"]["status"]] == [True, False]
    assert got[1]["current_evidence"]["current"]["total_activity"] == 5.0 and got[1]["current_evidence"]["hotspots"] is None
    assert got[1]["historical_evidence"] == {"history": {"points": None}}  # a missing value stays visible
    assert got[2]["current_evidence"]["current"] is None
    assert [g["evidence"] for g in got[2]["uncertainty"]] == ["current", "history", "hotspots"]
    dump = {r.grid_id: json.loads(r.package) for r in serve.evidence_dump(parts).collect()}
    assert set(dump[2]) == {"grid_id", "current", "history", "network_summary", "status", "hotspots"}


def test_nearby_hotspots(spark):
    near = spark.createDataFrame([(1, 2, 3, 0.2), (1, 1, 2, 0.1), (2, 1, 1, 0.1)], "grid_id int, position int, nearby_grid_id int, distance_degrees double")
    hot = spark.createDataFrame([(3,), (3,)], "grid_id int")
    got = {r.grid_id: ([c.nearby_grid_id for c in r.nearby_cells], r.nearby_hotspots) for r in serve.nearby_hotspots(near, hot).collect()}
    assert got == {1: ([2, 3], 1), 2: ([1], 0)}


def test_evidence_sufficient(spark):
    kinds = ", ".join(f"{f} double" for f in FEATURES)
    schema = f"id int, current_activity double, baseline_activity double, anomaly_score double, evidence_timestamp timestamp_ntz, {kinds}"
    full = [1.0] * 6
    data = [
        (1, 150.0, 100.0, 50.0, at(20), *full),
        (2, None, 100.0, 50.0, at(20), *full),
        (3, 150.0, 0.0, 50.0, at(20), *full),
        (4, 150.0, 100.0, 50.0, at(20) - timedelta(hours=25), *full),
        (5, 150.0, 100.0, -50.0, at(20), *full),
        (6, 150.0, 100.0, None, at(20), *full),
        (7, 150.0, 100.0, 50.0, at(20), *full[:5], None),
    ]
    got = serve.evidence_sufficient(spark.createDataFrame(data, schema), at(20).isoformat())
    reasons = {r.id: (r.evidence_sufficient, r.insufficiency_reason) for r in got.collect()}
    assert reasons == {
        1: (True, None),
        2: (False, "missing value"),
        3: (False, "no baseline"),
        4: (False, "stale"),
        5: (False, "inconsistent"),
        6: (False, "missing value"),
        7: (False, "missing value"),
    }


def alerts(spark, data):
    schema = "grid_id int, timestamp timestamp_ntz, alert_type string, current_activity double, baseline_activity double, reason string"
    return spark.createDataFrame([(g, at(h), kind, float(v), 1.0, "r") for g, h, kind, v in data], schema)


def test_alert_summaries(spark):
    df = alerts(spark, [(1, 5, "b", 9), (1, 5, "a", 8), (2, 5, "a", 7), (3, 4, "a", 99)])
    grids = spark.createDataFrame([(1,), (2,), (3,)], "grid_id int")
    got = serve.alert_history_summary(df, grids)
    assert rows(got, "grid_id", "alerts_checked", "matching_grid_alerts", "matching_alert_types") == [
        (1, 3, 2, ["a", "b"]),
        (2, 3, 1, ["a"]),
        (3, 3, 0, []),
    ]
    cut = serve.alert_history_summary(df, grids, k=1)
    assert rows(cut, "grid_id", "matching_grid_alerts") == [(1, 1), (2, 0), (3, 0)]
    assert [tuple(r) for r in alert_top_grids(df, 2).collect()] == [(1, 2), (2, 1)]
    share = alert_proportion(df, hourly(spark, [(g, h, 1.0) for g in (1, 2, 3) for h in (4, 5)])).first()
    assert tuple(share) == (3, 6, 0.5)
    assert alert_proportion(df.where(F.lit(False)), hourly(spark, [])).first().proportion is None


def test_evidence_reads_the_events_once(spark):
    from checks import area_rules
    from checks.adapter import Tables
    from conftest import SMALL

    t = Tables(spark, SMALL)
    assert any("events.parquet" in f for f in t.hourly.inputFiles())
    found = area_rules._evidence(t)
    assert not any("events.parquet" in f for f in found.inputFiles()) and found.count() == t.cells.count()
