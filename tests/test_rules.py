from helpers import at, hourly, rows
from pyspark.sql import functions as F

from gridops.functions import scoring as sc
from gridops.operators import joins, ranking
from gridops.operators.rules import detect_anomalies, rule_alerts, score_anomalies


def test_three_rules_are_independent(spark):
    df = hourly(spark, [(1, 0, 100.0), (1, 1, 150.0), (1, 2, 100.0), (1, 3, 40.0)])
    got = rows(rule_alerts(df, floor=40), "timestamp", "alert_type", "baseline_activity")
    assert got == [
        (at(1), "Activity Spike", 100.0),
        (at(1), "High Activity", 100.0),
        (at(3), "Activity Drop", 100.0),
    ]


def test_floor_applies_after_the_baseline(spark):
    df = hourly(spark, [(1, 0, 50.0), (1, 1, 150.0), (1, 2, 99.0)])
    got = rows(rule_alerts(df), "timestamp", "alert_type", "reason")
    assert got == [
        (at(1), "Activity Spike", "Current activity is 3.00x times the previous activity"),
        (at(1), "High Activity", "Current activity is 2.01x times the within baseline"),
    ]


def test_zero_baseline_fires_with_infinite_ratio(spark):
    df = hourly(spark, [(1, 0, 0.0), (1, 1, 120.0), (1, 2, 0.0)])
    got = rows(rule_alerts(df), "alert_type", "reason")
    assert got == [
        ("Activity Spike", "Current activity is infx times the previous activity"),
        ("High Activity", "Current activity is infx times the within baseline"),
    ]
    # At floor 0 an idle hour over an idle baseline also fires, with no number to show.
    idle = rule_alerts(hourly(spark, [(1, 0, 0.0), (1, 1, 0.0)]), floor=0)
    assert {r.reason.split()[3] for r in idle.collect()} == {"nanx"}


def test_single_row_day_raises_nothing(spark):
    assert rule_alerts(hourly(spark, [(1, 23, 500.0), (1, 24, 5000.0)])).count() == 0


def test_ratio_text_rounds_the_stored_binary_value(spark):
    df = spark.createDataFrame([(1.625, 1.0), (1.005, 1.0), (12345.678, 1.0)], "a double, b double")
    assert [r[0] for r in df.select(sc.ratio_text("a", "b")).collect()] == ["1.62", "1.00", "12345.68"]


def test_reason_score(spark):
    texts = [
        "Current activity is 1.57x times the previous activity",
        "Current activity is infx times the within baseline",
        "no ratio here",
        "about x times",
        None,
        "2.00 x times and 9.00x times",
    ]
    df = spark.createDataFrame([(x,) for x in texts], "reason string")
    assert [r[0] for r in df.select(sc.reason_score("reason")).collect()] == [57.0, float("inf"), None, None, None, 100.0]


def test_missing_score_ranks_above_drops(spark):
    rows_ = [
        (1, at(0), "Activity Drop", 50.0, 100.0, "Current activity is 0.50x times less than the baseline activity"),
        (2, at(0), "High Activity", 40.0, None, "unreadable"),
        (3, at(0), "High Activity", 30.0, 10.0, "Current activity is 3.00x times the within baseline"),
    ]
    schema = "grid_id int, timestamp timestamp_ntz, alert_type string, current_activity double, baseline_activity double, reason string"
    got = ranking.highest_anomaly_scores(spark.createDataFrame(rows_, schema), 3).collect()
    assert [(r.grid_id, r.anomaly_score_percent) for r in got] == [(3, 200.0), (2, None), (1, -50.0)]


def test_anomaly_thresholds_are_inclusive(spark):
    df = hourly(spark, [(1, 0, 100.0), (1, 24, 150.0), (1, 48, 50.0), (1, 72, 100.0), (1, 96, 149.0)])
    got = rows(score_anomalies(df), "timestamp", "anomaly_flag", "direction", "reason")
    assert [(r[1], r[2]) for r in got] == [(0, "NORMAL"), (1, "HIGH"), (1, "LOW"), (0, "NORMAL"), (0, "NORMAL")]
    assert got[1][3] == "Activity is 50.0% above the historical baseline"
    assert got[0][3] == "Activity is within the historical baseline range"


def test_zero_baseline_scores_zero(spark):
    got = score_anomalies(hourly(spark, [(1, 0, 0.0), (1, 24, 0.0), (1, 48, 5.0)]))
    assert got.agg(F.sum("anomaly_flag")).first()[0] == 0


def test_detector_comparison(spark):
    df = hourly(spark, [(1, 0, 100.0), (1, 24, 150.0), (1, 48, 100.0)])
    alone = detect_anomalies(df)
    assert len(alone.columns) == 13
    assert rows(alone.distinct(), "prediction", "np3_anomaly_disagreement")[0] == (None, None)
    predictions = spark.createDataFrame([(1, at(0), 1.0), (1, at(24), 1.0)], "grid_id int, timestamp timestamp_ntz, prediction double")
    alert = "grid_id int, timestamp timestamp_ntz, alert_type string"
    alerts = spark.createDataFrame([(1, at(24), "a"), (1, at(24), "b"), (1, at(48), "a")], alert)
    got = detect_anomalies(df, predictions, alerts)
    assert rows(got, "timestamp", "ml3_anomaly_disagreement", "np3_anomaly_disagreement") == [
        (at(0), 1, 0),
        (at(24), 0, 0),
        (at(48), 0, 1),
    ]


def test_risk_join_without_anomalies_has_typed_nulls(spark):
    risk = spark.createDataFrame(
        [(1, at(0), 0.7, "high", "v")],
        "grid_id int, feature_timestamp timestamp_ntz, risk_score double, risk_level string, model_version string",
    )
    out = joins.join_risk_anomaly(risk, None)
    assert dict(out.dtypes)["anomaly_flag"] == "int" and out.first().reason is None


def test_top_attention_orders_by_size_of_anomaly(spark):
    df = spark.createDataFrame(
        [(1, at(0), 0.9, -80.0), (2, at(0), 0.9, None), (3, at(0), 0.9, 70.0), (4, at(0), 0.95, None)],
        "grid_id int, timestamp timestamp_ntz, risk_score double, anomaly_score double",
    )
    assert [r.grid_id for r in ranking.top_attention(df, 3).collect()] == [4, 1, 3]


def test_levels_and_labels(spark):
    df = spark.createDataFrame([(0.7,), (0.69999,), (0.4,), (0.1,)], "s double")
    assert [r[0] for r in df.select(sc.risk_level("s")).collect()] == ["high", "medium", "medium", "low"]
    text = spark.createDataFrame([("High Activity",), ("medium",), ("Alert!",), ("Activity Drop",), (None,)], "t string")
    assert [r[0] for r in text.select(sc.status_label("t")).collect()] == ["HIGH", "ATTENTION", "ATTENTION", "NORMAL", "NORMAL"]


def test_filter_alerts(spark):
    df = hourly(spark, [(1, 0, 100.0), (1, 1, 400.0), (2, 0, 100.0), (2, 1, 400.0)])
    alerts = rule_alerts(df)
    from gridops.operators.clean import filter_alerts

    assert filter_alerts(alerts).count() == 4 == filter_alerts(alerts, severity="all").count()
    assert filter_alerts(alerts, severity="Activity Spike").count() == 2
    assert filter_alerts(alerts, severity="HIGH").count() == 2
    assert filter_alerts(alerts, as_of=at(9).isoformat()).count() == 0


def test_watchlist_and_map(spark):
    hot = spark.createDataFrame([(1, at(0), 9.0, "High Activity")], "grid_id int, timestamp timestamp_ntz, total_activity double, status string")
    alerts = spark.createDataFrame(
        [(1, at(0), 12.0, "Activity Spike", "r"), (2, at(0), None, "MEDIUM", "r")],
        "grid_id int, timestamp timestamp_ntz, total_activity double, status string, reason string",
    )
    listed = ranking.watchlist(hot, alerts, 3)
    assert [(r.position, r.grid_id, r.status) for r in listed.orderBy("position").collect()] == [
        (1, 1, "NORMAL"),
        (2, 1, "HIGH"),
        (3, 2, "ATTENTION"),
    ]
    geo = spark.createDataFrame([(1, "{}"), (2, "{}"), (3, "{}")], "grid_id int, geometry string")
    assert rows(joins.map_status(geo, listed), "grid_id", "status") == [(1, "NORMAL"), (2, "ATTENTION"), (3, "NORMAL")]


def test_hotspots_break_ties_by_grid(spark):
    df = hourly(spark, [(3, 0, 5.0), (1, 0, 5.0), (2, 0, 7.0), (9, -1, 99.0)])
    from gridops.operators.clean import derive_totals
    from gridops.schema import CHANNELS

    full = derive_totals(df.select("grid_id", "timestamp", *[F.col("total_activity").alias(c) for c in CHANNELS]))
    assert [r.grid_id for r in ranking.hotspots(full, k=2).collect()] == [2, 1]
    assert rows(ranking.hotspots_each_hour(full, 1), "grid_id", "position") == [(2, 1), (9, 1)]
