import random

from helpers import at, rows

from gridops.operators.asof import anomaly_as_of, as_of, features_as_of
from gridops.schema import FEATURES

ALERT = "grid_id int, timestamp timestamp_ntz, alert_type string, current_activity double, baseline_activity double, reason string"


def facts(spark, data):
    return spark.createDataFrame([(g, at(h), v) for g, h, v in data], "grid_id int, fact_time timestamp_ntz, v int")


def probes(spark, data):
    return spark.createDataFrame([(g, at(h)) for g, h in data], "grid_id int, probe_timestamp timestamp_ntz")


def test_matches_brute_force_with_a_hot_grid(spark):
    rng = random.Random(5)
    data = sorted({(rng.choice([1, 1, 1, 2, 3]), rng.randrange(0, 400)) for _ in range(150)})
    data = [(g, h, i) for i, (g, h) in enumerate(data)]
    asked = [(rng.choice([1, 1, 1, 1, 2, 4]), rng.uniform(-50, 500)) for _ in range(300)]
    asked += [(1, h) for g, h, _ in data[:20] if g == 1] * 2  # equal times and repeated probes
    got = as_of(probes(spark, asked), facts(spark, data), "fact_time", ["v"])
    want = []
    for g, h in asked:
        before = [(fh, v) for fg, fh, v in data if fg == g and fh <= h]
        want.append((g, at(h), *((at(max(before)[0]), max(before)[1]) if before else (None, None))))
    assert rows(got, "grid_id", "probe_timestamp", "fact_time", "v") == sorted(want, key=str)


def features(spark, data):
    kinds = ", ".join(f"{f} {'bigint' if f == 'active_hours' else 'double'}" for f in FEATURES)
    return spark.createDataFrame(data, f"grid_id int, feature_timestamp timestamp_ntz, {kinds}")


def test_features_with_a_missing_value_are_returned_as_invalid(spark):
    df = features(spark, [(1, at(0), 1.0, 1.0, 2, 1.0, 1.0, 1.0), (1, at(5), 1.0, None, 2, 1.0, 1.0, 1.0)])
    got = features_as_of(df, probes(spark, [(1, 3), (1, 5), (1, -1), (8, 3)]))
    assert rows(got, "probe_timestamp", "feature_timestamp", "data_quality") == [
        (at(3), at(0), "valid"),
        (at(5), at(5), "invalid"),
    ]
    assert features_as_of(df).first().data_quality == "invalid"
    assert features_as_of(df).first().feature_freshness == "current"


def test_alert_ties_take_the_first_type(spark):
    df = spark.createDataFrame(
        [
            (1, at(0), "High Activity", 30.0, 10.0, "r"),
            (1, at(0), "Activity Spike", 30.0, 20.0, "s"),
            (2, at(0), "High Activity", None, 10.0, "r"),
            (3, at(0), "High Activity", 5.0, None, "r"),
            (4, at(0), "High Activity", 5.0, 0.0, "r"),
        ],
        ALERT,
    )
    got = anomaly_as_of(df, probes(spark, [(g, 1) for g in (1, 2, 3, 4)]))
    assert rows(got, "grid_id", "alert_type", "anomaly_score") == [
        (1, "Activity Spike", 50.0),
        (2, "High Activity", -100.0),
        (3, "High Activity", None),
        (4, "High Activity", None),
    ]
    assert rows(anomaly_as_of(df), "grid_id", "anomaly_score")[0] == (1, 50.0)
