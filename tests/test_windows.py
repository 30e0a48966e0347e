import random
import statistics

from helpers import at, hourly, rows
from pyspark.sql import functions as F

from gridops.ml import labels as lab
from gridops.operators import windows as w
from gridops.operators.aggregate import baseline_median, class_balance, history_summary


def series(seed=1, n=120, grids=(1, 2)):
    rng = random.Random(seed)
    out = []
    for g in grids:
        h = 0
        for _ in range(n):
            h += rng.choice([1, 1, 1, 2, 5])
            out.append((g, h, round(rng.choice([0, 10, rng.random() * 300]), 2)))
    return out


def test_features_match_a_plain_loop(spark):
    data = series()
    got = {(r.grid_id, r.feature_timestamp): r for r in w.build_features(hourly(spark, data)).collect()}
    expected = 0
    for g in (1, 2):
        values = [(h, v) for gg, h, v in data if gg == g]
        for i, (h, _) in enumerate(values):
            if i < 47:
                assert (g, at(h)) not in got
                continue
            frame = [v for _, v in values[i - 23 : i + 1]]
            earlier = sum(v for _, v in values[i - 47 : i - 23])
            row = got[(g, at(h))]
            expected += 1
            assert abs(row.avg_activity - sum(frame) / 24) < 1e-9
            assert row.active_hours == sum(v > 0 for v in frame)
            assert abs(row.variability - statistics.stdev(frame)) < 1e-6
            assert abs(row.peak_ratio - max(frame) / (sum(frame) / 24)) < 1e-9
            assert abs(row.activity_growth - (sum(frame) - earlier) / earlier) < 1e-9
            assert abs(row.internet_share - 0.5) < 1e-9
    assert len(got) == expected


def test_short_and_idle_series(spark):
    assert w.build_features(hourly(spark, [(1, h, 5.0) for h in range(47)])).count() == 0
    idle = w.build_features(hourly(spark, [(1, h, 0.0) for h in range(50)])).collect()
    assert len(idle) == 3
    assert {(r.peak_ratio, r.activity_growth, r.internet_share, r.active_hours) for r in idle} == {(0.0, 0.0, 0.0, 0)}


def test_time_frame_ignores_rows_older_than_a_day(spark):
    df = hourly(spark, [(1, 0, 100.0), (1, 30, 10.0), (1, 31, 20.0)])
    by_rows = w.build_features(df, min_rows=3).first().avg_activity
    by_time = w.build_features(df, frame="time", min_rows=3).first().avg_activity
    assert abs(by_rows - 130 / 3) < 1e-9 and by_time == 15.0


def test_leave_one_out_median_matches_brute_force(spark):
    rng = random.Random(3)
    data = [(g, h, float(rng.choice([1, 2, 2, 3, 7, 50]))) for g in (1, 2) for h in range(48) if rng.random() < 0.6]
    data.append((3, 5, 9.0))  # alone in its day
    df = hourly(spark, data).withColumn("date", F.to_date("timestamp"))
    got = {(r.grid_id, r.timestamp): r.baseline_activity for r in w.leave_one_out_median(df).collect()}
    for g, h, _ in data:
        rest = [v for gg, hh, v in data if gg == g and hh // 24 == h // 24 and hh != h]
        assert got[(g, at(h))] == (statistics.median(rest) if rest else None)


def test_leave_one_out_median_of_a_missing_value(spark):
    df = hourly(spark, [(1, 0, None), (1, 1, 4.0), (1, 2, 8.0)]).withColumn("date", F.to_date("timestamp"))
    assert rows(w.leave_one_out_median(df), "total_activity", "baseline_activity") == [(4.0, 8.0), (8.0, 4.0), (None, 6.0)]


def test_previous_resets_at_midnight(spark):
    df = hourly(spark, [(1, 22, 1.0), (1, 23, 2.0), (1, 24, 3.0)]).withColumn("date", F.to_date("timestamp"))
    assert rows(w.previous_in_day(df), "total_activity", "previous_activity") == [(1.0, None), (2.0, 1.0), (3.0, None)]


def test_prior_median_needs_six_rows(spark):
    got = [r.baseline_24h for r in w.prior_median(hourly(spark, [(1, h, h) for h in range(30)])).orderBy("timestamp").collect()]
    assert got[:6] == [None] * 6 and got[6] == 2.5 and got[29] == statistics.median(range(5, 29))


def test_relative_label(spark):
    values = [10.0] * 7 + [15.0, 14.99, 3.0]
    got = rows(lab.label_relative(hourly(spark, [(1, h, v) for h, v in enumerate(values)])), "timestamp", "target")
    assert [t for _, t in got] == [1, 0, 0]


def test_threshold_label_is_strict_and_drops_the_last_row(spark):
    got = rows(lab.label_threshold(hourly(spark, [(1, 0, 1.0), (1, 1, 100.0), (1, 2, 100.01)])), "timestamp", "target")
    assert [t for _, t in got] == [0, 1]


def test_percentile_label_reads_training_period_only(spark):
    df = hourly(spark, [(1, h, 10.0) for h in range(10)] + [(1, 10, 20.0), (1, 11, 1000.0)])
    got = lab.label_percentile(df, at(9).isoformat())
    assert got.agg(F.sum("target")).first()[0] == 2


def test_chronological_split_keeps_ties_together(spark):
    df = hourly(spark, [(g, h, 1.0) for h in range(5) for g in range(4)])
    train, test = lab.split_chronological(df, 0.5, "timestamp")
    assert train.count() == 8 and test.count() == 12
    assert train.agg(F.max("timestamp")).first()[0] < test.agg(F.min("timestamp")).first()[0]
    first, rest = lab.split_chronological(df, 0.1, "timestamp")
    assert first.count() == 0 and rest.count() == 20


def test_chronological_split_over_many_days(spark):
    df = hourly(spark, [(1, h * 5, 1.0) for h in range(100)])
    train, test = lab.split_chronological(df, 0.8, "timestamp")
    assert (train.count(), test.count()) == (80, 20)


def test_date_split(spark):
    import pytest

    df = hourly(spark, [(1, 24 * d, 1.0) for d in range(6)])
    train, test = lab.split_by_date(df, 4, 6, "timestamp")
    assert (train.count(), test.count()) == (4, 2)
    with pytest.raises(ValueError, match="expected 5 dates, found 6"):
        lab.split_by_date(df, 4, 5, "timestamp")


def test_baseline_is_a_value_that_occurs(spark):
    df = hourly(spark, [(1, 24 * d, v) for d, v in enumerate([1.0, 2.0, 10.0, 50.0])]).withColumn("hour", F.hour("timestamp"))
    assert baseline_median(df, ["grid_id", "hour"]).first().baseline_activity == 2.0
    assert baseline_median(df, ["grid_id", "hour"], exact=True).first().baseline_activity == 2.0


def test_history_summary(spark):
    df = hourly(spark, [(1, 0, 100.0), (1, 30, 1.0), (1, 31, 2.0), (1, 40, 9.0), (2, 40, 1.0)])
    one, two = history_summary(df).orderBy("grid_id").collect()
    assert (one.points_summarized, one.min_total_activity, one.max_total_activity) == (2, 1.0, 2.0)
    assert (one.avg_total_activity, one.trend_hint, one.newest_historical_timestamp) == (1.5, "rising", at(31))
    assert (two.points_summarized, two.trend_hint, two.oldest_timestamp) == (0, None, None)


def test_class_balance(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "target int")
    assert rows(class_balance(df), "target", "n", "share") == [(0, 3, 0.75), (1, 1, 0.25)]
    weight = lab.with_class_weight(df)
    assert rows(weight.distinct(), "target", "weight") == [(0, 1.0), (1, 3.0)]
