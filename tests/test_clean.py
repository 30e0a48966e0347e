import pytest
from helpers import at, raw, rows
from pyspark.sql import functions as F

from gridops.operators import aggregate as a
from gridops.operators import clean as c
from gridops.operators import profile as p
from gridops.schema import CHANNELS, RENAMES


def sample(spark):
    return raw(
        spark,
        [
            (at(0), 1, 39, 1.0, None, 2.0, None, 3.0),
            (at(0), 1, 39, 1.0, None, 2.0, None, 3.0),
            (at(0), 1, 1, None, None, None, None, None),
            (None, 1, 39, 1.0, 1.0, 1.0, 1.0, 1.0),
            (at(1), None, 39, 1.0, 1.0, 1.0, 1.0, 1.0),
            (at(1), 2, None, -0.5, 1.0, 1.0, 1.0, 1.0),
            (at(25), 2, None, 0.0, 0.0, 0.0, 0.0, 0.0),
        ],
    )


def test_quarantine_splits_exactly(spark):
    rejected, kept = c.quarantine(sample(spark))
    assert rejected.count() == 3 and kept.count() == 4
    assert sorted(r.reason for r in rejected.collect()) == ["negative_activity", "null_grid", "null_timestamp"]


def test_reject_reasons_combine(spark):
    df = raw(spark, [(None, None, 1, -1.0, None, None, None, None)])
    assert c.quarantine(df)[0].first().reason == "null_grid,null_timestamp,negative_activity"


def test_impute_and_totals(spark):
    kept = c.derive_calendar(c.derive_totals(c.impute_zero(c.quarantine(sample(spark))[1])))
    first = kept.where("country_code = 39").first()
    assert (first.total_sms, first.total_calls, first.total_activity) == (1.0, 2.0, 6.0)
    assert (str(first.date), first.hour, first.day_of_week) == ("2024-01-01", 0, "Monday")


def test_hour_that_daylight_saving_skips_is_kept(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00' AS timestamp")
    from gridops.functions.time import epoch_seconds, hour_floor

    row = df.select(hour_floor("timestamp").alias("h"), epoch_seconds("timestamp").alias("e"), F.hour("timestamp").alias("x")).first()
    assert (str(row.h), row.e, row.x) == ("2024-03-10 02:00:00", 1710037800, 2)


def test_coerce_turns_bad_text_to_null(spark):
    df = spark.createDataFrame(
        [("2024-01-01 05:00:00", "1.5"), ("yesterday", "many")], "timestamp string, internet string"
    )
    assert rows(c.coerce_types(df), "internet") == [(1.5,), (None,)]
    assert c.coerce_types(df).where("timestamp IS NULL").count() == 1


def test_rename_keeps_unknown_columns(spark):
    df = spark.createDataFrame([(1, 2)], "CellID int, other int")
    assert c.rename_columns(df).columns == ["grid_id", "other"]
    assert set(RENAMES.values()) > {"grid_id", "timestamp"}


def test_internet_share_of_zero_activity_is_null(spark):
    df = c.derive_totals(sample(spark).where("timestamp > '2024-01-02'"))
    assert c.internet_share(df).first().internet_share is None


def test_hourly_total_equals_clean_total(spark, tables):
    clean, hourly = tables.clean, a.hourly_grid_summary(tables.clean)
    total = lambda df: df.agg(F.round(F.sum("total_activity"), 3)).first()[0]
    assert total(clean) == total(hourly)
    assert p.check_unique_key(hourly, ["timestamp", "grid_id"]).isEmpty()


def test_grid_time_summary_counts_null_group_as_zero(spark):
    df = raw(spark, [(at(0), 1, 39, None, None, None, None, None)])
    row = a.grid_time_summary(df).first()
    assert all(row[x] == 0.0 for x in CHANNELS) and row.total_activity == 0.0


def test_one_row_kpis(spark):
    df = raw(spark, [(at(0), 1, 1, 0.34, 0.54, 0.43, 0.67, 1.23)])
    grid_hour = a.grid_time_summary(df)
    assert (grid_hour.first().sms_in, grid_hour.first().sms_out) == (0.34, 0.54)
    assert a.daily_network_summary(grid_hour).first().unique_grids == 1
    assert a.grid_kpis(grid_hour).first().active_hours == 1


def test_profiles(spark):
    df = sample(spark)
    distinct = {r.column_name: (r.distinct_values, r.distinct_with_null) for r in p.distinct_profile(df).collect()}
    assert distinct["country_code"] == (2, 3) and distinct["timestamp"] == (3, 4) and distinct["internet"] == (3, 4)
    nulls = {r.column_name: r.nulls for r in p.null_profile(df).collect()}
    assert nulls["grid_id"] == 1 and nulls["sms_out"] == 3
    negatives = {r.column_name: r.negatives for r in p.negative_profile(df).collect()}
    assert negatives["sms_in"] == 1 and "timestamp" not in negatives
    assert p.duplicate_rows(df).first()[0] == 1
    assert p.duplicate_grain(df).first()[0] == 2
    report = p.cleaning_report(df).first()
    assert tuple(report) == (7, 4, 3, 3)


def test_duplicate_rows_of_empty_frame(spark):
    assert p.duplicate_rows(sample(spark).limit(0)).first()[0] == 0


def test_cadence(spark):
    day = [(at(h), 1, 39, 1.0, 1.0, 1.0, 1.0, 1.0) for h in range(24)]
    assert p.cadence_gaps(raw(spark, day)).first().complete
    assert not p.cadence_gaps(raw(spark, day[:5] + day[6:])).first().complete
    assert p.cadence_files(raw(spark, day), F.to_date("timestamp")).first().complete


def test_gaps_cross_days(spark):
    df = raw(spark, [(at(h), 1, 1, 1.0, 1.0, 1.0, 1.0, 1.0) for h in (0, 3, 26, 100)])
    assert rows(p.timestamp_gaps(df), "gap_seconds") == sorted([(None,), (3 * 3600,), (23 * 3600,), (74 * 3600,)], key=str)


def test_strict_checks_raise(spark):
    with pytest.raises(ValueError, match="1 rows with negative"):
        c.reject_negative(sample(spark))
    with pytest.raises(ValueError, match="missing columns: \\['risk'\\]"):
        c.require_columns(sample(spark), ["grid_id", "risk"])


def test_valid_grid_bounds(spark):
    df = spark.createDataFrame([(0,), (1,), (10000,), (10001,)], "grid_id int")
    assert rows(c.valid_grid(df), "grid_id") == [(1,), (10000,)]


def test_activity_window_includes_both_ends(spark):
    from helpers import hourly

    df = hourly(spark, [(1, h, 1.0) for h in range(0, 60)] + [(2, 70, 1.0)])
    assert c.activity_window(df, 1, at(50).isoformat()).count() == 24
    assert c.activity_window(df, 1).count() == 60 - 47
    assert c.activity_window(df, 1, at(50).isoformat(), date="2024-01-03", hour=1).count() == 1


def test_activity_window_of_a_larger_city(spark):
    from types import SimpleNamespace

    from checks.area_clean import activity_window, activity_window_hour
    from helpers import START, hourly

    zeros = {x: F.lit(0.0) for x in ("total_sms", "total_calls")}
    df = hourly(spark, [(70_000, 216 + h, 1.0) for h in range(24)] + [(2, 230, 1.0)]).withColumns(zeros)
    tables = SimpleNamespace(hourly=df, last_grid=70_000)
    assert START.day == 1 and activity_window(tables).count() == 24
    assert rows(activity_window_hour(tables), "grid_id", "timestamp") == [(70_000, at(216))]
    with pytest.raises(ValueError):
        c.activity_window(df, 70_001, last_grid=70_000)


def test_blocked_phrases_read_the_whole_text(spark):
    text = "x" * 50_000 + " The ROOT cause is unknown"
    df = spark.createDataFrame([(text,), ("fine",)], "text string")
    assert [r.phrases for r in c.blocked_phrases(df, "text").collect()] == [["root cause is"], []]


def test_compare_and_isin(spark):
    df = spark.createDataFrame([("a", 21), ("b", 22), ("c", 23)], "name string, age long")
    assert c.filter_compare(df, "age", ">", 30).count() == 0
    assert c.filter_compare(df, "age", "<=", 22).count() == 2
    assert c.filter_isin(df, "name", ["a", "c"]).count() == 2
