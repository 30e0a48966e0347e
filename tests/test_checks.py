"""The adapter's known counts, and every registered query beside its SQL."""

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_point
from checks import ORACLES, QUERIES
from checks.adapter import Tables
from checks.compare import compare, duck
from gridops.ml.labels import label_relative, label_threshold
from gridops.operators.profile import cleaning_report
from gridops.operators.rules import rule_alerts


@pytest.mark.parametrize(
    "sf, raw, rejected, kept, hourly, features",
    [("0.001", 1000, 14, 986, 939, 234), ("0.01", 10_000, 142, 9_858, 9_436, 2_388)],
)
def test_adapter_counts(spark, sf, raw, rejected, kept, hourly, features):
    t = Tables(spark, f"/root/testdata/sf{sf}")
    report = cleaning_report(t.raw).first()
    assert (report.rows_before, report.rejected, report.rows_after) == (raw, rejected, kept)
    assert t.hourly.count() == hourly and t.features.count() == features


def test_adapter_alerts_anomalies_and_labels(spark):
    t = Tables(spark, "/root/testdata/sf0.01")
    by_type = {r.alert_type: r.n for r in rule_alerts(t.hourly).groupBy("alert_type").count().withColumnRenamed("count", "n").collect()}
    assert by_type == {"High Activity": 1071, "Activity Spike": 665, "Activity Drop": 4}
    directions = {r.direction: r.n for r in t.anomalies.groupBy("direction").count().withColumnRenamed("count", "n").collect()}
    assert directions == {"HIGH": 2822, "LOW": 1342, "NORMAL": 5272}
    relative = label_relative(t.hourly)
    assert (relative.count(), relative.where("target = 1").count()) == (8386, 2990)
    assert label_threshold(t.hourly).where("target = 1").count() == 1328


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["grid_id", "total_activity"] and df.count() == 10


def test_names():
    assert set(ORACLES) <= set(QUERIES) and len(QUERIES) > 120
    assert entry_point.queries().keys() >= QUERIES.keys() and entry_point.oracle_sql().items() >= ORACLES.items()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert isinstance(con, duckdb.DuckDBPyConnection)
    assert compare(spark, con, name, SMALL).startswith("ok")
