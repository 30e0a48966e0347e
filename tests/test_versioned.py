"""Stored tables: merges rewrite what they touch, versions switch at once."""

from pathlib import Path

import pytest
from helpers import rows
from pyspark.sql import functions as F

from gridops.sinks import tables as t
from gridops.sinks.versioned import Conflict, StoredTable

KIND = "day string, k int, v string"


@pytest.fixture
def table(spark, fresh):
    out = StoredTable(spark, str(fresh / "t"), ["day", "k"], place=F.col("day"))
    out.replace(spark.createDataFrame([(f"d{d}", k, "old") for d in range(4) for k in range(3)], KIND))
    return out


def files(table):
    """Names of the files that the last version has, by place."""
    places = table.manifest()["places"]
    return {p: sorted(x.name for x in Path(f"{table.path}/data/{f}").glob("*.parquet")) for p, f in places.items()}


def content(table, version=None):
    return rows(table.read(version), "day", "k", "v")


def test_upsert_rewrites_only_what_it_touches_and_repeats_without_effect(spark, table):
    before, first = files(table), content(table)
    incoming = spark.createDataFrame([("d1", 1, "new"), ("d1", 1, "older"), ("d9", 0, "x"), ("d2", 2, "old")], KIND)
    assert table.upsert(incoming) == ["d1", "d9"]  # d2's row is there already
    after = files(table)
    assert {p for p in before if before[p] != after[p]} == {"d1"} and set(after) - set(before) == {"d9"}
    want = {(d, k): v for d, k, v in first} | {("d1", 1): "older", ("d9", 0): "x"}
    assert content(table) == sorted(((d, k, v) for (d, k), v in want.items()), key=str)
    version = table.manifest()["version"]
    assert table.upsert(incoming) == [] and table.manifest()["version"] == version and files(table) == after
    assert content(table, 1) == first  # the version before can still be read


def test_insert_ignore_leaves_stored_rows(spark, table):
    before = files(table)
    incoming = spark.createDataFrame([("d1", 1, "new"), ("d3", 7, "b"), ("d3", 7, "a")], KIND)
    assert table.insert_ignore(incoming) == ["d3"] and table.insert_ignore(incoming) == []
    assert ("d1", 1, "old") in content(table) and ("d3", 7, "a") in content(table) and len(content(table)) == 13
    assert {p for p, f in files(table).items() if before[p] != f} == {"d3"}


def test_hashed_places_and_null_keys(spark, fresh):
    table = StoredTable(spark, str(fresh / "h"), ["k"], buckets=8)
    with pytest.raises(FileNotFoundError):
        table.read()
    a = spark.createDataFrame([(k, "a") for k in range(40)] + [(None, "n")], "k int, v string")
    assert len(table.insert_ignore(a)) == 8
    touched = table.upsert(spark.createDataFrame([(5, "b"), (None, "m")], "k int, v string"))
    assert len(touched) in (1, 2) and rows(table.read().where("k = 5 OR k IS NULL"), "k", "v") == [(5, "b"), (None, "m")]
    assert table.upsert(a.limit(0)) == [] and table.read().count() == 41


def test_failing_write_leaves_the_old_table(spark, fresh):
    path = str(fresh / "alerts")
    good = spark.createDataFrame([(1, "2024-01-01 00:00:00")], "grid_id int, timestamp string")
    t.truncate_reload(good, path)
    broken = good.withColumn("grid_id", F.raise_error(F.lit("source died")).cast("int"))
    with pytest.raises(Exception, match="source died"):
        t.truncate_reload(broken, path)
    assert t.read_reloaded(spark, path).count() == 1
    # The new rows may come from the table itself.
    twice = t.read_reloaded(spark, path)
    assert t.truncate_reload(twice.union(twice).withColumn("timestamp", F.col("timestamp").cast("string")), path).count() == 2


def test_second_writer_of_one_version_is_refused(spark, table):
    seen = table.manifest()
    table.upsert(spark.createDataFrame([("d0", 0, "first")], KIND))
    with pytest.raises(Conflict):
        table._commit(seen, seen["schema"], seen["places"])
    assert ("d0", 0, "first") in content(table)


def test_vacuum_keeps_what_the_last_versions_need(spark, table):
    for v in ("a", "b", "c"):
        table.upsert(spark.createDataFrame([("d0", 0, v)], KIND))
    now = content(table)
    assert table.vacuum(keep=2) == 2 and table.versions() == [3, 4] and content(table) == now
    assert content(table, 3) != now


def test_merge_reads_only_the_places_it_meets(spark, table):
    from gridops.operators.layout import explain_plan

    manifest = table.manifest()
    plan = explain_plan(table._frame(manifest, {p: f for p, f in manifest["places"].items() if p == "d1"}))
    assert "d1" in plan and "d2" not in plan


def test_reload_writes_every_task_for_itself(spark, fresh):
    path = str(fresh / "reload")
    rows_ = spark.range(0, 4000, 1, 4).select("id", F.lit("2024-01-01 00:00:00").alias("timestamp"))
    assert t.truncate_reload(rows_, path).count() == 4000
    assert len(list(fresh.rglob("*.parquet"))) == 4  # not all rows in one task
    assert t.truncate_reload(rows_.where("id < 0"), path).count() == 0 and t.read_reloaded(spark, path).columns == ["id", "timestamp"]
