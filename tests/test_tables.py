from helpers import at, hourly, rows
from pyspark.sql import functions as F

from gridops.operators import joins
from gridops.operators.layout import cached, partition_sizes, repartition_by_date
from gridops.session import bounded_broadcast, scratch_path
from gridops.sinks import tables as t
from gridops.sinks import writers as w
from gridops.sources import files as src
from gridops.sources.jdbc import jdbc_options


def pairs(spark, data):
    return spark.createDataFrame(data, "k int, a string, b int")


def test_insert_ignore_keeps_stored_rows_and_is_idempotent(spark):
    stored, incoming = pairs(spark, [(1, "old", 1)]), pairs(spark, [(1, "new", 2), (2, "y", 5), (2, "x", 9)])
    once = t.insert_ignore(stored, incoming, ["k"])
    assert rows(once, "k", "a", "b") == [(1, "old", 1), (2, "x", 9)]
    assert rows(t.insert_ignore(once, incoming, ["k"]), "k", "a", "b") == rows(once, "k", "a", "b")
    assert rows(t.insert_ignore(stored, incoming, ["k"], ["b"]), "k", "a") == [(1, "old"), (2, "y")]


def test_upsert_replaces_and_is_idempotent(spark):
    stored, incoming = pairs(spark, [(1, "old", 1), (3, "c", 3)]), pairs(spark, [(1, "new", 2), (2, "x", 5), (2, "y", 1)])
    once = t.upsert(stored, incoming, ["k"], ["b"])
    assert rows(once, "k", "a", "b") == [(1, "new", 2), (2, "x", 5), (3, "c", 3)]
    assert rows(t.upsert(once, incoming, ["k"], ["b"]), "k", "a", "b") == rows(once, "k", "a", "b")


def test_key_only_table(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(t.insert_ignore(df.limit(0), df, ["k"]), "k") == [(1,), (2,)]


def test_star_schema(spark, tables):
    dim, fact = t.build_dim_time(tables.hourly), t.build_fact(tables.hourly)
    assert joins.star_join(fact, dim).count() == tables.hourly.count()
    row = dim.where("timestamp = '2024-01-01 05:00:00'").first()
    assert (row.time_key, row.hour, row.day) == (1704085200, 5, "Monday")
    orphans = joins.check_foreign_keys(fact, {"time_key": dim.where("hour <> 5")})
    assert orphans.first().orphan_rows == tables.hourly.where("hour(timestamp) = 5").count()


def test_round_trip_notices_changed_content(spark, fresh):
    df = hourly(spark, [(1, h, float(h)) for h in range(20)])
    path = str(fresh / "t")
    w.write_parquet(df, path)
    assert tuple(w.verify_round_trip(df, path).first()) == (20, 20, True, True)
    changed = df.withColumn("total_activity", F.col("total_activity") + 1)
    assert tuple(w.verify_round_trip(changed, path).first())[2:] == (True, False)


def test_partitioned_output_has_one_folder_per_date(spark, fresh):
    path = str(fresh / "p")
    w.write_partitioned(hourly(spark, [(1, h, 1.0) for h in range(72)]).withColumn("date", F.to_date("timestamp")), path)
    assert sorted(x.name for x in (fresh / "p").iterdir() if x.is_dir()) == [f"date=2024-01-0{d}" for d in (1, 2, 3)]
    pruned = spark.read.parquet(path).where("date = '2024-01-02'")
    assert pruned.count() == 24
    assert w.output_size(spark, path).first().files >= 3


def test_output_status(spark, fresh):
    path = str(fresh / "done")
    w.write_parquet(hourly(spark, [(1, 0, 1.0)]), path)
    both = w.output_status(spark, {"a": path, "b": str(fresh / "never")})
    assert rows(both, "output", "available", "status") == [("a", True, "partial"), ("b", False, "partial")]
    assert w.output_status(spark, {"a": path}).first().status == "healthy"
    assert w.output_status(spark, {"a": path}).first().last_modified is not None


def test_truncate_reload(spark, fresh):
    path = str(fresh / "alerts")
    schema = "grid_id int, timestamp string"
    t.truncate_reload(spark.createDataFrame([(9, "2024-01-01 00:00:00")] * 3, schema), path)
    got = t.truncate_reload(spark.createDataFrame([(1, "2024-01-01 00:00:00"), (2, "soon")], schema), path)
    assert rows(got, "grid_id", "timestamp") == [(1, at(0)), (2, None)]


def test_optional_inputs(spark, fresh):
    keys, types = ["grid_id", "timestamp"], {"prediction": "double"}
    df = hourly(spark, [(1, 0, 1.0)]).select(*keys)
    path = str(fresh / "x")
    assert src.read_optional(spark, path, [*keys, "prediction"]) is None
    w.write_parquet(df, path)
    assert src.read_optional(spark, path, [*keys, "prediction"]) is None
    assert src.join_optional(df, None, keys, types).dtypes[-1] == ("prediction", "double")
    assert src.read_optional(spark, path, keys).columns == keys


def test_rows_to_df(spark):
    assert src.rows_to_df(spark, [("a", 21)], ["name", "age"]).columns == ["name", "age"]


def test_broadcast_only_inside_the_bounds(spark):
    from gridops.operators.layout import explain_plan

    small, big = spark.range(10), spark.range(100_000)
    plan = explain_plan(big.join(bounded_broadcast(small, max_rows=9), "id"))
    hinted = explain_plan(big.join(bounded_broadcast(small, max_rows=10), "id"))
    assert "strategy=broadcast" not in plan and "BroadcastHashJoin" in hinted


def test_repartition_leaves_a_hot_date_to_aqe(spark):
    from gridops.operators.layout import explain_plan

    df = spark.range(20_000).select(F.expr("date_add(date'2024-01-01', int(id % 3))").alias("date"), "id")
    assert "REBALANCE_PARTITIONS_BY_COL" in explain_plan(repartition_by_date(df))
    assert partition_sizes(repartition_by_date(df)).agg(F.sum("rows")).first()[0] == 20_000


def test_cache_is_released(spark):
    df = hourly(spark, [(1, 0, 1.0)])
    with cached(df) as kept:
        assert kept.is_cached
    assert not df.is_cached


def test_scratch_follows_the_session_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_path(spark, "x")
    assert path != scratch_path(spark, "x") and (root is None or path.startswith(root))


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "t", {"user": "u"}, {"column": "id", "lower": 0, "upper": 9, "num": 4})
    assert got == {
        "user": "u", "url": "jdbc:x", "dbtable": "t",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "9", "numPartitions": "4",
    }
