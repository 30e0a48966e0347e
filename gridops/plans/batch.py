"""The whole batch: read, clean, aggregate, enrich, write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.operators import clean as c
from gridops.operators.aggregate import hourly_grid_summary
from gridops.operators.joins import enrich_geometry, missing_geometry
from gridops.operators.profile import cleaning_report
from gridops.operators.ranking import top_grids
from gridops.schema import FILE_PATTERN, ID_COLUMNS, RAW_SCHEMA, RENAMES
from gridops.session import file_system, path_exists
from gridops.sinks.versioned import StoredTable
from gridops.sinks.writers import write_csv, write_parquet, write_partitioned
from gridops.sources.files import discover_files, read_activity_csv, read_geojson_lookup


#: Ids are read as numbers, so that 5.0 is grid 5 and not a rejected row.
_WIDE = T.StructType([T.StructField(f.name, T.DoubleType() if f.name in ID_COLUMNS else f.dataType) for f in RAW_SCHEMA])


def _typed(raw: DataFrame) -> DataFrame:
    """Rows of the files with stored names and types, and the verdict of the quarantine."""
    raw = c.coerce_types(c.rename_columns(raw))
    whole = lambda c: F.when(F.col(c) == F.floor(c), F.col(c).try_cast("int"))
    raw = raw.withColumns({RENAMES[c]: whole(RENAMES[c]) for c in ID_COLUMNS})
    return raw.withColumn("verdict", F.when(c.is_rejected(), "rejected").otherwise("kept"))


def run_batch(
    spark: SparkSession, source: str, reference: str, output: str, pattern: str = FILE_PATTERN
) -> DataFrame:
    """Run every stage and return (stage, rows). A failing stage raises.

    The CSV files are parsed once, into a typed Parquet table split by the
    quarantine verdict. Each later stage reads the table the stage before wrote, so
    a lost executor costs at most its share of one stage, and row counts come from
    Parquet footers and stay exact when tasks are repeated.
    """
    root = output.rstrip("/")
    names = ("typed", "clean", "hourly_grid_summary", "dashboard", "enriched")
    paths = {name: f"{root}/{name}" for name in names}
    # One path per daily file; what does not match the pattern is not read.
    files = [row["path"] for row in discover_files(spark, source, pattern, require_match=True).toLocalIterator()]

    _typed(read_activity_csv(spark, files, _WIDE)).write.mode("overwrite").partitionBy("verdict").parquet(paths["typed"])
    typed = spark.read.parquet(paths["typed"])

    good = typed.where(F.col("verdict") == "kept").drop("verdict")
    write_partitioned(c.derive_calendar(c.derive_totals(c.impute_zero(good))), paths["clean"])
    write_parquet(hourly_grid_summary(spark.read.parquet(paths["clean"])), paths["hourly_grid_summary"])

    hourly = spark.read.parquet(paths["hourly_grid_summary"])
    geo = read_geojson_lookup(spark, reference)
    write_parquet(enrich_geometry(hourly, geo), paths["enriched"])
    write_csv(top_grids(hourly), paths["dashboard"])

    report = cleaning_report(typed).first()
    counts = [
        ("read", report["rows_before"]),
        ("null_activity", report["null_activity"]),
        ("rejected", report["rejected"]),
        ("clean", spark.read.parquet(paths["clean"]).count()),
        ("hourly_grid_summary", hourly.count()),
        ("enriched", spark.read.parquet(paths["enriched"]).count()),
        ("grids_without_geometry", missing_geometry(hourly, geo).count()),
    ]
    return spark.createDataFrame(counts, "stage string, rows bigint")


def _replace_parts(df: DataFrame, path: str, column: str, values: list[str]) -> None:
    """Replace the partitions ``values`` of the table at ``path`` by the rows of ``df``; others keep their files."""
    spark = df.sparkSession
    df.hint("rebalance", column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    # A partition that lost all its rows is not overwritten by any.
    left = {str(r[0]) for r in df.select(column).distinct().collect()} if values else set()
    for value in values:
        if value not in left:
            system, own = file_system(spark, f"{path}/{column}={value}")
            system.delete(own, True)


def run_incremental(spark: SparkSession, source: str, reference: str, output: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """Bring the outputs of the batch up to date; ``date, change`` of the dates that were written anew.

    A table of the files (name, length, time of change) tells which are new, changed or gone since the last
    run. Only these are parsed, into a partition per file; the dates that they have now or had before
    are the ones whose clean rows, hourly summary and enrichment are computed and replaced, from all
    files that touch them. Other dates keep their files. The dashboard is taken from daily sums. The dates
    that rows leave are noted before the rows are replaced, and the table of files is changed last, so a run
    that dies is repeated in whole and gives the same.
    """
    root = output.rstrip("/")
    paths = {name: f"{root}/{name}" for name in ("typed", "clean", "hourly_grid_summary", "daily", "dashboard", "enriched")}
    known = StoredTable(spark, f"{root}/files", ["file_name"], buckets=16)
    found = discover_files(spark, source, pattern).select("file_name", "path", "length", "modified")
    before = known.read().where("length >= 0") if known.versions() else found.where("false")
    now, then = ({(r["file_name"], r["length"], r["modified"]): r for r in df.collect()} for df in (found, before))
    fresh = [r for k, r in now.items() if k not in then]
    gone = sorted({k[0] for k in then} - {k[0] for k in now})
    names = sorted({r["file_name"] for r in fresh} | set(gone))
    if not names:
        return spark.createDataFrame([], "date date, change string")
    dates: dict = {}
    pending = f"{root}/pending"

    def note(change: str) -> None:
        rows = spark.read.parquet(paths["typed"]).where((F.col("verdict") == "kept") & F.col("source_file").isin(names))
        for r in rows.select(F.to_date("timestamp").alias("date")).distinct().collect():
            dates.setdefault(r["date"], change)

    if path_exists(spark, f"{pending}/_SUCCESS"):  # of a run that died
        dates |= {r["date"]: "changed" for r in spark.read.schema("date date").parquet(pending).collect()}
    if path_exists(spark, paths["typed"]):
        note("changed")
        spark.createDataFrame([(d,) for d in sorted(dates)], "date date").write.mode("append").parquet(pending)
    if fresh:
        rows = _typed(read_activity_csv(spark, [r["path"] for r in fresh], _WIDE).withColumn("source_file", F.col("_metadata.file_name")))
        _replace_parts(rows, paths["typed"], "source_file", sorted({r["file_name"] for r in fresh} & {k[0] for k in then}))
        note("added")
    for name in gone:
        system, own = file_system(spark, f"{paths['typed']}/source_file={name}")
        system.delete(own, True)
    days = sorted(dates)
    if days:
        kept = spark.read.parquet(paths["typed"]).where(F.col("verdict") == "kept").drop("verdict", "source_file")
        good = kept.where(F.to_date("timestamp").isin(days))
        texts = [str(d) for d in days]
        _replace_parts(c.derive_calendar(c.derive_totals(c.impute_zero(good))), paths["clean"], "date", texts)
        clean = spark.read.parquet(paths["clean"]).where(F.col("date").isin(days))
        dated = lambda df: df.withColumn("date", F.to_date("timestamp"))
        _replace_parts(dated(hourly_grid_summary(clean)), paths["hourly_grid_summary"], "date", texts)
        hourly = spark.read.parquet(paths["hourly_grid_summary"]).where(F.col("date").isin(days))
        _replace_parts(enrich_geometry(hourly, read_geojson_lookup(spark, reference)), paths["enriched"], "date", texts)
        sums = hourly.groupBy("date", "grid_id").agg(F.sum("total_activity").alias("total_activity"))
        _replace_parts(sums, paths["daily"], "date", texts)
        write_csv(top_grids(spark.read.parquet(paths["daily"])), paths["dashboard"])
    files = [(r["file_name"], r["length"], r["modified"]) for r in fresh] + [(n, -1, -1) for n in gone]
    known.upsert(spark.createDataFrame(files, "file_name string, length bigint, modified bigint"))
    system, own = file_system(spark, pending)
    system.delete(own, True)
    return spark.createDataFrame(sorted(dates.items()), "date date, change string")
