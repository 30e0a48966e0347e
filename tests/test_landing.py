import json

import pytest
from helpers import rows

from gridops.plans import landing as ld
from gridops.plans import batch
from gridops.plans.batch import run_batch, run_incremental
from gridops.sources.files import discover_files, file_provenance, read_activity_csv
from gridops.streaming.landing import ingest_arrivals

HEAD = "datetime,CellID,countrycode,smsin,smsout,callin,callout,internet"
NOW = "2024-02-01T00:00:00+00:00"


def name(day):
    return f"sms-call-internet-mi-2024-01-{day:02d}.csv"


def good(day, n=3):
    return "\n".join([HEAD] + [f"2024-01-{day:02d} {h:02d}:00:00,{h + 1},39,0.5,,1.5,2.0,{h}.25" for h in range(n)]) + "\n"


FILES = {
    name(1): good(1),
    name(2): "internet,callout,callin,smsout,smsin,countrycode,CellID,datetime\n9.0,1.0,,2.0,3.0,39,7,2024-01-02 00:00:00\n\n",
    name(3): "datetime,CellID,smsin,smsout,callin,callout\n2024-01-03 00:00:00,1,1,1,1,1\n",
    name(4): HEAD + ",note,extra\n2024-01-04 00:00:00,1,39,1,1,1,1,1,x,y\n",
    name(5): HEAD + "\n",
    name(6): HEAD + "\nsoon,1,39,1,1,1,1,1\n2024-01-06 01:00:00,1,39,1,1,1,1,1\n,2,39,1,1,1,1,1\n",
    name(7): HEAD + "\n2024-01-07 00:00:00,,39,1,1,1,1,1\n",
    name(8): "",
    name(9): HEAD + "\n2024-01-09 00:00:00,1,39,1,1,1,1,1,8\n",
    name(10): HEAD + "\n2024-01-10 00:00:00,1,39,-1,word,1,1,1\n",
    name(11): f'"{HEAD.replace(",", chr(34) + "," + chr(34))}"\r\n"2024-01-11 00:00:00","4","39","1","2","3","4","5"\r\n',
    "notes.txt": "ignored",
    "sms-call-internet-mi-2024-01-12.csv.bak": good(12),
}

WANT = {
    name(1): ("VALID", 3, "SCHEMA_AND_QUALITY_VALIDATION_PASSED"),
    name(2): ("VALID", 1, "SCHEMA_AND_QUALITY_VALIDATION_PASSED"),
    name(3): ("REJECTED", 1, "SCHEMA_VALIDATION_FAILED: missing required column(s): ['countrycode', 'internet']"),
    name(4): ("REJECTED", 1, "SCHEMA_VALIDATION_FAILED: unexpected column(s): ['extra', 'note']"),
    name(5): ("REJECTED", 0, "MINIMUM_QUALITY_FAILED: file contains zero rows"),
    name(6): ("REJECTED", 3, "MINIMUM_QUALITY_FAILED: malformed timestamp values found: 2"),
    name(7): ("REJECTED", 1, "MINIMUM_QUALITY_FAILED: NULL grid_id values found: 1"),
    name(8): ("REJECTED", 0, "CSV_READ_ERROR: no columns to parse from file"),
    name(9): ("REJECTED", 1, "CSV_READ_ERROR: rows with too many fields: 1"),
    name(10): ("VALID", 1, "SCHEMA_AND_QUALITY_VALIDATION_PASSED; non-numeric values stored as NULL: 1"),
    name(11): ("VALID", 1, "SCHEMA_AND_QUALITY_VALIDATION_PASSED"),
}


@pytest.fixture
def zone(fresh):
    landing = fresh / "landing"
    landing.mkdir()
    for file, text in FILES.items():
        (landing / file).write_text(text, newline="")
    return str(landing), *[str(fresh / x) for x in ("raw", "rejected", "audit")]


def outcome(df):
    return {r.filename: (r.status, r.row_count, r.reason) for r in df.collect()}


def test_ingest_routes_every_file(spark, zone):
    got = outcome(ld.ingest_landing(spark, *zone, NOW))
    assert got == WANT
    raw = spark.read.parquet(zone[1])
    assert raw.count() == 3 + 1 + 1 + 1
    assert rows(raw.where("CellID = 7"), "datetime", "smsin", "smsout", "callin", "internet") == [
        ("2024-01-02 00:00:00", 3.0, 2.0, None, 9.0)
    ]
    assert rows(raw.where("CellID = 4"), "datetime", "internet") == [("2024-01-11 00:00:00", 5.0)]
    rejected = spark.read.parquet(zone[2])
    assert rejected.where(f"source_file = '{name(6)}'").count() == 4  # header line included


def test_second_run_skips_and_adds_nothing(spark, zone):
    ld.ingest_landing(spark, *zone, NOW)
    before = spark.read.parquet(zone[1]).count()
    again = outcome(ld.ingest_landing(spark, *zone, "2024-02-02T00:00:00+00:00"))
    assert set(again.values()) == {("SKIPPED", 0, ld.ALREADY)} and len(again) == len(WANT)
    assert spark.read.parquet(zone[1]).count() == before
    assert ld.read_audit(spark, zone[3]).count() == 2 * len(WANT)


def test_run_that_died_before_its_audit_repeats_without_duplicates(spark, zone, fresh):
    ld.ingest_landing(spark, *zone, NOW)
    before = spark.read.parquet(zone[1]).count()
    got = outcome(ld.ingest_landing(spark, *zone[:3], str(fresh / "audit2"), NOW))
    assert got == WANT and spark.read.parquet(zone[1]).count() == before


def test_strict_quality(spark, zone):
    files = discover_files(spark, zone[0])
    lines = ld.landing_lines(spark, files)
    got = {r.filename: r.reason for r in ld.validate_minimum_quality(files, lines, strict=True).collect()}
    assert got[name(10)] == "MINIMUM_QUALITY_FAILED: negative activity values found in smsin: 1"
    assert got[name(1)] == "MINIMUM_QUALITY_PASSED"


def test_quality_names_missing_columns(spark, zone):
    files = discover_files(spark, zone[0])
    got = {r.filename: r.reason for r in ld.validate_minimum_quality(files, ld.landing_lines(spark, files)).collect()}
    assert got[name(3)].endswith("because columns are missing: ['countrycode', 'internet']")


def test_stream_of_arrivals_sees_new_files_only(spark, zone, fresh):
    args = (*zone, str(fresh / "checkpoint"))
    assert outcome(ingest_arrivals(spark, *args, NOW)) == WANT
    assert outcome(ingest_arrivals(spark, *args, "2024-02-02T00:00:00+00:00")) == {}
    (fresh / "landing" / name(20)).write_text(good(20, 5))
    late = outcome(ingest_arrivals(spark, *args, "2024-02-03T00:00:00+00:00"))
    assert late == {name(20): ("VALID", 5, "SCHEMA_AND_QUALITY_VALIDATION_PASSED")}
    assert spark.read.parquet(zone[1]).count() == 6 + 5
    log = spark.read.parquet(zone[3])
    assert log.count() == len(WANT) + 1 and log.where(f"filename = '{name(20)}'").first().processed_at.startswith("2024-02-03")


def test_run_over_new_files_reads_no_old_row(spark, zone, fresh):
    args = (*zone, str(fresh / "checkpoint"))
    ingest_arrivals(spark, *args, NOW)
    # What was ingested and logged before can no longer be read.
    for old in [*(fresh / "raw").rglob("*.parquet"), *(fresh / "rejected").rglob("*.parquet"), *(fresh / "audit").rglob("*.parquet")]:
        (old.parent / f".{old.name}.crc").unlink(missing_ok=True)
        old.write_bytes(b"no longer readable")
    (fresh / "landing" / name(20)).write_text(good(20, 5))
    assert outcome(ingest_arrivals(spark, *args, NOW)) == {name(20): ("VALID", 5, "SCHEMA_AND_QUALITY_VALIDATION_PASSED")}


def test_batch_that_spark_repeats_is_told_by_its_number(spark, zone, fresh):
    args = (*zone, str(fresh / "checkpoint"))
    ingest_arrivals(spark, *args, NOW)
    before = {p.name for p in (fresh / "raw").rglob("*.parquet")}
    for commit in (fresh / "checkpoint" / "commits").iterdir():
        commit.unlink()  # as if the run had died before its commit
    again = outcome(ingest_arrivals(spark, *args, "2024-02-02T00:00:00+00:00"))
    assert again == {k: v for k, v in WANT.items() if k != name(8)}  # the empty file is no part of the stream
    assert {p.name for p in (fresh / "raw").rglob("*.parquet")} == before
    # Without its log the batch is done again, and replaces what it wrote.
    for commit in (fresh / "checkpoint" / "commits").iterdir():
        commit.unlink()
    (fresh / "audit" / "batch=0" / "_SUCCESS").unlink()
    ingest_arrivals(spark, *args, "2024-02-03T00:00:00+00:00")
    assert spark.read.parquet(zone[1]).count() == 6 and {p.name for p in (fresh / "raw").rglob("*.parquet")} != before


def test_batches_of_bounded_size(spark, zone, fresh):
    got = outcome(ingest_arrivals(spark, *zone, str(fresh / "checkpoint"), NOW, files_per_batch=4))
    assert got == WANT and sorted(p.name for p in (fresh / "audit").glob("batch=?")) == ["batch=0", "batch=1", "batch=2", "batch=3"][: len(list((fresh / "audit").glob("batch=?")))]
    assert spark.read.parquet(zone[1]).count() == 6


def test_every_file_is_read_twice_at_most(spark, zone, monkeypatch):
    read, lines = [], ld.landing_lines

    def counted(session, files):
        read.extend(r["file_name"] for r in files.select("file_name").collect())
        return lines(session, files)

    monkeypatch.setattr(ld, "landing_lines", counted)
    ld.ingest_landing(spark, *zone, NOW)
    assert sorted(read) == sorted([*WANT, *WANT])


def test_survey_is_one_scan(spark, zone):
    from gridops.operators.layout import explain_plan

    files = discover_files(spark, zone[0])
    plan = explain_plan(ld.survey_files(files, ld.landing_lines(spark, files)))
    assert plan.count("FileScan text") + plan.count("Scan text") >= 1
    assert len([line for line in plan.splitlines() if line.strip().startswith(("+- FileScan text", "* FileScan text"))]) <= 1
    assert "partial_min_by" in plan


def test_discovery(spark, zone, fresh):
    found = discover_files(spark, zone[0]).collect()
    assert [r.file_name for r in found] == sorted(WANT) and str(found[0].file_date) == "2024-01-01"
    with pytest.raises(FileNotFoundError):
        discover_files(spark, str(fresh / "absent"))
    with pytest.raises(NotADirectoryError):
        discover_files(spark, f"{zone[0]}/{name(1)}")
    with pytest.raises(FileNotFoundError):
        discover_files(spark, zone[0], r"^other-.*$", require_match=True)


def test_fixed_schema_refuses_a_reordered_header(spark, zone):
    assert read_activity_csv(spark, f"{zone[0]}/{name(1)}").count() == 3
    assert file_provenance(read_activity_csv(spark, f"{zone[0]}/{name(1)}")).first().file_name == name(1)
    with pytest.raises(Exception, match="(?i)header"):
        read_activity_csv(spark, f"{zone[0]}/{name(2)}").collect()


def test_batch_end_to_end(spark, fresh):
    source = fresh / "in"
    source.mkdir()
    (source / name(1)).write_text(good(1, 24))
    (source / name(2)).write_text(good(2, 2) + ",1,39,1,1,1,1,1\n2024-01-02 03:00:00,1,39,-1,1,1,1,1\n")
    ring = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    features = [{"properties": {"cellId": i}, "geometry": {"type": "Polygon", "coordinates": [ring]}} for i in range(1, 24)]
    (fresh / "grid.geojson").write_text(json.dumps({"features": features}))
    report = run_batch(spark, str(source), str(fresh / "grid.geojson"), str(fresh / "out"))
    assert {r.stage: r.rows for r in report.collect()} == {
        "read": 28, "null_activity": 26, "rejected": 2, "clean": 26,
        "hourly_grid_summary": 26, "enriched": 26, "grids_without_geometry": 1,
    }
    top = spark.read.option("header", True).csv(str(fresh / "out" / "dashboard"))
    assert top.count() == 10 and set(top.columns) == {"grid_id", "total_activity"}
    with pytest.raises(FileNotFoundError):
        run_batch(spark, str(fresh / "out"), str(fresh / "grid.geojson"), str(fresh / "out2"))


def test_ids_are_stored_or_the_file_is_refused(spark, fresh):
    landing = fresh / "landing"
    landing.mkdir()
    head = "datetime,CellID,countrycode,smsin,smsout,callin,callout,internet\n"
    first, second = (f"sms-call-internet-mi-2013-11-0{d}.csv" for d in (1, 2))
    (landing / first).write_text(head + "2013-11-01 00:00:00,5.0,39.0,1,1,1,1,x\n")
    (landing / second).write_text(head + "2013-11-02 00:00:00,abc,39,1,1,1,1,1\n")
    for spelled in (str(landing), f"file://{landing}", f"{landing}/."):
        out = [str(fresh / f"{name}-{abs(hash(spelled))}") for name in ("raw", "rejected", "audit")]
        got = {r["filename"]: (r["status"], r["reason"]) for r in ld.ingest_landing(spark, spelled, *out, "2024-01-01T00:00:00Z").collect()}
        assert got[first] == ("VALID", "SCHEMA_AND_QUALITY_VALIDATION_PASSED; non-numeric values stored as NULL: 1")
        assert got[second][0] == "REJECTED" and got[second][1].endswith("not whole numbers found: 1")
        row = spark.read.parquet(out[0]).first()
        assert (row["CellID"], row["countrycode"], row["internet"]) == (5, 39, None)


def test_batch_reads_only_files_of_the_pattern(spark, fresh):
    source = fresh / "source"
    source.mkdir()
    head = "datetime,CellID,countrycode,smsin,smsout,callin,callout,internet\n"
    (source / "sms-call-internet-mi-2013-11-01.csv").write_text(head + "2013-11-01 00:00:00,5.0,39,1,1,1,1,1\n")
    (source / "notes.csv").write_text(head + "2013-11-01 00:00:00,7,39,1,1,1,1,1\n")
    geo = fresh / "geo.json"
    geo.write_text('{"type":"FeatureCollection","features":[{"properties":{"cellId":5},"geometry":{"type":"Point","coordinates":[1,2]}}]}')
    counts = {r["stage"]: r["rows"] for r in run_batch(spark, str(source), str(geo), str(fresh / "out")).collect()}
    assert (counts["read"], counts["rejected"], counts["clean"]) == (1, 0, 1)


@pytest.fixture
def days(fresh):
    source = fresh / "in"
    source.mkdir()
    for d in (1, 2, 3):
        (source / name(d)).write_text(good(d, 24))
    ring = [[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]
    features = [{"properties": {"cellId": i}, "geometry": {"type": "Polygon", "coordinates": [ring]}} for i in range(1, 24)]
    (fresh / "grid.geojson").write_text(json.dumps({"features": features}))
    return source, (str(source), str(fresh / "grid.geojson"), str(fresh / "out"))


def changes(df):
    return {str(r.date): r.change for r in df.collect()}


def part_files(fresh):
    tables = ("clean", "hourly_grid_summary", "enriched", "daily")
    return {(t, p.name): {f.name for f in p.glob("*.parquet")} for t in tables for p in (fresh / "out" / t).glob("date=*")}


def same_as_whole(spark, args, fresh, label):
    run_batch(spark, args[0], args[1], str(fresh / label))
    read = lambda root, table: spark.read.parquet(f"{root}/{table}")
    for table in ("hourly_grid_summary", "enriched"):
        whole = read(str(fresh / label), table)
        assert rows(read(args[2], table), *whole.columns) == rows(whole, *whole.columns)
    columns = [c for c in read(str(fresh / label), "clean").columns if c != "date"]
    assert rows(read(args[2], "clean"), *columns) == rows(read(str(fresh / label), "clean"), *columns)
    top = lambda root: rows(spark.read.option("header", True).csv(f"{root}/dashboard"), "grid_id", "total_activity")
    assert top(args[2]) == top(str(fresh / label))


def test_second_run_with_one_new_day_rewrites_one_date(spark, days, fresh):
    source, args = days
    assert changes(run_incremental(spark, *args)) == {f"2024-01-0{d}": "added" for d in (1, 2, 3)}
    same_as_whole(spark, args, fresh, "whole1")
    before = part_files(fresh)
    assert changes(run_incremental(spark, *args)) == {} and part_files(fresh) == before
    (source / name(4)).write_text(good(4, 9))
    assert changes(run_incremental(spark, *args)) == {"2024-01-04": "added"}
    after = part_files(fresh)
    assert {k for k in after if before.get(k) != after[k]} == {(t, "date=2024-01-04") for t in ("clean", "hourly_grid_summary", "enriched", "daily")}
    same_as_whole(spark, args, fresh, "whole2")


def test_changed_and_removed_files(spark, days, fresh):
    source, args = days
    run_incremental(spark, *args)
    # One day's rows move to another, which then has rows of two files; one file goes; one has nothing left.
    (source / name(1)).write_text(good(2, 5) + "2024-01-02 20:00:00,,39,1,1,1,1,1\n")
    (source / name(3)).unlink()
    assert changes(run_incremental(spark, *args)) == {"2024-01-01": "changed", "2024-01-02": "added", "2024-01-03": "changed"}
    assert {k[1] for k in part_files(fresh)} == {"date=2024-01-02"}
    same_as_whole(spark, args, fresh, "whole")
    (source / name(1)).write_text(HEAD + "\n")
    assert changes(run_incremental(spark, *args)) == {"2024-01-02": "changed"}
    same_as_whole(spark, args, fresh, "whole2")


def test_run_that_dies_is_repeated_in_whole(spark, days, fresh, monkeypatch):
    source, args = days
    run_incremental(spark, *args)
    (source / name(1)).write_text(good(2, 5))

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(batch, "hourly_grid_summary", dies)
    with pytest.raises(RuntimeError, match="lost"):
        run_incremental(spark, *args)
    monkeypatch.undo()
    assert set(changes(run_incremental(spark, *args))) == {"2024-01-01", "2024-01-02"}
    same_as_whole(spark, args, fresh, "whole")


def test_profile_expands_no_row(spark):
    from gridops.operators.layout import explain_plan
    from gridops.operators.profile import distinct_profile

    df = spark.createDataFrame([(1, "a", None), (1, None, 2.0), (3, "a", None)], "x int, y string, z double")
    assert "Expand" not in explain_plan(distinct_profile(df))
    assert rows(distinct_profile(df), "column_name", "distinct_values", "distinct_with_null") == [("x", 2, 2), ("y", 1, 2), ("z", 1, 2)]
