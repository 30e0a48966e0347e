"""Landing zone: validate daily files, route them, record the decision.

Files are not moved. A file's rows go to the raw or the reject table in a
partition named after the file, and the decision goes to the audit table last.
A run that dies half-way therefore repeats without duplicates: its partitions
are overwritten, and files with an audit row are never read again.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridops.functions.time import parse_timestamp
from gridops.operators.layout import cached
from gridops.schema import AUDIT_SCHEMA, ID_COLUMNS, RAW_COLUMNS, RAW_SCHEMA
from gridops.session import bounded_broadcast, path_exists
from gridops.sinks.tables import append_audit
from gridops.sources.files import discover_files

# Fixed wording of the decisions.
READ_ERROR = "CSV_READ_ERROR: "
SCHEMA_FAILED = "SCHEMA_VALIDATION_FAILED: "
SCHEMA_PASSED = "SCHEMA_VALIDATION_PASSED"
QUALITY_FAILED = "MINIMUM_QUALITY_FAILED: "
QUALITY_PASSED = "MINIMUM_QUALITY_PASSED"
BOTH_PASSED = "SCHEMA_AND_QUALITY_VALIDATION_PASSED"
AS_TEXT = "; non-numeric values stored as NULL: "
ALREADY = "ALREADY_PROCESSED: file already exists in raw or rejected zone"


def landing_lines(spark: SparkSession, files: DataFrame) -> DataFrame:
    """Non-blank lines of the listed files with the file's name. Line breaks inside quotes are not supported.

    Only the paths, one per daily file, pass through the driver, as they do in any read.
    """
    paths = [row["path"] for row in files.select("path").toLocalIterator()]
    if not paths:
        empty = "value string, filename string, block bigint, line bigint"
        return spark.createDataFrame([], empty)
    lines = spark.read.text(paths)
    return lines.select(
        "value",
        F.col("_metadata.file_name").alias("filename"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).where(F.trim("value") != "")


def _cells(width: int = len(RAW_COLUMNS)) -> list[Column]:
    """The cells of a line in order, trimmed, an empty one as NULL; then what goes beyond them."""
    fields = F.from_csv("value", ", ".join(f"c{i} string" for i in range(width + 1)))
    return [*(F.nullif(F.trim(fields[f"c{i}"]), F.lit("")) for i in range(width)), fields[f"c{width}"]]


def survey_files(files: DataFrame, lines: DataFrame) -> DataFrame:
    """Per file ``filename, header, row_count, long_rows, places``: all that the checks need, from one pass over the text.

    The names of the columns are known only once the first line is, so every check is counted at every
    place of a line, and read later at the place that the header gives it. ``places`` has a struct per place:
    cells that are no timestamp, missing, no whole number, no number, negative. The header line counts like
    any other. One row per file is shuffled for each task that reads it.
    """
    width = len(RAW_COLUMNS)
    named = lines.select("filename", "value", "block", "line", F.array(*_cells()).alias("cells"))
    places = []
    for i in range(width):
        cell = F.get("cells", F.lit(i))
        given, number = cell.isNotNull(), cell.try_cast("double")
        counts = {
            "no_time": parse_timestamp(cell).isNull(),
            "missing": ~given,
            "no_id": given & stored_integer(cell).isNull(),
            "text": given & number.isNull(),
            "negative": number < 0,
        }
        places.append(F.struct(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in counts.items())))
    found = named.groupBy("filename").agg(
        F.min_by("value", F.struct("block", "line")).alias("first_line"),
        (F.count("*") - 1).alias("row_count"),
        F.count_if(F.get("cells", F.lit(width)).isNotNull()).alias("long_rows"),
        F.array(*places).alias("places"),
    )
    header = F.split(F.regexp_replace("first_line", '"', ""), ",")
    return files.select(F.col("file_name").alias("filename")).join(found, "filename", "left").select(
        "filename", header.alias("header"), F.coalesce("row_count", F.lit(0)).alias("row_count"), "long_rows", "places"
    )


def _quoted_list(items: Column) -> Column:
    quoted = F.transform(F.array_sort(items), lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.concat_ws(", ", quoted), F.lit("]"))


def _schema_failure() -> Column:
    required = F.array(*[F.lit(c) for c in RAW_COLUMNS])
    missing = F.array_except(required, F.col("header"))
    unexpected = F.array_except(F.col("header"), required)
    return (
        F.when(F.col("header").isNull(), READ_ERROR + "no columns to parse from file")
        .when(F.size(missing) > 0, F.concat(F.lit(SCHEMA_FAILED + "missing required column(s): "), _quoted_list(missing)))
        .when(
            F.size(unexpected) > 0,
            F.concat(F.lit(SCHEMA_FAILED + "unexpected column(s): "), _quoted_list(unexpected)),
        )
    )


def validate_schema(files: DataFrame, lines: DataFrame, survey: DataFrame | None = None) -> DataFrame:
    """Per file: filename, is_valid, reason of the first failure (or pass), row_count, header.

    ``survey`` takes the result of :func:`survey_files`, if there is one already.
    """
    survey = survey_files(files, lines) if survey is None else survey
    checked = survey.withColumn("failure", _schema_failure())
    return checked.select(
        "filename",
        F.col("failure").isNull().alias("is_valid"),
        F.coalesce("failure", F.lit(SCHEMA_PASSED)).alias("reason"),
        "row_count",
        "header",
    )


def _parsed(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines of files with a good header, as text columns named by that header (the header line included)."""
    *cells, beyond = _cells()
    rows = lines.join(bounded_broadcast(headers.select("filename", "header")), "filename")
    rows = rows.withColumns({"cells": F.array(*cells), "extra": beyond})
    return rows.withColumns({c: F.get("cells", F.array_position("header", F.lit(c)).cast("int") - 1) for c in RAW_COLUMNS})


def validate_minimum_quality(files: DataFrame, lines: DataFrame, strict: bool = False, survey: DataFrame | None = None) -> DataFrame:
    """Per file, first failure of: zero rows, missing columns, bad timestamps, missing grid ids, ids that are not whole.

    ``strict`` also refuses text or negative values in the activity columns. The
    header line is no timestamp, whole number or number, so one of each is expected.
    ``survey`` takes the result of :func:`survey_files`, if there is one already.
    """
    survey = survey_files(files, lines) if survey is None else survey
    at = lambda c: F.get("places", F.array_position("header", F.lit(c)).cast("int") - 1)
    channels = RAW_COLUMNS[3:]
    total = lambda name, columns: sum((at(c)[name] - 1 for c in columns[1:]), at(columns[0])[name] - 1)
    counts = {
        "bad_timestamps": at("datetime")["no_time"] - 1,
        "null_grids": at("CellID")["missing"],
        # Stored ids are whole numbers; a file with any other is refused.
        "bad_ids": total("no_id", ID_COLUMNS),
        "as_text": total("text", channels),
    }
    if strict:
        counts |= {f"text_{c}": at(c)["text"] - 1 for c in channels} | {f"negative_{c}": at(c)["negative"] for c in channels}
    say = lambda text, n: F.concat(F.lit(QUALITY_FAILED + text), F.col(n).cast("string"))
    missing = F.array_except(F.array(*[F.lit(c) for c in RAW_COLUMNS]), F.col("header"))
    failure = (
        F.when(F.col("header").isNull(), READ_ERROR + "no columns to parse from file")
        .when((F.size(missing) == 0) & (F.col("long_rows") > 0), F.concat(F.lit(READ_ERROR + "rows with too many fields: "), F.col("long_rows")))
        .when(F.col("row_count") == 0, QUALITY_FAILED + "file contains zero rows")
        .when(
            F.size(missing) > 0,
            F.concat(
                F.lit(QUALITY_FAILED + "cannot perform quality checks because columns are missing: "),
                _quoted_list(missing),
            ),
        )
        .when(F.col("bad_timestamps") > 0, say("malformed timestamp values found: ", "bad_timestamps"))
        .when(F.col("null_grids") > 0, say("NULL grid_id values found: ", "null_grids"))
        .when(F.col("bad_ids") > 0, say("identifiers that are not whole numbers found: ", "bad_ids"))
    )
    for c in channels if strict else []:
        failure = failure.when(F.col(f"text_{c}") > 0, say(f"non-numeric values found in {c}: ", f"text_{c}"))
        failure = failure.when(F.col(f"negative_{c}") > 0, say(f"negative activity values found in {c}: ", f"negative_{c}"))
    passed = F.when(
        F.col("as_text") > 0, F.concat(F.lit(QUALITY_PASSED + AS_TEXT), F.col("as_text").cast("string"))
    ).otherwise(QUALITY_PASSED)
    return survey.withColumns(counts).withColumn("failure", failure).select(
        "filename",
        F.col("failure").isNull().alias("is_valid"),
        F.coalesce("failure", passed).alias("reason"),
        "row_count",
        "header",
    )


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit table, empty before the first run."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return spark.read.schema(AUDIT_SCHEMA).parquet(path)


def already_processed(files: DataFrame, audit: DataFrame) -> DataFrame:
    """Listed files that were accepted or rejected before."""
    done = audit.where(F.col("status").isin("VALID", "REJECTED")).select(F.col("filename").alias("file_name"))
    return files.join(done, "file_name", "left_semi")


def route_files(schema_results: DataFrame, quality_results: DataFrame, skipped: DataFrame) -> DataFrame:
    """Status and reason per file: skip first, then schema, then quality."""
    quality = quality_results.select("filename", F.col("is_valid").alias("q_valid"), F.col("reason").alias("q_reason"))
    good = F.col("is_valid") & F.col("q_valid")
    routed = schema_results.join(quality, "filename").select(
        "filename",
        F.when(good, "VALID").otherwise("REJECTED").alias("status"),
        "row_count",
        F.when(good, F.replace("q_reason", F.lit(QUALITY_PASSED), F.lit(BOTH_PASSED))).when(F.col("is_valid"), F.col("q_reason")).otherwise(F.col("reason")).alias("reason"),
        "header",
    )
    again = skipped.select(
        F.col("file_name").alias("filename"),
        F.lit("SKIPPED").alias("status"),
        F.lit(0).cast("bigint").alias("row_count"),
        F.lit(ALREADY).alias("reason"),
        F.lit(None).cast("array<string>").alias("header"),
    )
    return routed.unionByName(again)


def stored_integer(text: Column) -> Column:
    """Text as an integer: as it is, or written as a whole number with a fraction (``5.0``); else NULL."""
    number = text.try_cast("double")
    return F.coalesce(text.try_cast("int"), F.when(number == F.floor(number), number.try_cast("int")))


def _stored(field: T.StructField) -> Column:
    return stored_integer(F.col(field.name)) if field.name in ID_COLUMNS else F.col(field.name).try_cast(field.dataType)


def _write_by_file(df: DataFrame, path: str) -> None:
    # Dynamic overwrite replaces only the partitions of the files in this run.
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("source_file").parquet(path)


@contextmanager
def routed_files(spark: SparkSession, pending: DataFrame, skipped: DataFrame, raw: str, rejected: str) -> Iterator[DataFrame]:
    """Decide on the files of ``pending`` and write their rows; the decisions (see :func:`route_files`), kept while in use.

    The text is read twice: once for all checks of all files, once for its rows, each file by the one write it belongs to.
    """
    with ExitStack() as kept_small:
        # One row per file each, used by several steps below.
        keep = lambda df: kept_small.enter_context(cached(df))
        pending = keep(pending)
        lines = landing_lines(spark, pending)
        survey = keep(survey_files(pending, lines))
        checks = [check(pending, lines, survey=survey) for check in (validate_schema, validate_minimum_quality)]
        results = keep(route_files(*checks, skipped))
        valid = results.where(F.col("status") == "VALID")
        # Either write reads only the files that it is about.
        of = lambda some: landing_lines(spark, pending.join(some.select(F.col("filename").alias("file_name")), "file_name", "left_semi"))
        if not valid.isEmpty():
            rows = _parsed(of(valid), valid).where(parse_timestamp("datetime").isNotNull())
            typed = [_stored(f).alias(f.name) for f in RAW_SCHEMA.fields]
            _write_by_file(rows.select(*typed, F.col("filename").alias("source_file")), raw)
        refused = results.where(F.col("status") == "REJECTED").select("filename", "reason")
        if not refused.isEmpty():
            lost = of(refused).join(bounded_broadcast(refused), "filename")
            _write_by_file(lost.select("value", "reason", F.col("filename").alias("source_file")), rejected)
        yield results


def ingest_landing(
    spark: SparkSession,
    landing: str,
    raw: str,
    rejected: str,
    audit: str,
    processed_at: str,
    files: DataFrame | None = None,
) -> DataFrame:
    """Ingest the landing folder (or just ``files``); returns filename, status, row_count, reason.

    ``processed_at`` is the run's ISO UTC time and identifies its audit rows.
    ``raw`` and ``rejected`` are Parquet tables partitioned by ``source_file``,
    ``audit`` is an append-only Parquet table.
    """
    files = discover_files(spark, landing) if files is None else files
    skipped = already_processed(files, read_audit(spark, audit))
    pending = files.join(skipped.select("file_name"), "file_name", "left_anti")
    with routed_files(spark, pending, skipped, raw, rejected) as results:
        log = append_audit(results, audit, processed_at)
    return log.where(F.col("processed_at") == processed_at).drop("processed_at")
