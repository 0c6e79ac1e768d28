"""Reading and writing of feeds and run state. A feed has one of two fixed column lists and no nulls."""

from __future__ import annotations

import csv
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gazetta.functions import text, urls
from gazetta.sources import lines, versions

#: The columns of the two feed contracts, in order.
LEGACY_COLUMNS = ["organization", "employer_type", "job_title", "job_area", "location", "location_area", "closing_date", "closing_time", "contract_type", "work_pattern", "salary", "apply_url", "job_reference", "date_checked", "source_url"]
SUMMARY_COLUMNS = [*LEGACY_COLUMNS, "job_summary"]
FEED = ", ".join(f"{c} string" for c in SUMMARY_COLUMNS)
PARSED = f"path string, rec_no int, seq_no int, columns int, problem string, {FEED}"


def normalized(feed: DataFrame) -> DataFrame:
    """Nulls become empty, values are trimmed, and a legacy feed gets a blank summary."""
    if "job_summary" not in feed.columns:
        feed = feed.withColumn("job_summary", F.lit(""))
    return feed.withColumns({c: text.trimmed(c) for c in SUMMARY_COLUMNS})


def headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every file."""
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("k")).where("file_block_start = 0")
    return lines.groupBy(F.col("file_path").alias("file")).agg(F.regexp_replace(F.min_by("value", "k"), "^\ufeff", "").alias("header"))


def read_bulk(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Feeds of one contract; a malformed record keeps its line in `_corrupt_record`, blank records are left out.

    The header of every file is compared exactly first, as the reader's own check ignores case and order. With `multiline`
    values may hold line ends, and a file is one task's work; without it files are split, and a value with a line end is malformed.
    """
    told = [r["header"] for r in headers(spark, path).select("header").distinct().limit(2).collect()]
    columns = {",".join(c): c for c in (LEGACY_COLUMNS, SUMMARY_COLUMNS)}.get(told[0]) if len(told) == 1 else None
    if columns is None:
        raise ValueError("the headers are not all one contract's")
    schema = ", ".join(f"{c} string" for c in columns) + ", _corrupt_record string"
    rows = spark.read.schema(schema).csv(path, header=True, enforceSchema=True, multiLine=multiline, quote='"', escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")
    rows = normalized(rows)
    return rows.where(F.col("_corrupt_record").isNotNull() | (F.concat(*SUMMARY_COLUMNS) != ""))


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """All records of feed files with the record numbers that `parse_strict` gives them, read by many tasks to a file.

    (path, rec_no, columns, problem) and the feed's columns. Every record with a problem is told, where the strict parser stops at the first.
    """
    rows = lines.records(spark, path, [LEGACY_COLUMNS, SUMMARY_COLUMNS])
    values = (F.coalesce(F.get("fields", F.lit(k)), F.lit("")).alias(c) for k, c in enumerate(SUMMARY_COLUMNS))
    return rows.select(F.col("file").alias("path"), "rec_no", F.when(F.col("fields").isNotNull(), F.size("fields")).alias("columns"), "problem", *values)


def parse_strict(files: DataFrame) -> DataFrame:
    """Every record of strictly parsed feed files, with its record number (blank ones counted), sequence number and problem.

    `files` has path and content, as `binaryFile` gives them. A snapshot file is one record stream, so it is one
    task's work; files are spread. A file that breaks the contract is one row with a problem and no values.
    """

    def records(path: str, content: bytes):
        empty = [""] * len(SUMMARY_COLUMNS)
        fail = lambda n, why: (path, n, None, None, why, *empty)
        try:
            body = bytes(content).decode("utf-8-sig")
        except UnicodeDecodeError:
            yield fail(None, "not UTF-8")
            return
        reader = csv.reader(io.StringIO(body, newline=""), strict=True)
        try:
            header = next(reader, None)
            if header not in (LEGACY_COLUMNS, SUMMARY_COLUMNS):
                yield fail(1, "header is neither contract")
                return
            seq = 1
            for n, values in enumerate(reader, start=2):
                if not any(v.strip() for v in values):
                    continue
                seq += 1
                if len(values) != len(header):
                    yield fail(n, f"{len(values)} fields instead of {len(header)}")
                    return
                yield (path, n, seq, len(header), None, *values, *empty[len(header) :])
        except csv.Error as e:
            yield fail(None, f"malformed: {e}")

    def run(batches):
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = list(records(path, content))
                yield pd.DataFrame(rows, columns=[f.split()[0] for f in PARSED.split(", ")]).astype({"rec_no": "Int32", "seq_no": "Int32", "columns": "Int32"})

    return files.select("path", "content").mapInPandas(run, PARSED)


def violations(feed: DataFrame) -> DataFrame:
    """Rows (rec_no, code): links that are blank or not absolute http(s)."""
    code = F.when(text.blank("apply_url"), "apply_url_blank").when(~urls.is_web("apply_url") | (text.filled("apply_url") != text.trimmed("apply_url")), "apply_url_not_web")
    return feed.select("rec_no", code.alias("code")).where("code is not null")


def validation(files: DataFrame) -> DataFrame:
    """One row for each file: ok, row and column count, contract, digest, first problem."""
    parsed = parse_strict(files)
    bad = violations(parsed.where("problem is null").withColumn("rec_no", F.struct("path", "seq_no"))).select("rec_no.path", F.col("rec_no.seq_no").alias("n"), "code")
    first = bad.groupBy("path").agg(F.min_by("code", "n").alias("code"), F.min("n").alias("n"))
    told = parsed.groupBy("path").agg(F.count_if(F.col("problem").isNull()).alias("row_count"), F.max("columns").alias("column_count"), F.max("problem").alias("problem"))
    both = files.select("path", F.sha2("content", 256).alias("sha256")).join(told, "path", "left").join(first, "path", "left")
    problem = F.coalesce("problem", F.concat_ws(" in record ", "code", F.col("n").cast("string")))
    schema = F.when(F.col("column_count") == len(SUMMARY_COLUMNS), "summary").when(F.col("column_count") == len(LEGACY_COLUMNS), "legacy")
    return both.select("path", (F.coalesce(problem, F.lit("")) == "").alias("ok"), F.coalesce("row_count", F.lit(0)).alias("row_count"), "column_count", schema.alias("schema"), "sha256", problem.alias("problem"))


def registry(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a registry document, one row each, in order; raises where it breaks its contract."""
    kind = "registry_id string, schema_version int, source_count int, sources array<struct<source_id:string,name:string,family:string,method:string,fixed_route:string,fallback:string,individual_route_pattern:string,platform:string,wvid:string,notes:array<string>>>"
    doc = spark.read.schema(kind).json(path, multiLine=True)
    rows = doc.select("registry_id", "schema_version", "source_count", F.posexplode("sources").alias("ord", "s")).select("registry_id", "schema_version", "source_count", "ord", "s.*")
    need = ("source_id", "name", "family", "method", "fixed_route", "fallback")
    check = rows.agg(F.count("*").alias("n"), F.countDistinct("source_id").alias("ids"), F.max("source_count").alias("told"), F.min(F.col("schema_version") == 1).alias("version"), F.max(F.greatest(*(text.blank(c).cast("int") for c in need))).alias("holes")).first()
    if not check["n"] or check["n"] != check["ids"] or not check["version"] or check["holes"] or check["told"] not in (None, check["n"]):
        raise ValueError("the registry breaks its contract")
    return rows


def read_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a fixed schema; a broken line stays in `_corrupt_record`, blank lines are skipped."""
    return spark.read.schema(f"{schema}, _corrupt_record string").json(path, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")


def read_numbered_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines as in `read_lines`, each with its `file` and `line_no`, in which blank lines count; broken lines are told by their true number."""
    rows = lines.numbered_lines(spark, path).where(~text.blank("value"))
    parsed = F.from_json("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return rows.select("file", "line_no", parsed.alias("x")).select("file", "line_no", "x.*")


def broken_lines(rows: DataFrame) -> DataFrame:
    """(file, n, first_line) of files with broken lines, from what `read_numbered_lines` gives."""
    return rows.where("_corrupt_record is not null").groupBy("file").agg(F.count("*").alias("n"), F.min("line_no").alias("first_line"))


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A state table of JSON lines as it was last saved, empty where nothing is stored yet."""
    whole = f"{schema}, _corrupt_record string"
    return versions.read(spark, path, whole, form="json", mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt_record")


def evidence(files: DataFrame, meta: DataFrame) -> DataFrame:
    """Stored pages joined to their metadata by content digest; `intact` is false where the digest has no page."""
    pages = files.select(F.sha2("content", 256).alias("sha256"), "content").dropDuplicates(["sha256"])
    return meta.join(pages, "sha256", "left").withColumn("intact", F.col("content").isNotNull())


def csv_value(c: Column | str) -> Column:
    """A CSV field, quoted only where it must be."""
    x = text.filled(c)
    return F.when(x.rlike(r'[",\r\n]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(x)


def csv_lines(feed: DataFrame, columns: list[str] = SUMMARY_COLUMNS) -> DataFrame:
    """One text line for each row, in the feed's fixed form."""
    return feed.select(F.concat_ws(",", *(csv_value(c) for c in columns)).alias("value"))
