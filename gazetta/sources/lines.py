"""Numbers of lines and records in files that many tasks read.

Files are split as Spark splits them. A first pass leaves one row for each split, what it counts; a scan over the splits of a
file tells each one what stands before it; a second pass numbers. A line count is a sum. A record's number depends on quotes that were
opened before the split, so each split is read both ways, as if it began between records and as if inside a quoted value, and
the scan picks the way that the split before ends with. Only records over a border of two splits move between tasks.
"""

from __future__ import annotations

import csv
import io
import math
import re
import sys
import tempfile
import uuid
from itertools import groupby, islice
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

csv.field_size_limit(sys.maxsize)  # values may have any length
ENDS = re.compile(r"[^\r\n]*(?:\r\n|\r|\n)")
FACTS = "file string, block long, valid boolean, columns int, starts0 long, inside0 boolean, tail0 long, starts1 long, inside1 boolean, head1 long, tail1 long"
PLAN = "file string, block long, problem string, columns int, first long, head long, tail long, inside boolean, lost long"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir, on a single machine below a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gazetta-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, value): lines in the order of their split, whose first byte is `block`; a carriage return stays."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): every line with its number in its file, from 1."""
    lines = split_lines(spark, path).withColumn("at", F.monotonically_increasing_id())
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("from"))
    folder = shared_folder(spark, "lines")
    counts.write.parquet(folder)  # a row for each split, fixed from here on

    def before(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("block")
        part["before"] = part["n"].cumsum() - part["n"]
        return part[["file", "block", "from", "before"]]

    bases = spark.read.parquet(folder).groupBy("file").applyInPandas(before, "file string, block long, from long, before long")
    told = lines.join(bases, ["file", "block"], "left")
    number = F.when(F.col("before").isNull(), F.raise_error(F.lit("a file changed while it was read")).cast("long")).otherwise(F.col("before") + F.col("at") - F.col("from") + 1)
    return told.select("file", number.alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))


def walk(line: str, inside: bool) -> tuple[bool, bool]:
    """(inside a quoted value at the line's end, well formed) of a line without its end, as the strict reader goes."""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True, True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside, at = False, at + 1
            if at == len(line):
                return False, True
            if line[at] != ",":
                return False, False  # the reader gives the record up, and begins anew at the next line
            at += 1
        if line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at) + 1
        if not at:
            return False, True


class Way:
    """A split read from one state: records begun, the lines of the record before, where the last open record begins."""

    def __init__(self, inside: bool):
        self.inside, self.starts, self.head, self.tail, self.lines, self.closed = inside, 0, 0, -1, 0, not inside

    def read(self, line: str) -> None:
        if not self.inside:
            self.starts, self.tail = self.starts + 1, self.lines
        self.inside = walk(line, self.inside)[0] if self.inside or '"' in line else False
        self.lines += 1
        if not self.inside:
            self.tail = -1
            if not self.closed:
                self.closed, self.head = True, self.lines
        elif not self.closed:
            self.head = self.lines


def _parts(batches):
    """((file, block), lines with their ends, or None where a line is not UTF-8) of every split, as they come."""

    def each():
        for batch in batches:
            for file, block, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                yield (file, block), value

    for key, rows in groupby(each(), key=lambda r: r[0]):
        yield key, _lines(key[1], (v for _, v in rows))


def _lines(block: int, values):
    for k, value in enumerate(values):
        try:
            line = value.decode("utf-8")
        except UnicodeDecodeError:
            yield None
            continue
        if not block and not k:
            line = line.removeprefix("\ufeff")
        if "\r" in line:
            yield from ENDS.findall(line + "\n")
        else:
            yield line + "\n"


def _facts(contracts: list[list[str]]):
    def run(batches):
        for (file, block), lines in _parts(batches):
            ways, valid, columns, first = (Way(False), Way(True)), True, None, True
            for line in lines:
                if line is None:
                    valid = False
                    continue
                if first and not block:
                    try:
                        header = next(csv.reader([line], strict=True), None)
                    except csv.Error:
                        header = None
                    columns = len(header) if header in contracts else None
                first = False
                body = line.rstrip("\r\n")
                for way in ways:
                    way.read(body)
            a, b = ways
            row = (file, block, valid, columns, a.starts, a.inside, a.tail, b.starts, b.inside, b.head, b.tail)
            yield pa.RecordBatch.from_pylist([dict(zip((c.split()[0] for c in FACTS.split(", ")), row, strict=True))], pa.schema([(c.split()[0], {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]]) for c in FACTS.split(", ")]))

    return run


def _scan(part: pd.DataFrame) -> pd.DataFrame:
    """The splits of one file in order, each with its state and the records begun before it."""
    part = part.sort_values("block")
    inside, first, out = False, 0, []
    head = part.iloc[0]
    columns = None if head["block"] or pd.isna(head["columns"]) else int(head["columns"])
    problem = "not UTF-8" if not part["valid"].all() else "header is neither contract" if columns is None else None
    for r in part.itertuples(index=False):
        out.append([r.file, r.block, problem, columns or 0, first, r.head1 if inside else 0, r.tail1 if inside else r.tail0, inside])
        first, inside = first + (r.starts1 if inside else r.starts0), r.inside1 if inside else r.inside0
    return pd.DataFrame([(*o, first if inside else 0) for o in out], columns=[c.split()[0] for c in PLAN.split(", ")])


ROW = "file string, rec_no long, block long, text string, problem string, fields array<string>"


def records(spark: SparkSession, path: str, contracts: list[list[str]], most: int = 1 << 20) -> DataFrame:
    """(file, rec_no, problem, fields): all records of strict CSV files but blank ones, numbered with these, the header being 1.

    A record that breaks the contract is a row with a problem and no fields, and so is a file that is not UTF-8, has another
    header or ends inside a quoted value. What the scan knows of at most `most` splits goes to all tasks at a time, some
    100 bytes each; of more, files are read in several rounds.
    """
    folder = shared_folder(spark, "records")
    lines = split_lines(spark, path).withColumn("value", F.col("value").cast("binary"))
    lines.mapInArrow(_facts(contracts), FACTS).write.parquet(f"{folder}/facts")
    spark.read.parquet(f"{folder}/facts").groupBy("file").applyInPandas(_scan, PLAN).write.parquet(f"{folder}/plan")
    plan = spark.read.parquet(f"{folder}/plan")  # a row for each split
    rounds = max(1, math.ceil(plan.count() / most))
    out = None
    for k in range(rounds):
        some = plan.where(F.crc32("file") % rounds == k)
        known = {(r["file"], r["block"]): tuple(r)[2:] for r in some.collect()}
        shared = spark.sparkContext.broadcast((known, rounds, k))
        parts = [lines.mapInArrow(_whole(shared), ROW)]
        if any(inside for *_, inside, _ in known.values()):
            pieces = lines.mapInArrow(_pieces(shared), ROW)
            joined = pieces.groupBy("file", "rec_no").agg(F.array_sort(F.collect_list(F.struct("block", "text"))).alias("x"))  # a record's own text
            joined = joined.select("file", "rec_no", F.array_join(F.transform("x", lambda p: p["text"]), "").alias("text"))
            columns = some.groupBy("file").agg(F.max("columns").alias("columns"))
            parts.append(joined.join(columns, "file").select("file", "rec_no", "columns", "text").mapInArrow(_joined, ROW))
        for part in parts:
            out = part if out is None else out.unionByName(part)
    return out.select("file", "rec_no", "problem", "fields")


def _parsed(lines, number: int, columns: int):
    """(number, problem, fields) of every record of these lines, numbered from `number`; a blank one has neither."""
    reader = csv.reader(lines, strict=True)
    while True:
        try:
            values = next(reader)
        except StopIteration:
            return
        except csv.Error as e:
            yield number, f"malformed: {e}", None
        else:
            blank = not any(v.strip() for v in values)
            wrong = not blank and len(values) != columns
            yield number, f"{len(values)} fields instead of {columns}" if wrong else None, None if blank or wrong else values
        number += 1


def _batches(rows, size: int = 500):
    names = [c.split()[0] for c in ROW.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string())]
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(list(v), k) for v, k in zip(zip(*some, strict=True), kinds, strict=True)], names)


def _known(shared, batches):
    known, rounds, k = shared.value
    for key, lines in _parts(batches):
        if key in known:
            yield key, lines, known[key]
        elif crc32(key[0].encode()) % rounds == k:
            raise ValueError("a file changed while it was read")


def _whole(shared):
    """Records that begin and end in their split, and what is wrong with files."""

    def rows(batches):
        for (file, block), lines, (problem, columns, first, head, tail, _, lost) in _known(shared, batches):
            if problem:
                if not block:
                    yield file, 1, block, None, problem, None
                continue
            number = first
            for _ in islice(lines, head):
                pass
            for number, why, values in _parsed(islice(lines, tail - head) if tail >= 0 else lines, first + 1, columns):
                if number > 1 and (why or values):
                    yield file, number, block, None, why, values
            if tail >= 0 and number + 1 == lost:
                yield file, lost, block, None, "malformed: unexpected end of data", None

    return lambda batches: _batches(rows(batches))


def _pieces(shared):
    """The lines of records over the borders of splits; of one that the file's end cuts off there is no telling."""

    def rows(batches):
        for (file, block), lines, (problem, _, first, head, tail, inside, lost) in _known(shared, batches):
            if problem:
                continue
            before = "".join(islice(lines, head))
            if inside and first != lost:
                yield file, first, block, before, None, None
            if tail >= 0:
                number = first
                for number, _, _ in _parsed(islice(lines, tail - head), first + 1, 0):
                    pass
                if number + 1 != lost:
                    yield file, number + 1, block, "".join(lines), None, None

    return lambda batches: _batches(rows(batches))


def _joined(batches):
    def rows():
        for batch in batches:
            for file, number, columns, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for _, why, values in _parsed(io.StringIO(text, newline=""), number, columns):
                    if why or values:
                        yield file, number, None, None, why, values

    return _batches(rows())
