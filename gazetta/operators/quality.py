"""Advisory findings over finished rows: by row and field, by repeated summary, by employer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import flags, text
from gazetta.sources.lines import shared_folder

FINDING = ["code", "field", "row_numbers", "reason", "organization"]


def _as_finding(field: str):
    return lambda code: F.struct(F.lit(field).alias("field"), code.alias("code"))


def field_flags(feed: DataFrame, number: str) -> dict:
    """The flags of each field."""
    kinds = {"job_summary": flags.summary_flags, "salary": flags.salary_flags}
    return {f: kinds.get(f, flags.text_flags)(f) for f in feed.columns if f != number}


def spread(feed: DataFrame, number: str) -> DataFrame:
    """The rows dealt by number, so that the search of their texts is shared by all tasks however few parts the files have."""
    return feed.repartition(number)


def row_findings(feed: DataFrame, number: str = "rec_no") -> DataFrame:
    """One finding for each flag of each field, in row and field order."""
    feed = spread(feed, number)
    raised = [F.transform(found, _as_finding(f)) for f, found in field_flags(feed, number).items()]
    each = feed.select(F.col(number).alias("n"), F.posexplode(F.flatten(F.array(*raised))).alias("at", "x"))
    return each.select(F.lit(0).alias("part"), F.col("n").alias("first"), "at", F.col("x.code").alias("code"), F.col("x.field").alias("field"), F.array(F.col("n").cast("long")).alias("row_numbers"), F.lit(None).cast("string").alias("organization"))


def summary_rows(feed: DataFrame, number: str = "rec_no", least: int = 30) -> DataFrame:
    """(n, summary, role) of rows with a summary of `least` words or more, texts as digests; a written table, so texts are read and folded once, however often the digests are read."""
    key = lambda c: text.folded(text.collapsed(c))
    shown = text.collapsed("job_summary")
    words = F.when(shown == "", 0).otherwise(F.char_length(shown) - F.char_length(F.replace(shown, F.lit(" "), F.lit(""))) + 1)
    rows = spread(feed, number).select(F.col(number).cast("long").alias("n"), words.alias("words"), F.sha2(key("job_summary"), 256).alias("summary"), F.sha2(F.concat_ws("\u0001", key("organization"), key("job_title"), key("job_reference")), 256).alias("role"))
    folder = shared_folder(feed.sparkSession, "summaries")
    rows.write.parquet(folder)  # what is asked of the words below does not move before the rows are dealt
    return feed.sparkSession.read.schema(rows.schema).parquet(folder).where(F.col("words") >= least).drop("words")


def _shared_summaries(rows: DataFrame) -> DataFrame:
    """Summaries of several roles."""
    return rows.groupBy("summary").agg(F.min("role").alias("lo"), F.max("role").alias("hi")).where("lo <> hi").select("summary")


def repeated_summaries(feed: DataFrame, number: str = "rec_no", least: int = 30) -> DataFrame:
    """Summaries of `least` words or more that different roles share.

    Groups are counted before their row numbers are gathered, so texts that occur once are never collected.
    """
    rows = summary_rows(feed, number, least)
    groups = rows.join(_shared_summaries(rows), "summary", "left_semi").groupBy("summary").agg(F.array_sort(F.collect_list("n")).alias("row_numbers"))
    return groups.select(F.lit(1).alias("part"), F.array_min("row_numbers").alias("first"), F.lit(0).alias("at"), F.lit("repeated_summary").alias("code"), F.lit("job_summary").alias("field"), "row_numbers", F.lit(None).cast("string").alias("organization"))


def _blank_groups(feed: DataFrame, number: str, least: int, fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The rows with their employer, and (employer, organization, x) of each field that is blank in all rows of an employer."""
    fields = tuple(f for f in fields if f in feed.columns)
    rows = feed.withColumn("employer", text.folded(text.collapsed("organization"))).where("employer <> ''")
    groups = rows.groupBy("employer").agg(F.count("*").alias("rows"), F.min_by("organization", number).alias("organization"), F.min(number).alias("first"), *(F.every(text.blank(f)).alias(f) for f in fields))
    return rows, groups.where(F.col("rows") >= least).select("employer", "organization", "rows", "first", F.explode(F.array_compact(F.array(*(F.when(F.col(f), F.struct(F.lit(k).alias("at"), F.lit(f).alias("field"))) for k, f in enumerate(fields))))).alias("x"))


def blank_employer_fields(feed: DataFrame, number: str = "rec_no", least: int = 3, fields: tuple[str, ...] = ("salary", "job_summary")) -> DataFrame:
    """Fields that are blank in every row of an employer with `least` rows or more."""
    rows, groups = _blank_groups(feed, number, least, fields)
    numbers = rows.select("employer", F.col(number).cast("long").alias("n")).join(groups.select("employer").distinct(), "employer", "left_semi").groupBy("employer").agg(F.array_sort(F.collect_list("n")).alias("row_numbers"))
    found = groups.join(numbers, "employer")
    return found.select(F.lit(2).alias("part"), F.array_min("row_numbers").alias("first"), F.col("x.at").alias("at"), F.lit("employer_field_entirely_blank").alias("code"), F.col("x.field").alias("field"), "row_numbers", "organization")


HEAD = ["finding", "part", "first", "at", "code", "field", "organization", "n"]


def finding_heads(feed: DataFrame, number: str = "rec_no", summaries: DataFrame | None = None) -> DataFrame:
    """One row for each finding: name, place in the report (part, first row, at), code, field, employer, how many rows it has, and reason.

    Heads are counts and minima that combine before they are shuffled, so none grows with its group; `finding_rows` has the rows.
    `summaries` are the feed's `summary_rows`, where they are at hand.
    """
    none = F.lit(None).cast("string")
    each = row_findings(feed, number).select(F.concat_ws(":", "code", "field", "first").alias("finding"), "part", F.col("first").cast("long").alias("first"), "at", "code", "field", none.alias("organization"), F.lit(1).cast("long").alias("n"))
    groups = _blank_heads(feed, number)
    if "job_summary" in feed.columns:
        groups = groups.unionByName(_repeated_heads(summary_rows(feed, number) if summaries is None else summaries))
    return each.unionByName(groups.select(*HEAD)).withColumn("reason", flags.reason("code"))


def finding_rows(feed: DataFrame, number: str = "rec_no", summaries: DataFrame | None = None) -> DataFrame:
    """(finding, row_number): the rows of the findings of several rows; those of one row are told by `first` of their head.

    Every row meets its finding by name, so a finding of a third of all rows is as many rows in as many tasks.
    """
    rows, groups = _blank_groups(feed, number, 3, ("salary", "job_summary"))
    spread = F.pmod(F.xxhash64(number), F.lit(SPREAD)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part_")
    heads = groups.select("employer", _blank_name().alias("finding"), copies)
    out = rows.select("employer", F.col(number).cast("long").alias("row_number"), spread.alias("part_")).join(heads, ["employer", "part_"]).select("finding", "row_number")
    if "job_summary" in feed.columns:
        own = summary_rows(feed, number) if summaries is None else summaries
        shared = _repeated_heads(own).select(F.col("finding").alias("summary"), copies)
        out = out.unionByName(own.withColumn("part_", F.pmod(F.xxhash64("n"), F.lit(SPREAD)).cast("int")).join(shared, ["summary", "part_"]).select(F.col("summary").alias("finding"), F.col("n").alias("row_number")))
    return out


SPREAD = 16  # tasks that the rows of one group are spread over


def _blank_name():
    return F.sha2(F.concat_ws("\u0001", F.lit("blank"), "employer", "x.field"), 256)


def _blank_heads(feed: DataFrame, number: str) -> DataFrame:
    _, groups = _blank_groups(feed, number, 3, ("salary", "job_summary"))
    return groups.select(_blank_name().alias("finding"), F.lit(2).alias("part"), F.col("first").cast("long").alias("first"), F.col("x.at").alias("at"), F.lit("employer_field_entirely_blank").alias("code"), F.col("x.field").alias("field"), "organization", F.col("rows").alias("n"))


def _repeated_heads(rows: DataFrame) -> DataFrame:
    groups = rows.groupBy("summary").agg(F.min("role").alias("lo"), F.max("role").alias("hi"), F.min("n").alias("first"), F.count("*").alias("n")).where("lo <> hi")
    return groups.select(F.col("summary").alias("finding"), F.lit(1).alias("part"), "first", F.lit(0).alias("at"), F.lit("repeated_summary").alias("code"), F.lit("job_summary").alias("field"), F.lit(None).cast("string").alias("organization"), "n")


def findings(feed: DataFrame, number: str = "rec_no") -> DataFrame:
    """All findings in report order, with lists of their rows, for feeds whose groups are small enough for that (else heads and rows): rows and fields first, then repeated summaries, then employers, both by first row."""
    every = row_findings(feed, number).unionByName(repeated_summaries(feed, number)) if "job_summary" in feed.columns else row_findings(feed, number)
    every = every.unionByName(blank_employer_fields(feed, number))
    return every.withColumn("reason", flags.reason("code")).orderBy("part", "first", "at").select(*FINDING)


def report(feed: DataFrame, number: str = "rec_no", fields: tuple[str, ...] = ("salary", "job_summary")) -> DataFrame:
    """One row of counts: rows and findings, which are counted where they arise and neither gathered nor sorted."""
    own = F.lit(0)
    for found in field_flags(feed, number).values():
        own = own + F.size(found)
    counts = feed.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(own), F.lit(0)).alias("n"))
    groups = _blank_groups(feed, number, 3, fields)[1].agg(F.count("*").alias("n"))
    if "job_summary" in feed.columns:
        groups = groups.unionByName(_shared_summaries(summary_rows(feed, number)).agg(F.count("*").alias("n")))
    every = counts.unionByName(groups.select(F.lit(0).cast("long").alias("row_count"), "n"))  # a row for each kind
    return every.agg(F.sum("row_count").alias("row_count"), F.sum("n").alias("finding_count")).select(F.lit(True).alias("advisory_only"), "row_count", "finding_count")


def with_previous(df: DataFrame, keys: list[str], order: list[str], column: str, name: str) -> DataFrame:
    """The last nonnull value of a column before each row."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.last(column, ignorenulls=True).over(w))
