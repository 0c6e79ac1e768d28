"""Review decisions against candidates, the split of a baseline, and the audited merge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazetta.functions import text, urls
from gazetta.sources.feed import SUMMARY_COLUMNS


def identity(platform_id: str = "source_platform_id", reference: str = "source_reference"):
    """A candidate is known by its platform id, else by its public reference; never by its link."""
    return F.coalesce(F.nullif(text.filled(platform_id), F.lit("")), text.filled(reference))


def cover_gaps(candidates: DataFrame, decisions: DataFrame, key: str = "identity") -> DataFrame:
    """Rows (identity, problem) that keep decisions from covering each candidate exactly once.

    Repeated candidates are one identity; a repeated decision is a problem.
    """
    want = candidates.select(key).distinct().withColumn("wanted", F.lit(True))
    have = decisions.groupBy(key).agg(F.count("*").alias("n"))
    both = want.join(have, key, "full_outer")
    problem = F.when(F.col("wanted").isNull(), "unknown").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    return both.select(key, problem.alias("problem")).where("problem is not null")


def decision_violations(decisions: DataFrame) -> DataFrame:
    """Rows (identity, code), one for each broken rule of each decision.

    `decisions` has identity, outcome, reason, row (struct or map of the feed's fields), shared_apply_url,
    shared_apply_url_reason and blank_summary_reason. Rules on the row hold for included ones only.
    """
    included = F.col("outcome") == "include"
    row = F.col("row")
    complete = F.lit(True)
    for c in SUMMARY_COLUMNS:
        complete &= row[c].isNotNull()
    rules = {
        "reason_missing": text.blank("reason"),
        "outcome_unknown": ~text.filled("outcome").isin("include", "exclude"),
        "row_incomplete": included & ~complete,
        "destination_not_assessed": included & F.col("shared_apply_url").isNull(),
        "shared_reason_missing": included & F.coalesce("shared_apply_url", F.lit(False)) & text.blank("shared_apply_url_reason"),
        "summary_reason_missing": included & text.blank(row["job_summary"]) & text.blank("blank_summary_reason"),
    }
    broken = F.array_compact(F.array(*(F.when(test, F.lit(code)) for code, test in rules.items())))
    return decisions.select("identity", broken.alias("codes")).select("identity", F.explode("codes").alias("code"))


def included_rows(decisions: DataFrame) -> DataFrame:
    return decisions.where("outcome = 'include'").select(*(F.col("row")[c].alias(c) for c in SUMMARY_COLUMNS))


def claimed(baseline: DataFrame, sources: DataFrame) -> DataFrame:
    """The baseline with `source_id` of the first source, by `ord`, that claims a row, or null.

    `sources` has source_id, ord, host, names (accepted organizations, or null for any) and path_part (accepted in a link
    instead of a name). It is a registry: its size is checked before it is broadcast, and a larger one joins by host.
    """
    links = F.array_distinct(F.array(urls.authority("apply_url"), urls.authority("source_url")))
    rows = baseline.select("rec_no", "organization", "apply_url", "source_url", F.explode(links).alias("host")).where("host <> ''")
    small = sources.count() <= 10_000
    hit = rows.join(F.broadcast(sources) if small else sources, "host")
    named = F.coalesce(F.array_contains("names", F.col("organization")), F.lit(False))
    inside = F.coalesce(F.contains("apply_url", "path_part") | F.contains("source_url", "path_part"), F.lit(False))
    hit = hit.where(F.col("names").isNull() | named | inside).groupBy("rec_no").agg(F.min_by("source_id", "ord").alias("source_id"))
    return baseline.join(hit, "rec_no", "left")


def unrouted(claimed_rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of a known employer that no source claims: to be looked at before anything is removed."""
    known = sources.select(F.explode("employers").alias("organization")).distinct()
    return claimed_rows.where("source_id is null").join(known, "organization", "left_semi")


def merged(retained: DataFrame, fresh: DataFrame) -> DataFrame:
    """Retained and fresh rows, all of them: judging duplicates is a decision, not a rule."""
    return retained.select(SUMMARY_COLUMNS).unionByName(fresh.select(SUMMARY_COLUMNS))


def feed_order() -> list:
    """Order of the written feed: three folded columns, then reference and link, compared by code point."""
    return [text.folded("organization"), text.folded("job_title"), text.folded("location"), F.col("job_reference"), F.col("apply_url")]


def audit(rows: DataFrame, fixed_routes: DataFrame) -> DataFrame:
    """One row of counts over a merged feed; `fixed_routes` has apply_url."""
    routes = fixed_routes.select("apply_url").distinct().withColumn("fixed", F.lit(True))
    told = rows.join(routes, "apply_url", "left").select(F.coalesce("fixed", F.lit(False)).alias("shared"), text.blank("job_summary").alias("blank"))
    return told.agg(
        F.count("*").alias("total_rows"),
        F.count_if(~F.col("shared")).alias("job_specific_apply_urls"), F.count_if("shared").alias("shared_apply_urls"),
        F.count_if(~F.col("blank")).alias("nonblank_summaries"), F.count_if("blank").alias("blank_summaries"),
    )


def inherited_exceptions(retained: DataFrame, fixed_routes: DataFrame) -> DataFrame:
    """Retained rows with a shared link or a blank summary, with both marks."""
    routes = fixed_routes.select("apply_url").distinct().withColumn("fixed", F.lit(True))
    told = retained.join(routes, "apply_url", "left").withColumn("shared_apply_url", F.coalesce("fixed", F.lit(False))).withColumn("blank_summary", text.blank("job_summary"))
    return told.where("shared_apply_url or blank_summary").select("organization", "job_title", "apply_url", "job_reference", "shared_apply_url", "blank_summary")


def baseline_violations(baseline: DataFrame, checked: str) -> DataFrame:
    """Rows (rec_no, code) that keep a baseline from being the approved one of a day: another date, or none."""
    if any(c not in baseline.columns for c in SUMMARY_COLUMNS):
        raise ValueError("a baseline has the columns of the summary contract")
    return baseline.where(text.filled("date_checked") != checked).select("rec_no", F.lit("other_day").alias("code"))


def source_counts(claimed_rows: DataFrame, decisions: DataFrame) -> DataFrame:
    """(source_id, baseline_rows, fresh_rows, excluded): what a source had, what its decisions bring, and what they leave out.

    `claimed_rows` as `claimed` gives them, `decisions` with source_id and outcome.
    """
    had = claimed_rows.where("source_id is not null").groupBy("source_id").agg(F.count("*").alias("baseline_rows"))
    now = decisions.groupBy("source_id").agg(F.count_if(F.col("outcome") == "include").alias("fresh_rows"), F.count_if(F.col("outcome") == "exclude").alias("excluded"))
    return had.join(now, "source_id", "full_outer").select("source_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("baseline_rows", "fresh_rows", "excluded")))


def manifest(counts: DataFrame, **facts: str) -> DataFrame:
    """One JSON document of counts and facts."""
    return counts.select(F.to_json(F.struct(*(F.lit(v).alias(k) for k, v in sorted(facts.items())), F.struct(*counts.columns).alias("audit"))).alias("manifest"))
