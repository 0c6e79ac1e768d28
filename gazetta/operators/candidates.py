"""Candidates of a source: from its list's cards, then completed by its details."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazetta.functions import text

#: Text columns of a candidate, in order; `provenance` (JSON by name) and `status` follow.
FIELDS = ("source_id", "source_family", "raw_organization", "raw_title", "raw_location", "raw_deadline", "raw_salary", "raw_contract", "raw_work_pattern", "source_reference", "source_platform_id", "list_url", "source_url", "detail_url", "apply_url", "detail_body", "collected_at", "collection_method")


def looked_up(rows: DataFrame, registry: DataFrame, strict: bool = True) -> DataFrame:
    """Rows with their source's columns. A source that the registry lacks ends the job, or else is told in `problem`."""
    told = registry.withColumn("_known", F.lit(True))
    both = rows.join(told, "source_id", "left")
    if strict:
        why = F.raise_error(F.concat(F.lit("unknown source "), F.coalesce(F.col("source_id").cast("string"), F.lit("null"))))
        return both.withColumn("source_id", F.when(F.col("_known"), F.col("source_id")).otherwise(why.cast(dict(rows.dtypes)["source_id"]))).drop("_known")
    return both.withColumn("problem", F.when(F.col("_known").isNull(), "unknown source")).drop("_known")


def from_cards(cards: DataFrame, sources: DataFrame, at: str, method: str) -> DataFrame:
    """A captured candidate of each card.

    `cards` has source_id and `card` as `html.cards` reads it; `sources` has source_id, family, name and fixed_route.
    An organization that the card does not state is the source's.
    """
    card = F.col("card")
    fact = lambda name: F.coalesce(card["facts"][name], F.lit(""))
    told = {
        "source_family": F.col("family"), "raw_organization": F.coalesce(F.nullif(fact("organization"), F.lit("")), F.col("name")), "raw_title": card["title"], "raw_location": fact("location"), "raw_deadline": fact("deadline"), "raw_salary": fact("salary"),
        "raw_contract": fact("contract"), "raw_work_pattern": fact("work_pattern"), "source_reference": fact("reference"), "source_platform_id": card["identity"], "list_url": F.col("fixed_route"), "source_url": F.col("fixed_route"),
        "detail_url": card["url"], "apply_url": card["url"], "detail_body": F.lit(""), "collected_at": F.lit(at), "collection_method": F.lit(method),
    }
    proof = F.create_map(F.lit("href_observed"), F.lit("true"), F.lit("list_text"), F.coalesce(card["text"], F.lit("")))
    rows = looked_up(cards, sources.select("source_id", "family", "name", "fixed_route"))
    return rows.select("source_id", *(text.filled(told[c]).alias(c) for c in FIELDS[1:]), proof.alias("provenance"), F.lit("CAPTURED").alias("status"))


def due(candidates: DataFrame, place: Column, most: int | None = None) -> DataFrame:
    """Candidates whose details are still to be read, in order of `place`; at most so many, for a controlled stop."""
    rows = candidates.where(F.col("status") != "DETAIL_COMPLETE").orderBy(place)
    return rows if most is None else rows.limit(most)


def with_details(candidates: DataFrame, details: DataFrame) -> DataFrame:
    """Candidates with the facts of their read pages.

    `details` has detail_url, `facts` (map by column), raw_apply_url, evidence and error, one row for each link. A fact takes
    the place of what the list said; a failed page leaves the candidate as it was, with its error; candidates that are
    complete, or whose page was not read, stay as they are.
    """
    rows = candidates.join(details.select("detail_url", "facts", "raw_apply_url", "evidence", "error"), "detail_url", "left")
    open_ = F.col("status") != "DETAIL_COMPLETE"
    done, failed = open_ & F.col("facts").isNotNull() & F.col("error").isNull(), open_ & F.col("error").isNotNull()
    rest = lambda *names: F.map_filter("provenance", lambda k, v: ~k.isin(*names))
    proof = F.when(done, F.map_concat(rest("detail_error", "detail_evidence"), F.create_map(F.lit("detail_evidence"), text.filled("evidence")))).when(failed, F.map_concat(rest("detail_error"), F.create_map(F.lit("detail_error"), F.concat_ws(": ", "detail_url", "error")))).otherwise(F.col("provenance"))
    new = {c: F.when(done, F.coalesce(F.col("facts")[c], F.col(c))).otherwise(F.col(c)) for c in FIELDS if c.startswith("raw_") or c in ("source_reference", "detail_body")}
    new["apply_url"] = F.when(done, F.coalesce("raw_apply_url", "apply_url")).otherwise(F.col("apply_url"))
    new["source_url"] = F.when(done, F.col("detail_url")).otherwise(F.col("source_url"))
    new["status"] = F.when(done, "DETAIL_COMPLETE").otherwise(F.col("status"))
    return rows.withColumns(new | {"provenance": proof}).select(*FIELDS, "provenance", "status")
