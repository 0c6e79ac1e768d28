"""Source runs and their candidates: state rules, transitions, outcomes, completeness, identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import text, urls
from gazetta.sources.html import page_text
from gazetta.sources.lines import shared_folder

#: States of a run and of a candidate.
ENDED = ("OK", "EMPTY", "PARTIAL", "ERROR")
STATES = ("NOT_STARTED", "RUNNING", *ENDED)
CANDIDATE_STATES = ("CAPTURED", "DETAIL_COMPLETE", "EXCLUDED")
#: Texts that mean a page was withheld.
CHALLENGES = ("complete the security check", "verify you are human", "access denied", "just a moment", "checking your browser", "quick check needed", "confirm you're a real person", "altcha-widget")
BLOCKED = r"(?i)possible security violation|E0227SECURITY"


def broken_rules() -> Column:
    """The codes of the state rules that a run breaks."""
    s, done, n = F.col("status"), F.coalesce("normal_collection_completed", F.lit(False)), F.coalesce("candidate_count", F.lit(0))
    started, finished = text.filled("started_at") != "", text.filled("finished_at") != ""
    limited, failed = ~text.blank("limitation"), ~text.blank("error")
    message, ended = limited | failed, s.isin(*ENDED)
    rules = {
        "status_unknown": ~F.coalesce(s, F.lit("")).isin(*STATES),
        "count_negative": n < 0,
        "not_started_with_progress": (s == "NOT_STARTED") & (started | finished | (n != 0) | done),
        "running_not_started": (s == "RUNNING") & ~started,
        "running_but_finished": (s == "RUNNING") & (finished | done),
        "message_before_end": s.isin("NOT_STARTED", "RUNNING") & message,
        "ended_without_times": ended & ~(started & finished),
        "empty_with_candidates": (s == "EMPTY") & (~done | (n != 0)),
        "ok_without_candidates": (s == "OK") & (~done | (n == 0)),
        "message_on_success": s.isin("EMPTY", "OK") & message,
        "partial_without_limitation": (s == "PARTIAL") & ~limited,
        "error_without_text": (s == "ERROR") & ~failed,
    }
    return F.array_compact(F.array(*(F.when(test, F.lit(code)) for code, test in rules.items())))


def run_violations(runs: DataFrame) -> DataFrame:
    """Rows (source_id, code), one for each state rule that a run breaks."""
    return runs.select("source_id", F.explode(broken_rules()).alias("code"))


def transition_allowed(before: Column, after: Column) -> Column:
    return (before.isNull() & (after == "NOT_STARTED")) | ((before == "NOT_STARTED") & (after == "RUNNING")) | ((before == "RUNNING") & after.isin(*ENDED))


def transitions(history: DataFrame, key: str = "source_id", order: tuple[str, ...] = ("at",)) -> DataFrame:
    """The history with the state before each row and whether the step is allowed."""
    before = F.lag("status").over(Window.partitionBy(key).orderBy(*order))
    return history.withColumn("before", before).withColumn("allowed", F.coalesce(transition_allowed(F.col("before"), F.col("status")), F.lit(False)))


def folded_states(history: DataFrame, key: str = "source_id", order: tuple[str, ...] = ("at",), values: bool = False) -> DataFrame:
    """The history with the state that each run has `before` a row, and whether the row is `accepted`.

    A rejected step leaves the state as it was, so it does not decide about later ones. States only go forward: a run's
    accepted rows are its first NOT_STARTED, the first RUNNING behind that and the first end behind that. So they are three minima,
    which combine before they are shuffled, and no run is sorted or gathered. With `values` rows hold a run's values, and one that
    breaks a state rule is rejected as well. Rows of one place go by status.
    """
    place = F.struct(*order, "status")
    rows = history.withColumn("_place", place).withColumn("_fit", F.size(broken_rules()) == 0 if values else F.lit(True))
    marks = None
    for k, states in enumerate((("NOT_STARTED",), ("RUNNING",), ENDED)):
        some = rows.where(F.col("status").isin(*states) & F.col("_fit")).select(key, "_place")
        if marks is None:
            marks = some.groupBy(key).agg(F.min("_place").alias("_m0"))
        else:
            later = some.join(marks.select(key, f"_m{k - 1}"), key).where(F.col("_place") > F.col(f"_m{k - 1}")).groupBy(key).agg(F.min("_place").alias(f"_m{k}"))
            marks = marks.join(later, key, "left")
    end = F.when(F.col("_place") > F.col("_m2"), F.col("_m2")["status"])  # the last field of a place
    before = F.coalesce(end, F.when(F.col("_place") > F.col("_m1"), "RUNNING"), F.when(F.col("_place") > F.col("_m0"), "NOT_STARTED"))
    accepted = F.col("_fit") & F.coalesce(F.col("_place").isin(F.col("_m0"), F.col("_m1"), F.col("_m2")), F.lit(False))
    out = rows.join(marks, key, "left").withColumn("before", before).withColumn("accepted", F.coalesce(accepted, F.lit(False)))
    return out.select(*history.columns, "before", "accepted")


def final_states(folded: DataFrame, key: str = "source_id", order: tuple[str, ...] = ("at",)) -> DataFrame:
    """(key, status, accepted, rejected): the state that each run has in the end."""
    last = F.max(F.when(F.col("accepted"), F.struct(*order, "status")))["status"]
    return folded.groupBy(key).agg(last.alias("status"), F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected"))


def outcome(complete: Column, candidates: Column) -> Column:
    some = candidates > 0
    return F.when(complete & some, "OK").when(complete, "EMPTY").when(some, "PARTIAL").otherwise("ERROR")


def counters(candidates: DataFrame, fetches: DataFrame | None = None) -> DataFrame:
    """Listed and fully read candidates of each source; with `fetches` (source_id, page, cached) also pages, requests and cache hits."""
    own = candidates.groupBy("source_id").agg(F.count("*").alias("listed"), F.count_if(F.col("status") == "DETAIL_COMPLETE").alias("detail_complete"))
    if fetches is None:
        return own
    seen = fetches.groupBy("source_id").agg(F.countDistinct("page").alias("pages"), F.count_if(~F.col("cached")).alias("requests"), F.count_if("cached").alias("cache_hits"))
    none = ("listed", "detail_complete", "pages", "requests", "cache_hits")
    return own.join(seen, "source_id", "full_outer").select("source_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in none))


def completeness(listed: DataFrame, advertised: DataFrame, key: str = "source_id", identity: str = "identity") -> DataFrame:
    """Distinct identities of each source against the count it advertises: equal, short, over or unknown."""
    n = listed.groupBy(key).agg(F.countDistinct(identity).alias("unique_identities"))
    told = advertised.groupBy(key).agg(F.max("advertised_count").alias("advertised"), (F.countDistinct("advertised_count") == 1).alias("counts_agree"))
    both = told.join(n, key, "left").withColumn("unique_identities", F.coalesce("unique_identities", F.lit(0)))
    u, a = F.col("unique_identities"), F.col("advertised")
    return both.withColumn("verdict", F.when(a.isNull(), "unknown").when(u > a, "over").when(u < a, "short").otherwise("equal"))


def conflicts(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Keys whose rows differ in any value, with how many rows and distinct contents they have."""
    content = F.struct(*values)  # a null is a value like any other
    return rows.groupBy(*keys).agg(F.count("*").alias("rows"), (~F.min(content).eqNullSafe(F.max(content))).alias("differs")).where("differs").select(*keys, "rows")


def duplicates(candidates: DataFrame) -> DataFrame:
    """Rows (source_id, field, value, n): nonblank detail links and platform ids that a source has more than once."""
    each = candidates.select("source_id", F.explode(F.array(*(F.struct(F.lit(f).alias("field"), text.filled(f).alias("value")) for f in ("detail_url", "source_platform_id")))).alias("x"))
    return each.where("x.value <> ''").groupBy("source_id", "x.field", "x.value").agg(F.count("*").alias("n")).where("n > 1")


def latest_pages(rows: DataFrame, identity: str = "identity") -> DataFrame:
    """Across pages the last row of each identity in the place of its first; `url_conflict` if its pages disagree on the link."""
    rest = [c for c in rows.columns if c not in (identity, "page", "place")]
    last = rows.groupBy(identity).agg(F.max_by(F.struct(*rest), F.struct("page", "place")).alias("r"), F.min(F.struct("page", "place")).alias("at"), (F.min("url") != F.max("url")).alias("url_conflict"))
    return last.select(identity, "at.page", "at.place", "r.*", "url_conflict")


def next_pages(links: DataFrame) -> DataFrame:
    """The next page of each page; more than one target is ambiguous."""
    found = links.groupBy("page_url").agg(F.min("target").alias("target"), F.max("target").alias("other"))
    return found.select("page_url", F.when(F.col("target") == F.col("other"), F.col("target")).alias("next_url"), (F.col("target") != F.col("other")).alias("ambiguous"))


def page_numbers(edges: DataFrame, start: DataFrame, budget: int = 100) -> DataFrame:
    """(page_url, step, problem): pages reached from start pages along next links.

    `edges` has page_url, next_url and ambiguous, as `next_pages` gives them. Where a walk cannot go on although there is a next link, its
    last page says why: `ambiguous`, `other site`, `repeated page` or `budget`.

    Links are doubled: a round knows the pages within 2**k steps and where 2**k steps lead from each page, so log2(budget)
    rounds reach all, each one a join and a minimum, written so that the next begins from a table. A page that a walk comes back to keeps its first step.
    """
    folder = shared_folder(edges.sparkSession, "pages")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.parquet(f"{folder}/{name}")

    ambiguous, target = F.coalesce("ambiguous", F.lit(False)), F.col("next_url")
    leaves = urls.authority("next_url") != urls.authority("page_url")
    links = edges.select("page_url", "next_url", "ambiguous")
    hop = kept(links.where(target.isNotNull() & ~ambiguous & ~F.coalesce(leaves, F.lit(False))).select("page_url", F.col("next_url").alias("to")).distinct(), "hop-0")
    seen = kept(start.select("page_url").distinct().withColumn("step", F.lit(0)), "seen-0")
    rounds = max(0, (budget - 1).bit_length())
    for k in range(rounds):
        far = seen.join(hop, "page_url").select(F.col("to").alias("page_url"), (F.col("step") + (1 << k)).alias("step")).where(F.col("step") < budget)
        seen = kept(seen.unionByName(far).groupBy("page_url").agg(F.min("step").alias("step")), f"seen-{k + 1}")
        if k < rounds - 1:
            hop = kept(hop.join(hop.select(F.col("page_url").alias("to"), F.col("to").alias("_to")), "to").select("page_url", F.col("_to").alias("to")), f"hop-{k + 1}")
    known = seen.select(F.col("page_url").alias("next_url"), F.col("step").alias("_known"))
    ahead = seen.join(links, "page_url", "left").join(known, "next_url", "left")
    why = F.when(ambiguous, "ambiguous").when(target.isNull(), F.lit(None)).when(leaves, "other site").when(F.col("_known") <= F.col("step"), "repeated page").when(F.col("step") == budget - 1, "budget")
    return ahead.select("page_url", "step", why.alias("problem"))


def id_mismatches(listed: DataFrame, detailed: DataFrame, key: str = "identity") -> DataFrame:
    """Details whose own id disagrees with the id that the list advertised."""
    return listed.select(key, F.col("platform_id").alias("listed_id")).join(detailed.select(key, F.col("platform_id").alias("observed_id")), key).where((text.filled("observed_id") != "") & (F.col("listed_id") != F.col("observed_id")))


def reused(listed: DataFrame, existing: DataFrame) -> DataFrame:
    """Listed rows with the candidate that was read before at the same link, if any, and whether work remains."""
    state = F.struct((F.col("status") == "DETAIL_COMPLETE").alias("complete"), "status")  # of a repeated link the furthest state counts
    old = existing.groupBy("detail_url").agg(F.max(state)["status"].alias("old_status"))
    return listed.join(old, "detail_url", "left").withColumn("remains", F.coalesce(F.col("old_status") != "DETAIL_COMPLETE", F.lit(True)))


def remaining(listed: DataFrame, complete: DataFrame, key: str) -> DataFrame:
    """What a resumed run still has to read."""
    return listed.join(complete.select(key).distinct(), key, "left_anti")


def stale_checkpoints(runs: DataFrame, checkpoints: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows (source_id, code): checkpoints that do not belong to the registry as it is, and running sources without one."""
    have = checkpoints.select("source_id", F.col("registry_id").alias("c_registry"), F.col("registry_schema_version").alias("c_version"), F.col("fixed_route").alias("c_route"))
    both = registry.select("source_id", "registry_id", "schema_version", "fixed_route").join(runs.select("source_id", "status"), "source_id", "left").join(have, "source_id", "left")
    there = F.col("c_registry").isNotNull()
    rules = {
        "running_without_checkpoint": (F.col("status") == "RUNNING") & ~there,
        "registry_mismatch": there & ((F.col("c_registry") != F.col("registry_id")) | (F.col("c_version") != F.col("schema_version"))),
        "route_changed": there & (F.col("c_route") != F.col("fixed_route")),
    }
    return both.select("source_id", F.explode(F.array_compact(F.array(*(F.when(t, F.lit(c)) for c, t in rules.items())))).alias("code"))


def resume_plan(registry: DataFrame, runs: DataFrame, candidates: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """(source_id, action, problem): what a resumed collection does with each source: `skip`, `collect` or `refuse`.

    `checkpoints` has source_id and content, the JSON text as it is stored. A finished source is skipped only if as many candidates are
    stored as it counted and its checkpoint says that its list was complete; evidence that contradicts the registry or itself is refused.
    """
    doc = F.try_parse_json("content")
    told = lambda name, kind="string": F.try_variant_get("doc", f"$.{name}", kind)
    have = checkpoints.select("source_id", doc.alias("doc"), F.lit(True).alias("stored")).select(
        "source_id", "stored", F.coalesce(F.schema_of_variant("doc").startswith("OBJECT"), F.lit(False)).alias("object"), told("source_id").alias("c_source"), told("registry_id").alias("c_registry"),
        told("registry_schema_version", "int").alias("c_version"), told("fixed_route").alias("c_route"), F.coalesce(told("enumeration_complete", "boolean"), F.lit(False)).alias("enumerated"),
    )
    stored = candidates.groupBy("source_id").agg(F.count("*").alias("n"))
    rows = registry.select("source_id", "registry_id", "schema_version", "fixed_route").join(runs.select("source_id", "status", "candidate_count"), "source_id", "left").join(have, "source_id", "left").join(stored, "source_id", "left")
    there, finished = F.coalesce("stored", F.lit(False)), F.coalesce(F.col("status").isin("OK", "EMPTY"), F.lit(False))
    agrees = (F.coalesce("n", F.lit(0)) == F.coalesce("candidate_count", F.lit(0))) & F.coalesce("enumerated", F.lit(False))
    problem = (
        F.when(there & ~F.col("object"), "checkpoint_unreadable").when(F.col("c_source") != F.col("source_id"), "source_mismatch").when((F.col("c_registry") != F.col("registry_id")) | (F.col("c_version") != F.col("schema_version")), "registry_mismatch")
        .when(F.col("c_route") != F.col("fixed_route"), "route_changed").when((F.col("status") == "RUNNING") & ~there, "running_without_checkpoint").when(finished & ~agrees, "finished_disagrees")
    )
    return rows.select("source_id", F.when(problem.isNotNull(), "refuse").when(finished, "skip").otherwise("collect").alias("action"), problem.alias("problem"))


def read_details(candidates: DataFrame, fetches: DataFrame, stop_after: int | None = None) -> DataFrame:
    """(source_id, detail_url, place, result): how far the details of each source are read.

    `candidates` has source_id, detail_url, place (from 0) and status, `fetches` detail_url, http_status, html and error. A page that access is
    withheld to (401, 403 or a security check) ends its source: later details are `unread`. Any other error is `failed` and the next
    detail is read. Complete details are `reused`. `stop_after` ends every source at that place. The place of the end is a minimum that
    combines before it is shuffled, so a source of very many details needs no order.
    """
    one = fetches.groupBy("detail_url").agg(F.min_by(F.struct("http_status", "html", "error"), F.struct("http_status", "error")).alias("f"))
    rows = candidates.select("source_id", "detail_url", "place", "status").join(one, "detail_url", "left").select("*", F.col("f.http_status").alias("code"), F.col("f.html").alias("html"), text.filled("f.error").alias("error")).drop("f")
    withheld = F.coalesce(F.col("code").isin(401, 403), F.lit(False)) | ((F.col("error") == "") & F.coalesce(F.col("code") < 400, F.lit(False)) & withheld_page("html"))
    reused_ = F.coalesce(F.col("status") == "DETAIL_COMPLETE", F.lit(False))
    failed = F.col("code").isNull() | (F.col("code") >= 400) | (F.col("error") != "")
    result = F.when(reused_, "reused").when(withheld, "withheld").when(failed, "failed").otherwise("read")
    rows = rows.select("source_id", "detail_url", "place", result.alias("result"))
    ends = rows.where("result = 'withheld'").groupBy("source_id").agg(F.min("place").alias("_end"))
    late = F.coalesce(F.col("place") > F.col("_end"), F.lit(False))
    if stop_after is not None:
        late |= F.col("place") >= stop_after
    return rows.join(ends, "source_id", "left").select("source_id", "detail_url", "place", F.when(late, "unread").otherwise(F.col("result")).alias("result"))


def collected(details: DataFrame, lists: DataFrame) -> DataFrame:
    """(source_id, listed, detail_complete, failures, status) of each source of `lists` (source_id, enumeration_complete): a run is only complete with its list and without a failure."""
    n = lambda *results: F.count_if(F.col("result").isin(*results))
    own = details.groupBy("source_id").agg(F.count("*").alias("listed"), n("read", "reused").alias("detail_complete"), n("withheld", "failed").alias("failures"), n("unread").alias("unread"))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    both = lists.join(own, "source_id", "left").select("source_id", "enumeration_complete", *(zero(c) for c in ("listed", "detail_complete", "failures", "unread")))
    complete = F.coalesce("enumeration_complete", F.lit(False)) & (F.col("failures") == 0) & (F.col("unread") == 0)
    return both.select("source_id", "listed", "detail_complete", "failures", outcome(complete, F.col("listed")).alias("status"))


def candidate_violations(candidates: DataFrame) -> DataFrame:
    """Rows (candidate_id, code): missing fields, links or states that a candidate must have."""
    rules = {f"{f}_missing": text.blank(f) for f in ("source_id", "candidate_id", "raw_title")}
    rules["link_missing"] = text.blank("list_url") & text.blank("source_url")
    rules["link_not_web"] = (~text.blank("detail_url")) & ~urls.is_web("detail_url")
    rules["status_unknown"] = ~text.filled("status").isin(*CANDIDATE_STATES)
    return candidates.select("candidate_id", F.explode(F.array_compact(F.array(*(F.when(t, F.lit(c)) for c, t in rules.items())))).alias("code"))


def challenged(html: Column | str) -> Column:
    """Whether a page is a security check instead of content."""
    x = F.lower(text.filled(html))
    found = F.lit(False)
    for marker in CHALLENGES:
        found |= F.contains(x, F.lit(marker))
    return found


def withheld_page(html: Column | str) -> Column:
    """Whether a page is a security check by its source or by the text that it shows."""
    return challenged(html) | challenged(page_text(html))


def blocked(page_text: Column | str) -> Column:
    return text.filled(page_text).rlike(BLOCKED)
