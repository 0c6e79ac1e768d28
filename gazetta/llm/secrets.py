"""Secret scans over content-addressed blobs, with DataFrame functions only.

Every version of every path is a blob named by the SHA-256 of its text. A ledger, a table on disk, holds the (blob,
rule version) pairs that were scanned before with their spans; only pairs it lacks are scanned, each distinct blob once, and
are written behind it. Findings come from the ledger, joined back to all paths and versions that hold the blob; blobs
of very many rows are spread over tasks in that join. A rule's leftmost non-overlapping matches and the text between
them come from the same pattern, so match positions are running sums of code-point lengths.

Defined cases: a null text is an empty blob; a blob without findings still enters the ledger; spans are ordered by
start, then by the order of the rules; repeated rows are returned as often as they came; other columns are
ignored; empty tables give empty results. Nothing limits the length of a text or the number of its spans.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, salted_join


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of `pattern` count if their group `group` has `least` code points or more.

    `gate` is a pattern that every counted match contains; texts without it are not split. `version` names the
    rule in the ledger and must change when anything else does.
    """

    kind: str
    pattern: str
    gate: str
    group: int = 0
    least: int = 0
    version: int = 1
    base: bool = False

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def _either(word: str) -> str:
    """The word with its letters in either case, as classes that all regex engines read alike."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
#: A key from its BEGIN line and headers over the body to the END line; without one to the last body line, which may be short.
#: Line ends may be escaped. Only plain classes are repeated without bound, so long bodies need no deep stack.
_PEM = (
    r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[\r\n]+[A-Za-z-]+:[^\r\n]*){0,9}"
    r"(?:[A-Za-z0-9+/=\x20\t\r\n\\]*-----END [A-Z ]*PRIVATE KEY-----|[A-Za-z0-9+/=\r\n\\]*[A-Za-z0-9+/=]{16,}(?:\r?\n[A-Za-z0-9+/=]+(?:[\r\n]|\z))?)?"
)
#: The three asked-for kinds first, then three more of the same sort.
RULES = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", f"{_NAMES}", group=2, least=8, base=True),
    Rule("access", r"AKIA[A-Z0-9]{12,}", "AKIA[A-Z0-9]{12}", base=True),
    Rule("hex", r"[0-9a-f]{32,}", "[0-9a-f]{32}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", "gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("pem", _PEM, "PRIVATE KEY-----", version=2),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", "eyJ[A-Za-z0-9_-]{8}"),
)
SPAN = "array<struct<start:int,ord:int,kind:string,end:int>>"
PIECE = 256  # hits that one list gathers before it is set aside, so that many hits of a text are not copied again and again


def spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans of one rule in a text, as structs (start, ord, kind, end) in code points."""
    none = F.array().cast(SPAN)
    parts = F.array(F.struct(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)).alias("hit"), F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)).alias("own")))

    def walk(x: Column) -> Column:
        end = lambda at, i: at + F.char_length(F.get(x["gap"], i)) + F.char_length(F.get(x["hit"], i))
        span = lambda at, i: F.array(F.struct((at + F.char_length(F.get(x["gap"], i))).alias("start"), F.lit(order).alias("ord"), F.lit(rule.kind).alias("kind"), end(at, i).alias("end"))).cast(SPAN)
        one = lambda acc, i: F.struct(end(acc["at"], i).alias("at"), F.when(F.char_length(F.get(x["own"], i)) >= rule.least, F.concat(acc["found"], span(acc["at"], i))).otherwise(acc["found"]).alias("found"))
        many = lambda acc, k: F.aggregate(
            F.sequence(k * PIECE, F.least((k + 1) * PIECE, F.size(x["hit"])) - 1), F.struct(acc["at"].alias("at"), none.alias("found")), one,
            lambda own: F.struct(own["at"].alias("at"), F.concat(acc["all"], F.array(own["found"])).alias("all")),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPAN}>").alias("all"))
        pieces = F.when(F.size(x["hit"]) > 0, F.sequence(F.lit(0), ((F.size(x["hit"]) - 1) / PIECE).cast("int"))).otherwise(F.array().cast("array<int>"))
        return F.aggregate(pieces, start, many, lambda acc: F.flatten(acc["all"]))

    return F.when(text.rlike(rule.gate), F.get(F.transform(parts, walk), F.lit(0))).otherwise(none)


def named(text: Column) -> Column:
    """The name of a text's blob."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


FOUND = f"array<struct<rule:string,spans:{SPAN}>>"


def scanned(history: DataFrame, rules: tuple[Rule, ...], ledger: DataFrame | None) -> DataFrame:
    """(blob, text, found) of each blob of (blob, text) that the ledger lacks a rule of: the spans of each rule that it lacks."""
    blobs = history.groupBy("blob").agg(F.first("text").alias("text"))
    none = F.array().cast("array<string>")
    if ledger is None:
        todo = blobs.withColumn("old", none)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list(F.col("found")["rule"]))).alias("old"))  # at most all rule versions
        todo = blobs.join(seen, "blob", "left").withColumn("old", F.coalesce("old", none)).where(F.size(F.array_except(F.array(*(F.lit(r.name) for r in rules)), F.col("old"))) > 0)
    new = F.array(*(F.when(~F.array_contains("old", r.name), F.struct(F.lit(r.name).alias("rule"), spans(F.col("text"), r, k).alias("spans"))) for k, r in enumerate(rules)))
    return todo.select("blob", "text", F.filter(new, lambda x: x.isNotNull()).cast(FOUND).alias("found"))


def merged(found: Column, rules: tuple[Rule, ...]) -> Column:
    """All spans of these rules, in order: by start, then as the rules stand now, whatever their order was when the ledger was written."""
    names = [r.name for r in rules]
    own = F.filter(found, lambda x: x["rule"].isin(names))
    place = lambda x: (F.array_position(F.array(*map(F.lit, names)), x["rule"]) - 1).cast("int")
    placed = lambda x: F.transform(x["spans"], lambda s: F.struct(s["start"].alias("start"), place(x).alias("ord"), s["kind"].alias("kind"), s["end"].alias("end")))
    return F.array_sort(F.flatten(F.transform(own, placed)))


def scan(history: DataFrame, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None, path_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Findings of every row of a history, and the ledger after the scan.

    `history` has one row for each version of each path. `ledger` has (blob, found), the spans of each rule version by
    which the blob was scanned; a blob that later rules scan again has further rows. Without one, all pairs are
    unseen. What is scanned now is written before findings are joined to it. Findings have (path, blob, spans).
    """
    history = history.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    history = history.withColumn("blob", named(F.col("text")))
    scratch = Scratch(history.sparkSession, "secrets")
    after = scratch.write(scanned(history, rules, ledger).select("blob", "found"), "ledger")
    if ledger is not None:
        after = ledger.select("blob", "found").unionByName(after)
    each = after.groupBy("blob").agg(F.flatten(F.collect_list("found")).alias("found")).select("blob", merged(F.col("found"), rules).alias("spans")).where(F.size("spans") > 0)
    findings = salted_join(history.select("path", "blob"), each, "blob", "path")
    return findings.select("path", "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans")), after


def written(found: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """Digest rows of a first scan of all documents."""
    found, _ = scan(docs)
    base = F.filter("spans", lambda x: x["kind"].isin([r.kind for r in RULES if r.base]))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(F.col("path").alias("doc_id"), count("assign"), count("access"), count("hex"), F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """The documents, all columns as before, with every span of every blob replaced by a mask.

    Overlapping spans share one mask. The redacted text belongs to the blob and is joined back to all its rows, so
    texts are shuffled once. A null text stays null.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = scanned(docs.select(named(text).alias("blob"), text.alias("text")), rules, None)
    found = found.select("blob", "text", merged(F.col("found"), rules).alias("spans"))
    # gaps between spans, and a mask for each run of spans that overlap
    past = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")), lambda acc, s: F.struct(
        F.greatest(acc["at"], s["end"]).alias("at"),
        F.when(s["start"] >= acc["at"], F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])))).otherwise(acc["out"]).alias("out"),
    ), lambda acc: F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, F.char_length("text")))))
    cut = F.array_join(past, mask)
    found = found.select(F.col("blob").alias("_blob"), F.when(F.size("spans") > 0, cut).otherwise(F.col("text")).alias("_text"))
    rest = docs.withColumn("_blob", named(text)).withColumn("_null", F.col(text_col).isNull()).drop(text_col)
    rest = rest.withColumn("_by", F.xxhash64(docs.columns[0]))
    out = salted_join(rest, found, "_blob", "_by").withColumn(text_col, F.when(~F.col("_null"), F.col("_text")))
    return out.select(docs.columns)
