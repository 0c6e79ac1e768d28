"""Exact folding, finding heads, counts at moments, unknown sources and tables that are replaced whole."""

import sys

import pytest
from pyspark.sql import functions as F

from gazetta.functions import flags, text
from gazetta.operators import browse, candidates, quality
from gazetta.sources import versions


def test_folding_is_casefold_for_every_letter(spark):
    letters = [chr(k) for k in range(sys.maxunicode + 1) if not 0xD800 <= k < 0xE000]
    rows = ["".join(letters[k : k + 64]) for k in range(0, len(letters), 64)] + ["Straße ŒUVRE", "ΣΑΣ İ", "ABC", "", None]
    got = spark.createDataFrame([(r,) for r in rows], "t string").select("t", text.folded("t").alias("f")).collect()
    assert all(r["f"] == (r["t"] or "").casefold() for r in got)


def test_heads_and_rows_are_the_findings(spark):
    big = 3_000_000_000
    words = " ".join(f"w{k}" for k in range(30))
    rows = [(big + k, "Acme" if k % 2 else " ACME ", f"job {k % 3}", str(k), "", words if k < 6 else "") for k in range(9)] + [(1, "Solo", "x", "1", "£1", words.upper())]
    feed = spark.createDataFrame(rows, "rec_no long, organization string, job_title string, job_reference string, salary string, job_summary string")
    lists = {(r["code"], r["field"], tuple(r["row_numbers"])) for r in quality.findings(feed).collect()}
    heads = {r["finding"]: r for r in quality.finding_heads(feed).collect()}
    members = {}
    for r in quality.finding_rows(feed).collect():
        members.setdefault(r["finding"], []).append(r["row_number"])
    assert {(h["code"], h["field"], tuple(sorted(members.get(name, [h["first"]])))) for name, h in heads.items()} == lists
    assert all(h["n"] == len(members.get(name, [0])) and h["first"] == min(members.get(name, [h["first"]])) for name, h in heads.items())
    assert {h["code"] for h in heads.values()} >= {"repeated_summary", "employer_field_entirely_blank"}


def test_counts_at_any_moment_equal_a_scan(spark):
    rows = [(f"org{k % 3}", "area" if k % 2 else "", ["2026-10-25", "2026-03-29", "", "2026-02-30"][k % 4], ["", "01:30", "10:30", "25:00"][k // 4 % 4], "https://a.org" if k % 7 else "ftp://x") for k in range(64)]
    feed = spark.createDataFrame(rows, "organization string, job_area string, closing_date string, closing_time string, apply_url string").withColumns({"location_area": F.lit("x"), "work_pattern": F.lit("")})
    index = browse.visible_index(feed)
    for asof in ("2026-03-29 00:59:00", "2026-03-29 01:00:00", "2026-10-25 00:29:00", "2026-10-25 00:30:00", "2026-10-25 01:00:00", "2026-10-25 10:30:00", "2026-10-26 00:00:00", "1999-01-01 00:00:00"):
        seen = browse.visible(feed, asof).collect()
        want = {("", ""): len(seen)} if seen else {}
        for f in browse.FACETS:
            for r in seen:
                if r[f]:
                    want[f, r[f]] = want.get((f, r[f]), 0) + 1
        assert {(r["facet"], r["value"]): r["visible"] for r in browse.visible_at(index, asof).collect()} == want


def test_unknown_sources_end_the_job_or_are_told(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "source_id string, k int")
    registry = spark.createDataFrame([("a", "A")], "source_id string, name string")
    with pytest.raises(Exception, match="unknown source"):
        candidates.looked_up(rows, registry).collect()
    assert [r["name"] for r in candidates.looked_up(rows.where("k = 1"), registry).collect()] == ["A"]
    assert {r["k"]: r["problem"] for r in candidates.looked_up(rows, registry, strict=False).collect()} == {1: None, 2: "unknown source", 3: "unknown source"}


def test_a_failing_write_leaves_the_old_version(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "k int, v string"
    table = lambda **kw: sorted(tuple(r) for r in versions.read(spark, path, kind, **kw).collect())
    assert table() == []
    old = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v"))
    assert versions.replace(old, path) == 1
    failing = spark.range(0, 100, 1, 4).select(F.when(F.col("id") == 99, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("id").cast("int")).alias("k"), F.lit("new").alias("v"))
    with pytest.raises(Exception, match="stop"):
        versions.replace(failing, path)
    assert table() == [(k, "old") for k in range(100)]
    assert versions.clean(spark, path) == 1  # what the failing write left
    base = versions.current(spark, path)
    assert versions.replace(old.limit(1), path) == 2
    with pytest.raises(ValueError, match="another writer"):
        versions.replace(old.limit(2), path, base=base)
    assert table() == [(0, "old")] and len(table(version=1)) == 100


def test_parts_are_replaced_alone(spark, tmp_path):
    path, kind = str(tmp_path / "t"), "k int"
    rows = lambda *ks: spark.createDataFrame([(k,) for k in ks], kind)
    versions.replace(rows(1, 2), path, part="a/1 ü")
    versions.replace(rows(3), path, part="b")
    versions.replace(rows(4), path, part="a/1 ü")
    read = lambda **kw: sorted((r["part"], r["k"]) for r in versions.read(spark, path, kind, column="part", **kw).collect())
    assert read() == [("a/1 ü", 4), ("b", 3)] and read(version=2) == [("a/1 ü", 1), ("a/1 ü", 2), ("b", 3)]
    assert versions.remove_part(spark, path, "b") == 4 and read() == [("a/1 ü", 4)]
    assert versions.clean(spark, path, keep=1) == 2 and read() == [("a/1 ü", 4)]


def test_texts_are_folded_once(spark):
    """What repeats is found among written digests: no text is folded by the plans that read them."""
    rows = [(k + 2, "Org", "Title", f"r{k}", "", " ".join(["Straße word"] * 20) if k < 4 else f"own {k} " * 30) for k in range(8)]
    feed = spark.createDataFrame(rows, "rec_no long, organization string, job_title string, job_reference string, salary string, job_summary string")
    found = quality.repeated_summaries(feed)
    assert [r["row_numbers"] for r in found.collect()] == [[2, 3, 4, 5]]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" not in plan and "regexp_replace" not in plan
    few = feed.withColumn("job_summary", F.concat(F.lit("  "), F.array_join(F.array_repeat(F.lit("w"), (F.col("rec_no") + 25).cast("int")), " \n")))
    assert sorted(r["n"] for r in quality.summary_rows(few).collect()) == [5, 6, 7, 8, 9]
    assert {r["n"] for r in quality.summary_rows(feed.withColumn("job_summary", F.lit(" ")), least=1).collect()} == set()


def test_gates_of_rules_for_any_case(spark):
    """Letters beyond ASCII that patterns take for a-z are taken so by what decides whether a text is searched."""
    df = spark.range(0x80, 0x10000).where((F.col("id") < 0xD800) | (F.col("id") > 0xDFFF)).select(F.decode(F.unhex(F.lpad(F.hex("id"), 4, "0")), "UTF-16BE").alias("c"))
    loose = df.where(F.col("c").rlike("(?diuU)[a-z]")).select("c", flags.plain(F.col("c")).alias("p")).collect()
    assert {r["c"]: r["p"] for r in loose} == flags.LOOSE
    texts = ["We have internal vacancies.", "Read MORE", "ſee  more", "It seems we are looKing for you", "he İs seekıng", "PROTECTED Characteristıcs", "so it ends; and A.", "DOİNG things differently", "WE OFFER a PENſION", "Closing DATE: x Intervıews:"]
    rules = [(code, p) for code, how, p in flags.SUMMARY if how == "i"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = df.select("t", flags.summary_flags("t").alias("f"), *(F.col("t").rlike(f"(?diuU){p}").alias(f"r{k}") for k, (_, p) in enumerate(rules))).collect()
    for r in found:
        assert set(r["f"]) - {"short_requires_semantic_review"} == {code for k, (code, _) in enumerate(rules) if r[f"r{k}"]}
    assert sum(len(r["f"]) > 1 for r in found) == 9
