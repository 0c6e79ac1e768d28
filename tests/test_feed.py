import pytest
from pyspark.sql import functions as F

from gazetta.functions import dates, flags, text, urls
from gazetta.operators import browse, lifecycle, quality, reconcile
from gazetta.sources import feed as feeds
from gazetta.sources import html, sinks

ROW = dict(zip(feeds.SUMMARY_COLUMNS, ["Example Council", "Council", "Administrator", "Administration", "Nottingham", "Nottingham", "2026-09-10", "17:00", "Permanent", "Full-time", "£25,000", "https://example.org/jobs/1", "REF-1", "2026-09-07", "https://example.org/jobs/1", "Support the service by filing."], strict=True))


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def feed(spark, *changes):
    rows = [(k + 2, *(ROW | c).values()) for k, c in enumerate(changes)]
    return spark.createDataFrame(rows, "rec_no int, " + feeds.FEED)


def test_white_space_and_case(spark):
    assert value(spark, text.collapsed(F.lit(" a \t b\x1c\n"))) == "a b"
    assert value(spark, text.trimmed(F.lit(" x y \n"))) == "x y"
    assert value(spark, text.folded(F.lit("Straße"))) == "strasse"
    assert value(spark, text.words(F.lit("  "))) == 0
    assert value(spark, text.escaped(F.lit("<a b='\"&'>"))) == "&lt;a b=&#39;&quot;&amp;&#39;&gt;"


@pytest.mark.parametrize(("day", "ok"), [("2026-02-28", True), ("2026-02-30", False), ("0050-01-01", False), ("2026-2-1", False), ("", False), ("2026-01-01\n", False)])
def test_strict_dates(spark, day, ok):
    assert value(spark, dates.is_date(F.lit(day))) is ok


def test_expiry_follows_the_london_clock(spark):
    today, now = dates.wall_clock("2026-10-13 10:00:00")  # summer time: eleven o'clock
    gone = lambda d, t: value(spark, dates.expired(F.lit(d), F.lit(t), today, now))
    assert [gone("2026-10-12", "17:00"), gone("2026-10-13", "11:00"), gone("2026-10-13", "11:01"), gone("2026-10-13", ""), gone("2026-10-12", "25:00"), gone("", "09:00")] == [True, True, False, False, False, False]
    assert value(spark, dates.urgency(F.lit("2026-10-15"), today)) == "Closes in 2 days"
    assert value(spark, dates.closing_text(F.lit("2026-09-05"), F.lit("17:00"))) == "5 Sep 2026, 17:00"


def test_urls(spark):
    assert value(spark, urls.is_safe(F.lit("/jobs/1"))) and not value(spark, urls.is_web(F.lit("/jobs/1")))
    assert not value(spark, urls.is_safe(F.lit("JavaScript:x")))
    assert value(spark, urls.authority(F.lit("https://u@h.org:8/p"))) == "u@h.org:8"
    assert value(spark, urls.parameter(F.lit("https://h/p?A=&a=x%20y#f"), "a", any_case=True)) == "x y"
    assert value(spark, urls.has_parameter(F.lit("https://h/p?uSession="), "USESSION"))
    assert value(spark, urls.resolved(F.lit("../b"), F.lit("https://h/a/c"))) == "https://h/b"
    assert not value(spark, urls.redirect_kept(F.lit("https://h/p?ref=1"), F.lit("https://h/p?ref=2")))


def test_browse_order_and_visibility(spark):
    rows = [
        dict(job_title="Zebra Administrator", organization="Alpha Council", closing_date="2026-10-15", apply_url="https://e.org/shared"),
        dict(job_title="Alpha Technician", organization="Beta Trust", closing_date="2026-10-20", apply_url="https://e.org/a"),
        dict(job_title="Undated Officer", organization="Gamma Council", closing_date="", apply_url="https://e.org/shared"),
        dict(job_title="School Assistant", organization="Delta School", closing_date="2026-10-13", closing_time="12:00", apply_url="https://e.org/s"),
        dict(job_title="Expired vacancy", closing_date="2026-10-12"),
        dict(job_title="Unsafe vacancy", closing_date="", apply_url="javascript:alert(1)"),
    ]
    f = feed(spark, *rows)
    at = "2026-10-13 10:00:00"
    names = lambda mode: [r["title"].split()[0] for r in browse.browse(f, at, mode=mode).collect()]
    assert names("closing-soonest") == ["School", "Zebra", "Alpha", "Undated"]
    assert names("closing-latest") == ["Alpha", "Zebra", "School", "Undated"]
    assert names("organisation-az") == ["Zebra", "Alpha", "School", "Undated"]
    assert names("title-az") == ["Alpha", "School", "Undated", "Zebra"]
    assert [r["title"] for r in browse.browse(f, "2026-10-13 11:00:00").collect()][0].startswith("Zebra")
    shared = {r["title"]: r["is_shared"] for r in browse.browse(f, at).collect()}
    assert shared["Undated Officer"] and not shared["School Assistant"]
    assert browse.browse(f, at, keyword="  ALPHA ").count() == 2
    assert browse.browse(f, at, organization="Beta Trust").count() == 1


@pytest.mark.parametrize(
    ("summary", "code"),
    [("", flags.BLANK), ("<p>x</p>", "markup_residue"), ("{{name}}", "unresolved_placeholder"), ("Read more...", "unexpanded_description"), ("word " * 80, "possible_truncation_requires_review"), ("You must drive", "requirements_first")],
)
def test_summary_flags(spark, summary, code):
    assert code in value(spark, flags.summary_flags(F.lit(summary)))


def test_findings(spark):
    long = " ".join(f"w{k}" for k in range(30))
    f = feed(spark, dict(job_summary=long, job_reference="1", salary=""), dict(job_summary=long.upper(), job_reference="2", salary=""), dict(job_summary=long + " x", job_reference="3", salary=" "))
    found = {(r["code"], r["field"]): r["row_numbers"] for r in quality.findings(f).collect()}
    assert found[("repeated_summary", "job_summary")] == [2, 3]
    assert found[("employer_field_entirely_blank", "salary")] == [2, 3, 4]
    assert quality.report(f).first()["row_count"] == 3


def test_strict_parser(spark, tmp_path):
    head = ",".join(feeds.SUMMARY_COLUMNS)
    line = ",".join(f'"{v}"' for v in ROW.values())
    cases = {
        "good": (f"﻿{head}\n{line}\n\n{line}\n".encode(), True, 2), "legacy": (",".join(feeds.LEGACY_COLUMNS).encode() + b"\n", True, 0), "fields": (f"{head}\na,b\n".encode(), False, 0),
        "case": (head.title().encode(), False, 0), "quote": (f'{head}\n"x'.encode(), False, 0), "bytes": (b"\xff\xfe", False, 0), "link": (f"{head}\n{line.replace('https://example.org/jobs/1', 'ftp://x')}\n".encode(), False, 1),
    }
    files = spark.createDataFrame([(k, bytearray(v[0])) for k, v in cases.items()], "path string, content binary")
    got = {r["path"]: r for r in feeds.validation(files).collect()}
    assert {k: (r["ok"], r["row_count"]) for k, r in got.items()} == {k: v[1:] for k, v in cases.items()}
    assert [r["rec_no"] for r in feeds.parse_strict(files.where("path = 'good'")).collect()] == [2, 4]


def test_feed_lines_are_minimally_quoted(spark):
    f = feed(spark, dict(job_title='say "x", y', salary=""))
    assert '"say ""x"", y",Administration' in feeds.csv_lines(f).first()["value"]


def test_decisions(spark):
    want = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "identity string")
    have = spark.createDataFrame([("a",), ("b",), ("b",), ("d",)], "identity string")
    assert {r["identity"]: r["problem"] for r in reconcile.cover_gaps(want, have).collect()} == {"b": "repeated", "c": "missing", "d": "unknown"}


@pytest.mark.parametrize(
    ("run", "codes"),
    [(("EMPTY", "s", "f", 0, True, "", ""), set()), (("EMPTY", "s", "f", 1, True, "", ""), {"empty_with_candidates"}), (("OK", "s", "f", 0, True, "", ""), {"ok_without_candidates"}), (("PARTIAL", "s", "f", 1, False, " ", ""), {"partial_without_limitation"}), (("RUNNING", "", "", 0, False, "", ""), {"running_not_started"}), (("NOPE", "", "", -1, False, "", ""), {"status_unknown", "count_negative"})],
)
def test_run_rules(spark, run, codes):
    runs = spark.createDataFrame([("x", *run)], "source_id string, status string, started_at string, finished_at string, candidate_count int, normal_collection_completed boolean, limitation string, error string")
    assert {r["code"] for r in lifecycle.run_violations(runs).collect()} == codes


def test_page_nodes_and_facts(spark):
    page = "<div><p><b>Salary:</b> £10 &amp; more<dl><dt>Hours</dt><dd>37</dd></dl></p><script>x</script><h2>About the role</h2><p>One</p><li>Two</li><h3>Benefits</h3><p>No</p><a href='/x'>go</a></div></span>"
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(html.labelled("html").alias("m")).first()["m"]["hours"] == "37"
    assert df.select(html.page_text("html").alias("t")).first()["t"].endswith("Benefits No go")
    items = df.select(html.section(html.blocks("html"), r"About the role\b").alias("s")).first()["s"]
    assert items == ["One", "Two"]
    assert df.select(html.nodes("html", "a", "li").alias("a")).first()["a"][1]["href"] == "/x"
    assert df.select(html.first_text(html.with_tag(html.nodes("html", "li", "h2"), "h2")).alias("t")).first()["t"] == "About the role"


def test_cards_and_conflicts(spark):
    rule = html.CardRule(card="c", link=r"JobId=", identity="param:JobId")
    card = "<div class='c'><a href='/d?JobId={}'>{}</a></div>"
    pages = {"two": card.format(1, "A") * 2 + card.format(2, "B"), "clash": card.format(1, "A") + card.format(1, "B"), "none": "<p>No vacancies</p>", "odd": "<p>10 results</p>"}
    df = spark.createDataFrame([(k, v) for k, v in pages.items()], "k string, html string")
    got = {r["k"]: r["c"] for r in df.select("k", html.cards("html", F.lit("https://h.org/l"), rule).alias("c")).collect()}
    assert [c["identity"] for c in got["two"]["cards"]] == ["1", "2"] and got["two"]["problem"] is None
    assert "conflicting" in got["clash"]["problem"] and got["none"]["problem"] is None and "evidence" in got["odd"]["problem"]


def test_salary_is_bounded(spark):
    pages = ["<p>Salary: £20,000 per year Location: here</p>", "<div>Salary: £5</div>", "<td><p>x</p><p>Salary: £7</p></td>"]
    df = spark.createDataFrame([(k, p) for k, p in enumerate(pages)], "k int, html string")
    assert [r["s"] for r in html.salary(df.orderBy("k"), name="s").collect()] == ["£20,000 per year", "", "£7"]


def test_partition_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a"), (2, "b")], "x int, source_id string").write.partitionBy("source_id").parquet(path)
    sinks.replace_partition(spark.createDataFrame([(3,)], "x int"), path, "source_id", "a")
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(3, "a"), (2, "b")}
    sinks.replace_partition(spark.createDataFrame([], "x int"), path, "source_id", "a")
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(2, "b")}


def test_streamed_collection_resumes(spark, tmp_path):
    from gazetta.streaming.visibility import collect_runs

    (tmp_path / "in").mkdir()
    args = (str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c"), "source_id string, x int")
    for k in range(2):
        (tmp_path / "in" / f"{k}.json").write_text(f'{{"source_id":"a","x":{k}}}\n')
        collect_runs(spark, *args).awaitTermination(60)
    assert sorted(r["x"] for r in spark.read.parquet(args[1]).collect()) == [0, 1]


@pytest.mark.parametrize(
    ("url", "safe"),
    [("/jobs/1", True), ("https://x.org/a", True), ("HTTP://x.org", True), ("\tjavascript:alert(1)", False), ("java\nscript:alert(1)", False), ("\x01javascript:alert(1)", False), ("http://", False), ("https:///", False), ("mailto:a@b", False), (" ", False), ("\r\n https://x.org \t", True), (None, False)],
)
def test_links_as_browsers_read_them(spark, url, safe):
    assert value(spark, urls.is_safe(F.lit(url).cast("string"))) is safe


def test_every_header_counts(spark, tmp_path):
    head, line = ",".join(feeds.SUMMARY_COLUMNS), ",".join(f'"{v}"' for v in ROW.values())
    for name, columns in (("a.csv", head), ("b.csv", ",".join(reversed(feeds.SUMMARY_COLUMNS)))):
        (tmp_path / name).write_text(f"{columns}\n{line}\n")
    with pytest.raises(ValueError, match="header"):
        feeds.read_bulk(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text(f"\ufeff{head}\n{line}\n,,,,,,,,,,,,,,,\nx\n")
    for multiline in (True, False):
        got = feeds.read_bulk(spark, str(tmp_path), multiline).collect()
        assert sorted(r["organization"] for r in got) == [ROW["organization"], ROW["organization"], "x"] and sum(r["_corrupt_record"] is not None for r in got) == 1
    (tmp_path / "c.csv").write_text(f"{','.join(feeds.LEGACY_COLUMNS)}\n")
    with pytest.raises(ValueError, match="header"):
        feeds.read_bulk(spark, str(tmp_path))


def test_conflicts_see_nulls(spark):
    rows = spark.createDataFrame([(1, None, "a"), (1, "a", None), (2, None, "a"), (2, None, "a"), (3, "x", "y"), (3, "x", None)], "k int, u string, v string")
    assert {r["k"] for r in lifecycle.conflicts(rows, ["k"], ["u", "v"]).collect()} == {1, 3}


def test_partition_names_are_escaped(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "a/b:c%d=e"), (2, "b")], "x int, source_id string").write.partitionBy("source_id").parquet(path)
    sinks.replace_partition(spark.createDataFrame([], "x int"), path, "source_id", "a/b:c%d=e")
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(2, "b")}


def test_state_is_checked_and_defaults(spark, tmp_path):
    path, kind = str(tmp_path / "runs"), "source_id string, n int"
    assert feeds.read_state(spark, path, kind).count() == 0
    rows = spark.createDataFrame([("a", 1)], kind)
    bad = rows.select("source_id", F.lit("x").alias("code"))
    with pytest.raises(ValueError, match="not saved"):
        sinks.save_checked(rows, path, bad)
    sinks.save_checked(rows, path, bad.where("false"))
    assert [tuple(r)[:2] for r in feeds.read_state(spark, path, kind).collect()] == [("a", 1)]


def test_pages_are_walked_once(spark):
    h = "https://h.org/"
    edges = [("a", "b", False), ("b", None, False), ("c", "d", False), ("d", "c", False), ("e", "x", True), ("f", "https://other.org/", False), *((f"n{k}", f"n{k + 1}", False) for k in range(9))]
    full = lambda u: u if u is None or u.startswith("http") else h + u
    links = spark.createDataFrame([(full(a), full(b), c) for a, b, c in edges], "page_url string, next_url string, ambiguous boolean")
    start = spark.createDataFrame([(h + s,) for s in ("a", "c", "e", "f", "n0")], "page_url string")
    got = {(r["page_url"].removeprefix(h), r["step"]): r["problem"] for r in lifecycle.page_numbers(links, start, budget=4).collect()}
    assert got == {("a", 0): None, ("b", 1): None, ("c", 0): None, ("d", 1): "repeated page", ("e", 0): "ambiguous", ("f", 0): "other site", ("n0", 0): None, ("n1", 1): None, ("n2", 2): None, ("n3", 3): "budget"}


PAGES = {
    "jobtrain": ("<div id='Media_Rich_Advert'><h2>About the Role</h2><p>Lead.</p><ul><li>Plan.</li></ul><h2>Benefits</h2><p>Tea</p></div><p>Out</p>", ["Lead.", "Plan."]),
    "jobtrain ": ("<p>Salary £1</p><p>(£9 an hour)</p><p>You help.</p><h3>About you</h3><p>No</p>", ["You help."]),
    "oracle-cloud": ("<p>Before</p><div class='x job-details__description-content'><p>About the Role: Sort things.</p><p>More.</p><p>About You</p><p>No</p></div>", ["Sort things.", "More."]),
    "oracle-cloud ": ("<p>About the role</p><p>outside</p>", []),
    "university-vacancies": ("<div id='main'><h1>T</h1><p>About you</p><p>Duty.</p><p>Informal enquiries to X</p><p>No</p></div>", ["About you", "Duty."]),
    "healthjobsuk-trac": ("<div id='hj-job-advert'><h3>Job overview</h3><p>One</p><h3>Main duties of the job</h3><p>Two</p><p>One</p><h3>Working for our organisation</h3><p>No</p></div>", ["One", "Two", "One"]),
    "govuk-teaching-vacancies": ("<div id='job-details'><h3>What skills and experience we're looking for</h3><p>Teach.</p><h3>Benefits</h3><p>No</p><h3>Further information about the job</h3><p>Teach.</p><p>Part time.</p></div>", ["Teach.", "Part time."]),
    "http": ("<p>About the role</p><p>x</p>", []),
}


def test_role_paragraphs(spark):
    df = spark.createDataFrame([(k, k.strip(), page) for k, (page, _) in PAGES.items()], "k string, method string, html string")
    got = {r["k"]: r["texts"] for r in html.role_paragraphs(df, name="texts").collect()}
    assert got == {k: want for k, (_, want) in PAGES.items()}


def test_facts_of_headings_and_labels(spark):
    page = "<dl><dt><h3>Job role</h3></dt><dd>Teacher</dd><dt><h3>Subject</h3></dt><dd>Maths View all maths jobs</dd></dl><h3>Key stage</h3><p>KS3</p><p>KS4</p><h2>Next</h2><p>No</p><p><strong>Hours :</strong> 37 <em>a week</em></p><p><b>Pay</b>: £1</p><dt>Pay</dt><dd>£2</dd><dt>None</dt><p>x</p>"
    df = spark.createDataFrame([(page,)], "html string")
    got = df.select(html.headed_facts("html").alias("h"), html.labelled("html").alias("l")).first()
    assert got["h"] == {"job role": "Teacher", "subject": "Maths", "key stage": "KS3 KS4"}
    assert got["l"] == {"hours": "37 a week", "pay": "£2", "job role": "Teacher", "subject": "Maths View all maths jobs"}


def test_from_list_page_to_complete_candidates(spark):
    from gazetta.operators import candidates

    rule = html.CardRule(card="c", link=r"JobId=", identity="param:JobId", texts={"location": "place"}, facts={"salary": "salary"})
    page = "<div class='c'><a href='/d?JobId=1'>Clerk</a><p class='place'>Hall</p><p><b>Salary:</b> £9</p></div><div class='c'><a href='/d?JobId=2'>Cook</a></div>"
    pages = spark.createDataFrame([("s", "https://h.org/l", page)], "source_id string, url string, html string")
    sources = spark.createDataFrame([("s", "fam", "Council", "https://h.org/l")], "source_id string, family string, name string, fixed_route string")
    cards = pages.select("source_id", F.explode(html.cards("html", "url", rule)["cards"]).alias("card"))
    first = candidates.from_cards(cards, sources, "2026-01-01T00:00:00Z", "http")
    assert first.columns == [*candidates.FIELDS, "provenance", "status"] and lifecycle.candidate_violations(first.withColumn("candidate_id", F.col("source_platform_id"))).count() == 0
    assert candidates.due(first, F.col("source_platform_id"), 1).select("raw_title").collect() == [("Clerk",)]
    details = spark.createDataFrame([("https://h.org/d?JobId=1", {"raw_salary": "£10", "source_reference": "R1"}, "https://apply.org/1", "{}", None), ("https://h.org/d?JobId=2", None, None, None, "HTTP 500")], "detail_url string, facts map<string,string>, raw_apply_url string, evidence string, error string")
    got = {r["source_platform_id"]: r for r in candidates.with_details(first, details).collect()}
    assert (got["1"]["raw_salary"], got["1"]["raw_location"], got["1"]["source_reference"], got["1"]["apply_url"], got["1"]["source_url"], got["1"]["status"]) == ("£10", "Hall", "R1", "https://apply.org/1", "https://h.org/d?JobId=1", "DETAIL_COMPLETE")
    assert got["2"]["status"] == "CAPTURED" and "HTTP 500" in got["2"]["provenance"]["detail_error"] and got["2"]["raw_organization"] == "Council"
    again = candidates.with_details(candidates.with_details(first, details), details.where("error is null").withColumn("detail_url", F.lit("https://h.org/d?JobId=2")))
    assert {r["source_platform_id"]: "detail_error" in r["provenance"] for r in again.collect()} == {"1": False, "2": False}


def test_sole_posting(spark):
    one, other = '{"@type":"JobPosting","baseSalary":{"value":{"value":"5"}},"employmentType":["A","B"]}', '{"@type":"Other"}'
    df = spark.createDataFrame([([one, other],), ([one, one],), ([other],)], "r array<string>")
    rows = df.select(html.posting_salary(html.posting(F.col("r"), sole=True)).alias("sole"), html.posting_types(html.posting(F.col("r"))).alias("first")).collect()
    assert [(r["sole"], r["first"]) for r in rows] == [("5", "A, B"), ("", "A, B"), ("", "")]


FLAGGED = {
    "markup_residue": ("see <br> here", "5 < 6 and 7 > 2"), "script_residue": ("const x = 1;", "a function of the council"), "unresolved_placeholder": ("[object Object]", "an object"), "unexpanded_description": ("Tea. Show more...", "Show more care to others in need"),
    "possible_truncation_requires_review": ("and then…", "It ends."), "short_requires_semantic_review": ("few words", "word " * 30), "employer_branding": ("You build a rewarding career here", "You build a wall"), "metadata_first": ("Salary: £1 and so on", "The salary is £1"),
    "promotional_requires_semantic_review": ("we offer a good pension", "we offer a good desk"), "requirements_first": ("Degree in art", "A degree in art"), "recruitment_or_criteria_prefix_requires_review": ("You will have tea", "They will have tea"), "truncated_sentence": ("You work as part of a.", "You work as part of a team."),
    "recruitment_prefix_requires_review": ("The school is seeking a cook", "The school has a cook"), "employer_edi_boilerplate": ("We are Disability Confident", "We are confident"),
}


def test_each_review_rule_fires_and_rests(spark):
    df = spark.createDataFrame([(k, *v) for k, v in FLAGGED.items()], "code string, yes string, no string")
    for r in df.select("code", flags.summary_flags("yes").alias("yes"), flags.summary_flags("no").alias("no")).collect():
        assert r["code"] in r["yes"] and r["code"] not in r["no"], r
    assert value(spark, flags.salary_flags(F.lit("£1 Location: x"))) == ["salary_contains_other_fields"] and value(spark, flags.salary_flags(F.lit("£1"))) == []
    assert value(spark, flags.title_flags(F.lit("Cook (internal vacancy only)"))) == ["explicit_internal_only_requires_eligibility_review"] and value(spark, flags.title_flags(F.lit("Cook"))) == []


def test_text_at_the_edges(spark):
    assert value(spark, text.words(F.lit("\u2003a\x1cb\u00a0 c\n"))) == 3 and value(spark, text.words(F.lit(" \u2028"))) == 0
    assert value(spark, text.trimmed(F.lit("\u3000\x1f a b \x85"))) == "a b"
    assert value(spark, urls.parameter(F.lit("https://x/?a.b=1&axb=2"), "a.b")) == "1"
    assert value(spark, urls.destination_problem(F.lit("https://x/?usession=1"), F.lit("itrent"), F.lit("https://b/"), F.lit(True))) == "link_bound_to_session"
    assert value(spark, urls.advert_link(F.lit("/a"), F.lit("https://x.org/l"))) == "https://x.org/a" and value(spark, urls.advert_link(F.lit("https://y.org/a"), F.lit("https://x.org/l"))) is None


def test_references_without_semicolon(spark):
    """A cut reference stays as it stands where closed ones alone count; the parser alone reads it."""
    page = "<title>T</title><h1>a &amp;&amp;amp &copy; R&D &#38; &#3 &amp</h1>"
    df = spark.createDataFrame([(page,), (None,)], "html string")
    head = lambda c: [r["t"] for r in df.select(html.first_text(html.nodes(c, "h1")).alias("t")).collect()]
    assert head(html.closed_references("html")) == ["a &&amp © R&D & &#3 &amp", ""]
    assert head("html")[0].endswith("&")


def test_title_query_over_cut_references(spark, tmp_path):
    from gazetta.plans.queries import queries

    page = "<html><head><title>x&amp</title></head><body><h1>x&amp;&amp</h1></body></html>"
    spark.createDataFrame([(1, "https://h.org/", page)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert [tuple(r) for r in queries()["html_title_h1"](spark, str(tmp_path)).select("page_id", "titles", "h1").collect()] == [(1, 1, "x&&amp")]
