"""Registry, evidence, decisions, details, sinks and streams on literal rows."""

import json

import pytest
from pyspark.sql import functions as F

from gazetta.functions import text
from gazetta.operators import lifecycle, reconcile
from gazetta.sources import feed as feeds
from gazetta.sources import html, sinks
from gazetta.streaming import visibility

SOURCE = {"source_id": "a", "name": "A", "family": "f", "method": "http", "fixed_route": "https://a.org/", "fallback": "none"}


@pytest.mark.parametrize(("change", "ok"), [({}, True), ({"schema_version": 2}, False), ({"source_count": 3}, False), ({"sources": [SOURCE, SOURCE]}, False), ({"sources": [SOURCE | {"name": " "}]}, False), ({"sources": []}, False)])
def test_registry(spark, tmp_path, change, ok):
    doc = {"registry_id": "r", "schema_version": 1, "source_count": len(change.get("sources", [SOURCE])), "sources": [SOURCE]} | change
    (tmp_path / "r.json").write_text(json.dumps(doc, indent=1))
    if ok:
        assert [r["source_id"] for r in feeds.registry(spark, str(tmp_path / "r.json")).collect()] == ["a"]
    else:
        with pytest.raises(ValueError, match="contract"):
            feeds.registry(spark, str(tmp_path / "r.json"))


def test_evidence(spark):
    files = spark.createDataFrame([(bytearray(b"x"),), (bytearray(b"x"),)], "content binary")
    meta = spark.createDataFrame([("u", "2d711642b726b04401627ca9fbac32f5c8530fb1903cc4db02258717921a4881"), ("v", "00")], "url string, sha256 string")
    assert {r["url"]: r["intact"] for r in feeds.evidence(files, meta).collect()} == {"u": True, "v": False}


def test_stale_checkpoints(spark):
    registry = spark.createDataFrame([(s, "r", 1, f"https://{s}.org") for s in "abcd"], "source_id string, registry_id string, schema_version int, fixed_route string")
    runs = spark.createDataFrame([("a", "RUNNING"), ("b", "RUNNING"), ("c", "OK")], "source_id string, status string")
    have = spark.createDataFrame([("b", "r", 1, "https://b.org"), ("c", "r", 2, "https://old.org")], "source_id string, registry_id string, registry_schema_version int, fixed_route string")
    assert {tuple(r) for r in lifecycle.stale_checkpoints(runs, have, registry).collect()} == {("a", "running_without_checkpoint"), ("c", "registry_mismatch"), ("c", "route_changed")}


def test_candidate_rules(spark):
    kind = "candidate_id string, source_id string, raw_title string, list_url string, source_url string, detail_url string, status string"
    rows = spark.createDataFrame([("1", "s", "t", "https://x", "", "", "CAPTURED"), ("2", "", " ", "", " ", "ftp://x", "LIST_ONLY")], kind)
    assert {tuple(r) for r in lifecycle.candidate_violations(rows).collect()} == {("2", c) for c in ("source_id_missing", "raw_title_missing", "link_missing", "link_not_web", "status_unknown")}


def test_reused_details_and_counters(spark):
    listed = spark.createDataFrame([("u",), ("v",), ("w",)], "detail_url string")
    old = spark.createDataFrame([("u", "CAPTURED"), ("u", "DETAIL_COMPLETE"), ("v", "EXCLUDED")], "detail_url string, status string")
    assert {r["detail_url"]: (r["old_status"], r["remains"]) for r in lifecycle.reused(listed, old).collect()} == {"u": ("DETAIL_COMPLETE", False), "v": ("EXCLUDED", True), "w": (None, True)}
    own = spark.createDataFrame([("s", "DETAIL_COMPLETE"), ("s", "CAPTURED")], "source_id string, status string")
    fetched = spark.createDataFrame([("s", "p1", False), ("s", "p1", True), ("t", "p", False)], "source_id string, page string, cached boolean")
    assert {r["source_id"]: tuple(r)[1:] for r in lifecycle.counters(own, fetched).collect()} == {"s": (2, 1, 1, 1, 1), "t": (0, 0, 1, 1, 0)}


def test_decided_rows_and_unrouted(spark):
    row = {c: c for c in feeds.SUMMARY_COLUMNS}
    told = spark.createDataFrame([("i", "include", row), ("j", "exclude", row)], "identity string, outcome string, row map<string,string>")
    assert [r["job_title"] for r in reconcile.included_rows(told).collect()] == ["job_title"]
    claimed = spark.createDataFrame([(1, "A", None), (2, "A", "s"), (3, "B", None)], "rec_no int, organization string, source_id string")
    sources = spark.createDataFrame([("s", ["A", "C"])], "source_id string, employers array<string>")
    assert [r["rec_no"] for r in reconcile.unrouted(claimed, sources).collect()] == [1]
    counts = spark.createDataFrame([(2, 1)], "total_rows int, blank_summaries int")
    assert json.loads(reconcile.manifest(counts, checked_date="d").first()["manifest"]) == {"checked_date": "d", "audit": {"total_rows": 2, "blank_summaries": 1}}


def test_sinks(spark, tmp_path):
    rows = [{c: f"{c}{k}" for c in feeds.SUMMARY_COLUMNS} | {"organization": o} for k, o in enumerate(("beta", "Alpha", "alpha"))]
    sinks.write_feed(spark.createDataFrame(rows, feeds.FEED), str(tmp_path / "f"))
    lines = [line for part in sorted((tmp_path / "f").glob("part-*")) for line in part.read_text().splitlines()]
    assert [line.split(",")[0] for line in lines] == ["Alpha", "alpha", "beta"]
    path, one = str(tmp_path / "t"), spark.createDataFrame([(1, "a")], "k int, v string")
    sinks.append_unique(one, path, ["k"])
    with pytest.raises(ValueError, match="there already"):
        sinks.append_unique(one, path, ["k"])
    with pytest.raises(ValueError, match="repeat"):
        sinks.append_unique(one.union(one), path, ["k"])
    sinks.append_unique(one.withColumn("k", F.lit(2)), path, ["k"])
    assert spark.read.parquet(path).count() == 2


def test_details(spark):
    page = "<p class='l'>Hours:</p><i class='v'>37</i><div><b class='l'>Basis</b><b class='v'>Full</b></div>"
    df = spark.createDataFrame([(page, {"closing": "x", "contract type": "", "hours": "37"})], "html string, facts map<string,string>")
    assert df.select(html.paired("l", "v")("html").alias("m")).first()["m"] == {"hours": "37", "basis": "Full"}
    got = df.select(*(c.alias(n) for n, c in html.detail(F.col("facts"), {"salary": F.lit("£1"), "contract": F.lit("listed")}).items())).first().asDict()
    assert got == {"deadline": "x", "salary": "£1", "contract": "", "work_pattern": "37", "reference": "", "location": ""}
    assert df.select(text.without_label(F.lit("SALARY  £1"), "salary").alias("t")).first()["t"] == "£1"


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    line = ",".join(f'"{c}"' for c in feeds.SUMMARY_COLUMNS)
    (tmp_path / "in" / "a.csv").write_text(",".join(feeds.SUMMARY_COLUMNS) + f"\n{line}\n")
    run = lambda df, name, mode: df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start().awaitTermination(60)
    run(visibility.feed_stream(spark, str(tmp_path / "in")), "landed", "append")
    assert [r["job_title"] for r in spark.table("landed").collect()] == ["job_title"]
    rows = spark.createDataFrame([("2026-10-13 10:30:00", "2026-10-13", "12:00", "https://x"), ("2026-10-13 11:30:00", "2026-10-13", "12:00", "https://x")], "seen_at string, closing_date string, closing_time string, apply_url string")
    assert visibility.visible_now(rows.withColumn("seen_at", F.to_timestamp("seen_at"))).count() == 1
    spark.createDataFrame([("2026-01-01 00:10:00", "a"), ("2026-01-01 00:20:00", "a"), ("2026-01-01 09:00:00", "b")], "ts string, event_type string").write.json(str(tmp_path / "events"))
    events = spark.readStream.schema("ts timestamp, event_type string").json(str(tmp_path / "events"))
    run(visibility.changes(events), "counted", "append")
    assert [(r["event_type"], r["n"]) for r in spark.table("counted").collect()] == [("a", 2)]
