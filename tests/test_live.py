"""Visibility as a stream with timers: over clock changes and a restart."""

import json
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from gazetta.functions import dates
from gazetta.streaming import visibility

LONDON = ZoneInfo("Europe/London")


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp()


@pytest.mark.parametrize(("closes", "after", "want"), [
    ("2026-06-15T10:30", "2026-06-15T08:00", ["2026-06-15T09:30"]),  # summer time
    ("2026-12-01T00:00", "2026-06-15T08:00", ["2026-12-01T00:00"]),
    ("2026-03-29T01:30", "2026-03-28T00:00", ["2026-03-29T01:00"]),  # the clock jumps over it
    ("2026-10-25T01:30", "2026-10-24T00:00", ["2026-10-25T00:30", "2026-10-25T01:00", "2026-10-25T01:30"]),  # told twice
    ("2026-10-25T01:00", "2026-10-24T00:00", ["2026-10-25T00:00"]),
    ("2026-10-25T02:00", "2026-10-24T00:00", ["2026-10-25T02:00"]),
    ("2026-06-15T10:30", "2026-06-15T09:30", []),
])
def test_next_change(closes, after, want):
    at, got = utc(after), []
    while (at := visibility.next_change(closes, at, LONDON)) is not None:
        got.append(datetime.fromtimestamp(at, timezone.utc).strftime("%Y-%m-%dT%H:%M"))
    assert got == want


def test_closes(spark):
    rows = [("2026-02-28", ""), ("2026-02-28", "09:05"), ("2026-02-30", ""), ("2026-02-28", "25:00"), ("", ""), (None, None)]
    got = spark.createDataFrame(rows, "d string, t string").select(dates.closes("d", "t").alias("c")).collect()
    assert [r["c"] for r in got] == ["2026-03-01T00:00", "2026-02-28T09:05", None, None, None, None]


FIELDS = "job_reference string, apply_url string, closing_date string, closing_time string, seen_at string"


def test_changes_over_a_clock_change_and_a_restart(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        def land(name, rows):
            (tmp_path / "in").mkdir(exist_ok=True)
            lines = [json.dumps(dict(zip([f.split()[0] for f in FIELDS.split(", ")], r, strict=True))) for r in rows]
            (tmp_path / "in" / f"{name}.json").write_text("\n".join(lines))
            feed = spark.readStream.schema(FIELDS).json(str(tmp_path / "in"))
            ticks = feed.where("job_reference = 'tick'")
            out = visibility.visibility_changes(feed.where("job_reference <> 'tick'"), ticks)
            q = out.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
            q.awaitTermination(90)
            assert q.exception() is None and not q.isActive
            return {(r["advert"], r["at"].strftime("%m-%d %H:%M"), r["visible"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}

        web = "https://a.org/"
        first = land("1", [
            ("twice", web, "2026-10-25", "01:30", "2026-10-24T09:00:00Z"), ("day", web, "2026-10-25", "", "2026-10-24T09:00:00Z"), ("never", web, "", "", "2026-10-24T09:00:00Z"),
            ("gone", web, "2026-10-23", "", "2026-10-24T09:00:00Z"), ("unsafe", "ftp://x", "2026-10-25", "", "2026-10-24T09:00:00Z"), ("moved", web, "2026-10-25", "00:15", "2026-10-24T09:00:00Z"),
        ])
        shown = {(k, "10-24 09:00", True) for k in ("twice", "day", "never", "moved")}
        assert first == shown
        assert land("2", [("tick", "", "", "", "2026-10-24T20:00:00Z")]) == shown  # a quiet list tells nothing
        later = land("3", [("moved", web, "2026-10-30", "00:15", "2026-10-24T21:00:00Z")])  # a later deadline: still shown, nothing told
        assert later == shown
        told = land("4", [("tick", "", "", "", "2026-10-25T00:31:00Z")])
        assert told - shown == {("twice", "10-25 00:30", False)}
        told = land("5", [("tick", "", "", "", "2026-10-25T01:31:00Z")])
        assert told - shown == {("twice", "10-25 00:30", False), ("twice", "10-25 01:00", True), ("twice", "10-25 01:30", False)}
        told = land("6", [("tick", "", "", "", "2026-10-26T12:00:00Z")])
        assert told - shown == {("twice", "10-25 00:30", False), ("twice", "10-25 01:00", True), ("twice", "10-25 01:30", False), ("day", "10-26 00:00", False)}
    finally:
        spark.conf.unset(key)
