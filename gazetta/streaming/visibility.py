"""Streaming forms: the feed folder as a stream, and visibility by the clock. These go beyond the batch feed."""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from gazetta.functions import dates, urls
from gazetta.sources.feed import FEED, normalized


def feed_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Rows of feed files as they land; the checkpoint of the query is what a resumed run starts from."""
    return normalized(spark.readStream.schema(FEED).option("header", True).option("escape", '"').option("maxFilesPerTrigger", files_per_trigger).csv(folder))


def visible_now(feed: DataFrame, clock: str = "seen_at") -> DataFrame:
    """Rows visible at the time of a timestamp column, in London time."""
    at = F.from_utc_timestamp(clock, "Europe/London")
    gone = dates.expired("closing_date", "closing_time", F.date_format(at, "yyyy-MM-dd"), F.hour(at) * 60 + F.minute(at))
    return feed.where(~gone & urls.is_safe("apply_url"))


def changes(events: DataFrame, minutes: int = 60, late: str = "2 hours") -> DataFrame:
    """Counts of events by window and type, closed after `late`."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", f"{minutes} minutes"), "event_type").agg(F.count("*").alias("n"))


def collect_runs(spark: SparkSession, landing: str, table: str, checkpoint: str, schema: str):
    """Append landed candidates to a table once each: a query that ends when all is read and resumes from its checkpoint."""
    rows = spark.readStream.schema(schema).json(landing)
    return rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).partitionBy("source_id").trigger(availableNow=True).start()


def _past(closes: str, at: float, zone: ZoneInfo) -> bool:
    """Whether the wall clock has reached a minute `YYYY-MM-DDTHH:MM` at a moment."""
    return datetime.fromtimestamp(at, zone).strftime("%Y-%m-%dT%H:%M") >= closes


def next_change(closes: str, at: float, zone: ZoneInfo) -> float | None:
    """The first moment after `at` at which the wall clock passes a minute, or falls back behind it, if any.

    A minute of the hour that is told twice is passed twice, with the return in between; one that the clock jumps over is passed at the jump.
    """
    local = datetime.fromisoformat(closes)
    near = [local.replace(tzinfo=zone, fold=f).timestamp() for f in (0, 1)]
    hour = min(near) // 3600 * 3600
    for moment in sorted({*near, *(hour + 3600 * k for k in range(-2, 4))}):  # clocks change on the hour
        if moment > at and _past(closes, moment, zone) != _past(closes, moment - 1, zone):
            return moment
    return None


class Expiry(StatefulProcessor):
    """One advert: its last row, whether it is shown, and a timer for the next minute that changes this."""

    def __init__(self, zone: str):
        self.name = zone

    def init(self, handle) -> None:
        self.handle, self.zone = handle, ZoneInfo(self.name)
        self.state = handle.getValueState("advert", "closes string, safe boolean, shown boolean")

    def _told(self, key, closes, safe, shown, at, clock):
        """Tell what changes at a moment and up to the clock, keep the state, and set the timer of the next change."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        while at is not None:
            now = safe and (closes is None or not _past(closes, at, self.zone))
            if now != shown:
                moment = datetime.fromtimestamp(at, timezone.utc).replace(tzinfo=None)
                yield pd.DataFrame({"advert": [key], "at": pd.to_datetime([moment]), "visible": [now]})
            shown, at = now, next_change(closes, at, self.zone) if safe and closes is not None else None
            if at is not None and at >= clock:
                self.handle.registerTimer(int(at * 1000))
                break
        self.state.update((closes, safe, shown))

    def handleInputRows(self, key, rows, timerValues):
        last = None
        for part in rows:
            for r in part.itertuples(index=False):
                if r.closes is not None or r.safe is not None:  # ticks only move the clock
                    last = r if last is None or r.seen_at >= last.seen_at else last
        if last is None or key[0] is None:
            return
        old = self.state.get() if self.state.exists() else (None, False, False)
        seen = last.seen_at if last.seen_at.tzinfo else last.seen_at.tz_localize("UTC")
        at = max(seen.timestamp(), timerValues.getCurrentWatermarkInMs() / 1000)
        yield from self._told(key[0], last.closes if isinstance(last.closes, str) else None, bool(last.safe), old[2], at, at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.state.exists():
            closes, safe, shown = self.state.get()
            yield from self._told(key[0], closes, safe, shown, expiredTimerInfo.getExpiryTimeInMs() / 1000, timerValues.getCurrentWatermarkInMs() / 1000)

    def close(self) -> None:
        pass


def visibility_changes(feed: DataFrame, clock: DataFrame | None = None, late: str = "0 seconds", zone: str = "Europe/London") -> DataFrame:
    """(advert, at, visible): a stream of what appears and what goes, at the minute it does; nothing while the list stays as it is.

    `feed` is a stream of rows with `seen_at`, and `clock` one of timestamps `seen_at` that moves time where no rows come. An advert is its reference,
    else its link; its last row counts. Each advert has its own state and timer, so state and work are spread by advert and a
    quiet minute touches none of them. The session's state store must be one that keeps timers (RocksDB).
    """
    advert = F.coalesce(F.nullif(F.coalesce("job_reference", F.lit("")), F.lit("")), F.col("apply_url"))
    rows = feed.select(advert.alias("advert"), F.col("seen_at").cast("timestamp").alias("seen_at"), dates.closes("closing_date", "closing_time").alias("closes"), urls.is_safe("apply_url").alias("safe"))
    if clock is not None:
        rows = rows.unionByName(clock.select(F.col("seen_at").cast("timestamp").alias("seen_at")), allowMissingColumns=True)
    rows = rows.withWatermark("seen_at", late)
    return rows.groupBy("advert").transformWithStateInPandas(Expiry(zone), "advert string, at timestamp, visible boolean", "append", "eventtime")
