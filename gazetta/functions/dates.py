"""Closing dates and times, which stay text; the moment of asking is always a parameter."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, filled


def as_date(c: Column | str) -> Column:
    """The date of a strict `YYYY-MM-DD`, else null. Years under 100 are not dates of a feed."""
    x = filled(c)
    d = F.try_to_date(x, "yyyy-MM-dd")
    return F.when(x.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z") & (F.substring(x, 1, 4) >= "0100"), d)


def is_date(c: Column | str) -> Column:
    return as_date(c).isNotNull()


def is_time(c: Column | str) -> Column:
    """Empty, or a strict `HH:MM`."""
    return filled(c).rlike(r"\A(([01][0-9]|2[0-3]):[0-5][0-9])?\z")


def minutes(c: Column | str) -> Column:
    x = filled(c)
    return F.when(x.rlike(r"\A[0-9]{2}:[0-9]{2}\z"), F.substring(x, 1, 2).cast("int") * 60 + F.substring(x, 4, 2).cast("int"))


def wall_clock(asof: str, zone: str = "Europe/London") -> tuple[Column, Column]:
    """(date as text, minutes of the day) in a zone at a UTC moment; both fold to constants."""
    at = F.from_utc_timestamp(F.lit(asof).cast("timestamp_ntz").cast("timestamp"), zone)
    return F.date_format(at, "yyyy-MM-dd"), F.hour(at) * 60 + F.minute(at)


def expired(date: Column | str, time: Column | str, today: Column, now: Column) -> Column:
    """Past its day, or its minute reached. Without a valid date and time a row never expires."""
    d = filled(date)
    due = (d < today) | ((d == today) & (filled(time) != "") & (now >= minutes(time)))
    return F.coalesce(is_date(date) & is_time(time) & due, F.lit(False))


def closes(date: Column | str, time: Column | str) -> Column:
    """The wall-clock minute `YYYY-MM-DDTHH:MM` from which a row is past: its own, or the next day's first. Null if it never is."""
    d, t = filled(date), filled(time)
    own = F.when(t != "", F.concat_ws("T", d, t)).otherwise(F.concat(F.date_format(F.date_add(as_date(date), 1), "yyyy-MM-dd"), F.lit("T00:00")))
    return F.when(is_date(date) & is_time(time), own)


def closing_text(date: Column | str, time: Column | str | None = None) -> Column:
    day = F.date_format(as_date(date), "d MMM yyyy")
    if time is not None:
        day = F.when((filled(time) != "") & is_time(time), F.concat_ws(", ", day, filled(time))).otherwise(day)
    return F.when(is_date(date), day).otherwise("Closing date not stated")


def urgency(date: Column | str, today: Column) -> Column:
    days = F.datediff(as_date(date), as_date(today))
    return (
        F.when(days == 0, "Closes today").when(days == 1, "Closes tomorrow")
        .when(days.between(2, 7), F.concat(F.lit("Closes in "), days.cast("string"), F.lit(" days"))).otherwise("")
    )


def newest(c: Column | str) -> Column:
    """Aggregate: the newest valid date as text, or empty."""
    return F.coalesce(F.max(F.when(is_date(c), col(c))), F.lit(""))
