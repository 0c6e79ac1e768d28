"""The browse query: what is visible, what matches, in which order, and how it is shown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gazetta.functions import dates, text, urls

#: Fields that a keyword is looked for in, and dimensions that can be chosen.
KEYWORD_FIELDS = ("job_title", "organization", "job_area", "location", "location_area", "job_summary")
FACETS = ("job_area", "organization", "location_area", "work_pattern")


def loaded(feed: DataFrame) -> DataFrame:
    """Rows with a link, a title or an organization."""
    return feed.where((text.filled("apply_url") != "") | (text.filled("job_title") != "") | (text.filled("organization") != ""))


def link_counts(feed: DataFrame) -> DataFrame:
    """(url, n): how many loaded rows share each nonblank link, expired rows included."""
    url = text.trimmed("apply_url")
    return feed.where(url != "").groupBy(url.alias("url")).agg(F.count("*").alias("n"))


def with_link_counts(feed: DataFrame) -> DataFrame:
    """`link_count` for every row by a join on the counted links: counts combine before the shuffle, so a link of a third of all rows is no hot task."""
    counted = link_counts(feed).select(F.col("url").alias("_url"), F.col("n").alias("_n"))
    return feed.withColumn("_url", text.trimmed("apply_url")).join(counted, "_url", "left").withColumn("link_count", F.coalesce("_n", F.lit(0))).drop("_url", "_n")


def visible(feed: DataFrame, asof: str) -> DataFrame:
    today, now = dates.wall_clock(asof)
    return feed.where(~dates.expired("closing_date", "closing_time", today, now) & urls.is_safe("apply_url"))


def keyword_match(keyword: str, fields: tuple[str, ...] = KEYWORD_FIELDS) -> Column:
    wanted = F.lower(text.trimmed(F.lit(keyword)))
    any_field = F.lit(False)
    for f in fields:
        any_field |= F.contains(F.lower(text.filled(f)), wanted)
    return (wanted == "") | any_field


def matching(feed: DataFrame, keyword: str = "", **facets: str) -> DataFrame:
    """Rows that hold the keyword and equal every chosen facet; an empty choice is any value."""
    out = feed.where(keyword_match(keyword, tuple(f for f in KEYWORD_FIELDS if f in feed.columns)))
    for name, value in facets.items():
        if name not in FACETS:
            raise ValueError(f"unknown facet {name}")
        out = out.where(F.col(name) == value) if value else out
    return out


def facet_options(feed: DataFrame, field: str) -> DataFrame:
    """Distinct nonempty values, to be listed without regard to case or accents."""
    return feed.where(text.filled(field) != "").select(field).distinct().orderBy(text.order_text(F.col(field)), field)


def all_facets(feed: DataFrame) -> DataFrame:
    """(facet, value) of all dimensions in one pass."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("facet"), text.filled(f).alias("value")) for f in FACETS)))
    return feed.select(each.alias("x")).where("x.value <> ''").select("x.facet", "x.value").distinct()


NEVER = "~"  # behind every closing minute


def visible_index(feed: DataFrame, facets: tuple[str, ...] = FACETS) -> DataFrame:
    """(facet, value, closes, visible): how many rows of each facet value are visible until a closing minute, from the one before on.

    The row with facet and value '' is for all rows. Its size is that of the distinct closing minutes of each value, whatever the feed's;
    rows are counted before the shuffle, and running sums go over the counts. Counts and facets at any moment come from it without the feed.
    """
    rows = feed.where(urls.is_safe("apply_url")).select(F.coalesce(dates.closes("closing_date", "closing_time"), F.lit(NEVER)).alias("closes"), *(text.filled(f).alias(f) for f in facets))
    each = F.explode(F.array(F.struct(F.lit("").alias("facet"), F.lit("").alias("value")), *(F.struct(F.lit(f).alias("facet"), F.col(f).alias("value")) for f in facets)))
    counts = rows.select("closes", each.alias("x")).where("x.facet = '' or x.value <> ''").groupBy("x.facet", "x.value", "closes").agg(F.count("*").alias("n"))
    later = Window.partitionBy("facet", "value").orderBy(F.col("closes").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select("facet", "value", "closes", F.sum("n").over(later).alias("visible"))


def visible_at(index: DataFrame, *moments: str) -> DataFrame:
    """(moment, facet, value, visible) at UTC moments, from `visible_index`; values of which nothing is visible are left out."""
    each = []
    for asof in moments:
        today, now = dates.wall_clock(asof)
        minute = F.concat(today, F.lit("T"), F.lpad(F.floor(now / 60).cast("string"), 2, "0"), F.lit(":"), F.lpad((now % 60).cast("string"), 2, "0"))
        each.append(F.struct(F.lit(asof).alias("moment"), minute.alias("minute")))
    asked = index.withColumn("x", F.explode(F.array(*each))).where(F.col("closes") > F.col("x.minute"))
    return asked.groupBy("x.moment", "facet", "value").agg(F.max("visible").alias("visible"))


def order_keys(mode: str) -> list[tuple[Column, bool]]:
    """Sort keys of a mode, as (column, descending); the record number keeps ties in feed order."""
    title, organization = (text.order_text(text.filled(c)) for c in ("job_title", "organization"))
    undated = (~dates.is_date("closing_date")).cast("int")
    time = F.when((text.filled("closing_time") != "") & dates.is_time("closing_time"), F.col("closing_time")).otherwise("23:59")
    due = F.when(dates.is_date("closing_date"), F.concat_ws("T", "closing_date", time)).otherwise("")
    keys = {
        "closing-soonest": [(undated, False), (due, False), (title, False)],
        "closing-latest": [(undated, False), (due, True), (title, False)],
        "organisation-az": [(organization, False), (title, False)],
        "title-az": [(title, False), (organization, False)],
    }
    return [*keys[mode], (F.col("rec_no"), False)]


def ordered(feed: DataFrame, mode: str = "closing-soonest") -> DataFrame:
    return feed.orderBy(*(k.desc() if down else k.asc() for k, down in order_keys(mode)))


def presented(feed: DataFrame, asof: str, *also: str) -> DataFrame:
    """Display columns of counted rows: fallbacks, link label, urgency and closing text; `also` are kept as they are."""
    today, _ = dates.wall_clock(asof)
    shared = (text.trimmed("apply_url") != "") & (F.col("link_count") > 1)
    title, reference = text.shown(text.trimmed("job_title"), otherwise="Untitled vacancy"), text.trimmed("job_reference")
    spoken = F.concat(F.lit("Open vacancies page: "), title, F.when(reference != "", F.concat(F.lit(". Reference "), reference)).otherwise(""))
    return feed.select(
        "rec_no",
        text.shown("job_title", otherwise="Untitled vacancy").alias("title"),
        text.shown("organization", otherwise="Organisation not stated").alias("organization"),
        text.shown("job_area", otherwise="Job area not stated").alias("job_area"),
        text.shown("work_pattern", otherwise="Work pattern not stated").alias("work_pattern"),
        text.shown("location", "location_area", otherwise="Location not stated").alias("location"),
        text.shown("salary", otherwise="Salary not stated").alias("salary"),
        dates.closing_text("closing_date", "closing_time").alias("closing"),
        dates.urgency("closing_date", today).alias("urgency"),
        shared.alias("is_shared"),
        F.when(shared, "Open vacancies page").otherwise("View & Apply").alias("label"),
        F.when(shared, spoken).otherwise(F.concat(F.lit("View & Apply: "), title)).alias("aria_label"),
        F.when(shared, reference).otherwise("").alias("reference"),
        *also,
    )


def browse(feed: DataFrame, asof: str, keyword: str = "", mode: str = "closing-soonest", **facets: str) -> DataFrame:
    """Load, count links over all rows, keep what is visible and matches, order and present."""
    found = matching(visible(with_link_counts(loaded(feed)), asof), keyword, **facets)
    return presented(ordered(found, mode), asof)


def first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in an order."""
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_k = 1").drop("_k")
