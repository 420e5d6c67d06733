"""Report DataFrames over the Gold tables (KPI, by media, trends, monthly,
recent window, top visitors).

Semantics kept from the dashboard this replaces:

* reports keyed by date or media drop rows whose key is null; the KPI's plays
  and visitors count every fact row;
* ``play_rate`` and ``total_watch_time`` repeat on every visitor row of a
  media-day, so they are taken once per (media, day) before any sum;
* means of ``watched_percent`` are unweighted over fact rows;
* the trend grid spans the global first..last day for every media, with
  missing days filled as 0 plays and null rate / watch time;
* the recent window is anchored on the newest day in the data, inclusive.

Scale notes: every aggregate is partial-then-final; global bounds (first/last
day, newest day) are scalar subqueries — one small job each, inlined as a
value — instead of joins; the top-n list is cut with ``TakeOrderedAndProject``
before it meets ``dim_visitor``, which is then streamed, not shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.functions.columns import as_percent, month_key
from playlake.operators.joins import bounded_broadcast, lookup

# Columns of the recent-window report, in order.
RECENT_COLUMNS = (
    "media_id", "title", "channel", "plays",
    "unique_visitors", "active_days", "avg_watched_percent",
)


def _keyed(fact: DataFrame, *keys: str) -> DataFrame:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return fact.where(cond)


def _media_labels(dim_media: DataFrame, *cols: str) -> DataFrame:
    return dim_media.select("media_id", *cols)


def _engagement_measures() -> list[Column]:
    return [
        F.sum("play_count").alias("plays"),
        F.countDistinct("visitor_id").alias("unique_visitors"),
        F.avg("watched_percent").alias("avg_watched_percent"),
    ]


def kpi_summary(fact: DataFrame) -> DataFrame:
    """One row: total plays, unique visitors, mean watched fraction, watch hours.

    Watch hours are summed over one value per (media, day). Both levels run in
    one aggregation: fact rows and de-duplicated media-days are unioned, each
    filling only its own measure columns.
    """
    per_row = fact.select(
        F.col("play_count").cast("long").alias("play_count"),
        "visitor_id",
        F.col("watched_percent").cast("double").alias("watched_percent"),
        F.lit(None).cast("double").alias("_watch"),
    )
    per_media_day = (
        _keyed(fact, "media_id", "date")
        .groupBy("media_id", "date")
        .agg(F.max("total_watch_time").cast("double").alias("_watch"))
        .select(
            F.lit(None).cast("long").alias("play_count"),
            F.lit(None).cast("string").alias("visitor_id"),
            F.lit(None).cast("double").alias("watched_percent"),
            "_watch",
        )
    )
    return per_row.unionByName(per_media_day).agg(
        F.coalesce(F.sum("play_count"), F.lit(0).cast("long")).alias("total_plays"),
        F.countDistinct("visitor_id").alias("unique_visitors"),
        F.avg("watched_percent").alias("avg_watched_percent"),
        F.coalesce(F.sum("_watch"), F.lit(0.0)).alias("total_watch_hours"),
    )


def engagement_by_media(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """Per media: plays, distinct visitors, mean watched fraction, title, channel."""
    per_media = _keyed(fact, "media_id").groupBy("media_id").agg(*_engagement_measures())
    return lookup(per_media, _media_labels(dim_media, "title", "channel"), ["media_id"])


def media_day_totals(fact: DataFrame) -> DataFrame:
    """Per (media, day): plays summed; rate and watch hours taken once."""
    return (
        _keyed(fact, "media_id", "date")
        .groupBy("media_id", "date")
        .agg(
            F.sum("play_count").alias("plays"),
            F.max("play_rate").alias("play_rate"),
            F.max("total_watch_time").alias("total_watch_time"),
        )
    )


def daily_trends(fact: DataFrame, dim_media: DataFrame | None = None) -> DataFrame:
    """Gap-filled daily series per media, ordered by (media, day).

    The media-day totals (the only read of the fact's measures) are gathered as
    one day -> totals map per media, which has as many entries as there are days;
    the day range is one scalar subquery over the fact's day column. Each media
    row then expands over the range and looks its days up: no grid is joined.
    With ``dim_media`` the media's channel is added.
    """
    range_ = _keyed(fact, "media_id", "date").select(
        F.sequence(F.min("date").cast("date"), F.max("date").cast("date")).alias("days")
    ).scalar()
    entry = F.struct("date", F.struct("plays", "play_rate", "total_watch_time"))
    per_media = media_day_totals(fact).groupBy("media_id").agg(F.map_from_entries(F.collect_list(entry)).alias("known"))
    days = per_media.select("media_id", "known", F.explode(range_).alias("date"))
    found = F.try_element_at(F.col("known"), F.col("date"))
    trends = days.select(
        "media_id",
        "date",
        F.coalesce(found["plays"], F.lit(0)).cast("long").alias("plays"),
        found["play_rate"].alias("play_rate"),
        found["total_watch_time"].alias("total_watch_time"),
    )
    if dim_media is not None:
        trends = lookup(trends, _media_labels(dim_media, "channel"), ["media_id"])
    return trends.orderBy("media_id", "date")


def monthly_engagement(fact: DataFrame, dim_media: DataFrame) -> DataFrame:
    """Per (media, ``YYYY-MM``): plays, distinct visitors, mean watched fraction."""
    per_month = (
        _keyed(fact, "media_id", "date")
        .withColumn("month", month_key("date"))
        .groupBy("media_id", "month")
        .agg(*_engagement_measures())
    )
    return lookup(per_month, _media_labels(dim_media, "title", "channel"), ["media_id"])


def recent_engagement(fact: DataFrame, dim_media: DataFrame, days: int) -> DataFrame:
    """Per media over the last ``days`` days of data (anchored on the newest day)."""
    if days < 1:
        raise ValueError("days must be at least 1")
    newest = fact.select(F.max("date")).scalar()
    recent = _keyed(fact, "media_id", "date").where(
        F.col("date") >= F.date_sub(newest, days - 1)
    )
    per_media = recent.groupBy("media_id").agg(
        F.sum("play_count").alias("plays"),
        F.countDistinct("visitor_id").alias("unique_visitors"),
        F.countDistinct("date").alias("active_days"),
        F.avg("watched_percent").alias("avg_watched_percent"),
    )
    joined = lookup(per_media, _media_labels(dim_media, "title", "channel"), ["media_id"])
    return joined.select(*RECENT_COLUMNS)


def top_visitors(fact: DataFrame, dim_visitor: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` visitors by plays (ties: smaller visitor id first), with country.

    The ranking is cut to ``n`` rows and gathered into one array by a scalar
    subquery, so the fact is aggregated once for both uses of it: the array's ids
    filter ``dim_visitor`` as it is scanned, and its rows are the result that the
    at most ``n`` rows left of the dimension (unique per visitor) are joined to.
    Nothing is cached: every call reads Gold as it is.
    """
    if n < 0:
        raise ValueError("n must be non-negative")
    ranked = (
        _keyed(fact, "visitor_id")
        .groupBy("visitor_id")
        .agg(
            F.sum("play_count").alias("plays"),
            F.avg("watched_percent").alias("avg_watched_percent"),
        )
        .orderBy(F.col("plays").desc(), F.col("visitor_id").asc())
        .limit(n)
    )
    top = ranked.agg(F.collect_list(F.struct("visitor_id", "plays", "avg_watched_percent")).alias("top")).scalar()
    listed = fact.sparkSession.range(1).select(top.alias("top"))
    countries = dim_visitor.select("visitor_id", "country").where(
        F.array_contains(top.getField("visitor_id"), F.col("visitor_id"))
    )
    joined = listed.select(F.inline("top")).join(bounded_broadcast(countries, n), on="visitor_id", how="left")
    return joined.select("visitor_id", "plays", "avg_watched_percent", "country").orderBy(
        F.col("plays").desc(), F.col("visitor_id").asc()
    )


def in_percent(df: DataFrame, *cols: str) -> DataFrame:
    """Display form: fractions scaled to percent (default: ``avg_watched_percent``)."""
    for c in cols or ("avg_watched_percent",):
        df = df.withColumn(c, as_percent(c))
    return df
