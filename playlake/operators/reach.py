"""Distinct visitors as exact bitmaps that merge over any set of days (A3-A5, A7, A8).

Every visitor has a number; the visitors of a media and day are bits. A month, a window
of days, a media's whole life or the whole catalogue is then the bitwise *or* of its
days' bitmaps, merged on the map side before anything is shuffled: no report
exchanges visitors again, and none holds a set of them.

Numbers are (part, number): visitors are dealt to parts by hash and numbered from 1
within theirs, so numbering is a sort per part and never one over all. A visitor
keeps the number once given; later ones go on after the highest of their part.
A bitmap covers 32,768 numbers of a part (4 KB; its zeros compress away in files and
in shuffles), so per group a report holds one per part and range that was seen.

The measures that add up (plays, watched sum and count, watch hours) are kept per media and
day beside the bits, so a report never goes back to the fact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions.columns import month_key
from playlake.operators.joins import lookup
from playlake.operators.reports import RECENT_COLUMNS

#: Visitors numbered in one part, about: what one task sorts.
PART_VISITORS = 1 << 20

NUMBER_SCHEMA = "visitor_id string, part int, number bigint"
DAY_SCHEMA = "media_id string, plays bigint, watched_sum double, watched_rows bigint, total_watch_time double, date date"
BITS_SCHEMA = "media_id string, part int, bucket bigint, bits binary, date date"


def new_visitors(fact: DataFrame, known: DataFrame) -> DataFrame:
    """Visitors of ``fact`` that have no number yet, once each."""
    return fact.select("visitor_id").where("visitor_id IS NOT NULL").distinct().join(known, "visitor_id", "left_anti")


def number_visitors(new: DataFrame, known: DataFrame, parts: int) -> DataFrame:
    """Numbers for new visitors, after those that are known in their parts (one row per part is joined)."""
    tops = known.groupBy("part").agg(F.max("number").alias("top"))
    dealt = new.select("visitor_id", F.pmod(F.xxhash64("visitor_id"), F.lit(parts)).cast("int").alias("part"))
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("part").orderBy("visitor_id")))
    number = F.coalesce("top", F.lit(0)) + F.col("rank")
    return ranked.join(tops, "part", "left").select("visitor_id", "part", number.cast("long").alias("number"))


def media_days(fact: DataFrame) -> DataFrame:
    """Per media and day (null ones too): the measures that add up."""
    return fact.groupBy("media_id", "date").agg(
        F.sum("play_count").cast("long").alias("plays"),
        F.sum("watched_percent").alias("watched_sum"),
        F.count("watched_percent").alias("watched_rows"),
        F.max("total_watch_time").alias("total_watch_time"),
    )


def media_day_bits(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """Per media, day and range of numbers: the visitors as bits. A null visitor is no visitor."""
    seen = fact.where("visitor_id IS NOT NULL").select("media_id", "date", "visitor_id").join(numbers, "visitor_id")
    return seen.groupBy("media_id", "date", "part", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits")
    )


def _engagement(days: DataFrame, bits: DataFrame, keys: list[str]) -> DataFrame:
    """Measures and distinct visitors by ``keys``: bitmaps merged per range, counted, added up with the days."""
    merged = bits.groupBy(*keys, "part", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.select(*keys, F.bitmap_count("bits").alias("visitors"))
    watch = F.when(F.col("media_id").isNotNull() & F.col("date").isNotNull(), F.col("total_watch_time"))
    measures = days.select(*keys, "plays", "watched_sum", "watched_rows", watch.alias("watch"))
    rows = measures.unionByName(counted, allowMissingColumns=True)
    return rows.groupBy(*keys).agg(
        F.coalesce(F.sum("plays"), F.lit(0)).cast("long").alias("plays"),
        F.coalesce(F.sum("visitors"), F.lit(0)).cast("long").alias("unique_visitors"),
        F.count("plays").alias("active_days"),
        F.try_divide(F.sum("watched_sum"), F.sum("watched_rows")).alias("avg_watched_percent"),
        F.coalesce(F.sum("watch"), F.lit(0.0)).alias("watch_hours"),
    )


def _labelled(df: DataFrame, dim_media: DataFrame) -> DataFrame:
    return lookup(df, dim_media.select("media_id", "title", "channel"), ["media_id"])


def kpi_summary(days: DataFrame, bits: DataFrame) -> DataFrame:
    """``reports.kpi_summary`` from days and bitmaps."""
    return _engagement(days, bits, []).select(
        F.col("plays").alias("total_plays"), "unique_visitors", "avg_watched_percent", F.col("watch_hours").alias("total_watch_hours")
    )


def engagement_by_media(days: DataFrame, bits: DataFrame, dim_media: DataFrame) -> DataFrame:
    """``reports.engagement_by_media`` from days and bitmaps."""
    known = "media_id IS NOT NULL"
    per_media = _engagement(days.where(known), bits.where(known), ["media_id"])
    return _labelled(per_media.drop("active_days", "watch_hours"), dim_media)


def monthly_engagement(days: DataFrame, bits: DataFrame, dim_media: DataFrame) -> DataFrame:
    """``reports.monthly_engagement`` from days and bitmaps."""
    known = "media_id IS NOT NULL AND date IS NOT NULL"
    by_month = [df.where(known).withColumn("month", month_key("date")) for df in (days, bits)]
    return _labelled(_engagement(*by_month, ["media_id", "month"]).drop("active_days", "watch_hours"), dim_media)


def recent_engagement(days: DataFrame, bits: DataFrame, dim_media: DataFrame, n: int) -> DataFrame:
    """``reports.recent_engagement`` over the last ``n`` days: those days' folders alone are read."""
    if n < 1:
        raise ValueError("n must be at least 1")
    newest = days.select(F.max("date")).scalar()
    window = F.col("media_id").isNotNull() & (F.col("date") >= F.date_sub(newest, n - 1))
    per_media = _engagement(days.where(window), bits.where(window), ["media_id"])
    return _labelled(per_media, dim_media).select(*RECENT_COLUMNS)
