"""Raw API records derived from the driver's ``events`` table.

The driver ships a generic event log (event_id, ts, user_id, event_type,
value, props) and no media, visitor or daily tables. This module derives the
three raw endpoints of the engagement API from it, in Bronze shape (record
fields + lineage), with two ingest runs so that latest-wins, filter-before-
dedupe, null keys and unparseable values are all exercised. Every output row
comes from the events table, so the work grows with it.

The same expressions exist as SQL in ``plans.oracle`` for the DuckDB check.

Helpers: ``k = int(props.k) % 40``, ``dom`` = day of month of ``ts``.
Run 1 carries every row, run 2 re-delivers a subset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.sources import schemas

# Fixed values of the mapping: the two ingest runs (f = 1, 2) and their stamps.
RUN_STAMPS = {1: "2024-02-01T06:00:00+00:00", 2: "2024-02-02T06:00:00.500000+00:00"}
MEDIA_COUNT = 40
COUNTRIES = ("US", "DE", "GB")
URL_PREFIX = "https://example.com/m"
CREATED = "2024-01-01T00:00:00+00:00"


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int") % MEDIA_COUNT


def _s(c: Column) -> Column:
    return c.cast("string")


def _with_runs(df: DataFrame, rerun: Column) -> DataFrame:
    """One row per run: run 1 always, run 2 where ``rerun`` holds (a generator, no join)."""
    runs = F.when(rerun, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    out = df.withColumn("f", F.explode(runs))
    stamp = F.when(F.col("f") == 1, F.lit(RUN_STAMPS[1])).otherwise(F.lit(RUN_STAMPS[2]))
    return out.withColumn("ingest_timestamp", stamp).withColumn(
        "ingest_date", F.substring(stamp, 1, 10)
    )


def raw_events(events: DataFrame) -> DataFrame:
    """Bronze-shaped raw play/conversion events (one row per event and run)."""
    eid = F.col("event_id")
    base = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        _k().alias("k"), F.dayofmonth("ts").alias("dom"),
    )
    f = F.col("f")
    k = F.col("k")
    conversion = (
        F.when(
            (F.col("event_type") == "signup")
            | ((k + F.col("dom")) % 5 == 0)
            | ((f == 2) & (eid % 21 == 0)),
            F.lit("form-submit"),
        )
        .when(F.col("event_type") == "purchase", F.lit("purchase"))
        .when(F.col("event_type") == "click", F.lit(None).cast("string"))
        .otherwise(F.lit(""))
    )
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return _with_runs(base, eid % 7 == 0).select(
        F.when(eid % 101 == 0, F.lit("bad")).otherwise(iso).alias("received_at"),
        F.when(eid % 97 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("e"), _s(eid))).alias("event_key"),
        F.concat_ws(
            ".", F.lit("10"), _s(f), _s(F.col("user_id") % 256), _s(eid % 256)
        ).alias("ip"),
        F.element_at(F.array(*[F.lit(c) for c in COUNTRIES]), (eid % 3 + 1).cast("int"))
        .alias("country"),
        F.when(eid % 11 == 0, F.lit(None).cast("double"))
        .otherwise(F.sqrt("value") / 25 / f).alias("percent_viewed"),
        conversion.alias("conversion_type"),
        F.when(eid % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("v"), _s(F.col("user_id")))).alias("visitor_key"),
        F.concat(F.lit("Media "), _s(k)).alias("media_name"),
        F.when((k % 10 == 9) | (eid % 13 == 0), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(URL_PREFIX), _s(k))).alias("media_url"),
        "ingest_timestamp",
        "ingest_date",
        F.concat(F.lit("m"), _s(k)).alias("media_id"),
    )


def raw_by_date(events: DataFrame) -> DataFrame:
    """Bronze-shaped daily totals: one row per (media, day) seen in events, per run."""
    daily = (
        events.select(_k().alias("k"), F.to_date("ts").alias("day"), "event_type", "value")
        .groupBy("k", "day")
        .agg(
            F.count(F.lit(1)).alias("c"),
            F.count_if(F.col("event_type") == "view").alias("pc"),
            (F.sum("value") / 3600).alias("h"),
        )
        .withColumn("dom", F.dayofmonth("day"))
    )
    f = F.col("f")
    kd = F.col("k") + F.col("dom")
    load = (
        F.when(kd % 17 == 0, F.lit(None).cast("long"))
        .when((kd % 7 == 0) | ((f == 2) & (F.col("dom") % 6 == 0)), F.lit(0).cast("long"))
        .otherwise(F.col("c") * f)
    )
    return _with_runs(daily, F.col("dom") % 3 == 0).select(
        F.when(kd % 23 == 0, F.lit("bad")).otherwise(F.date_format("day", "yyyy-MM-dd"))
        .alias("date"),
        load.cast("long").alias("load_count"),
        F.col("pc").cast("long").alias("play_count"),
        F.col("h").alias("hours_watched"),
        "ingest_timestamp",
        "ingest_date",
        F.concat(F.lit("m"), _s(F.col("k"))).alias("media_id"),
    )


def raw_media_metadata(events: DataFrame) -> DataFrame:
    """Bronze-shaped media metadata: one record per media seen in events (but k = 39)."""
    media = events.select(_k().alias("k")).where(F.col("k") != MEDIA_COUNT - 1).distinct()
    k = F.col("k")
    version = F.concat(F.lit(" v"), _s(F.col("f")))
    name = (
        F.when(k % 4 == 0, F.concat(F.lit("YouTube ad "), _s(k), version))
        .when(k % 4 == 1, F.concat(F.lit("FACEBOOK "), _s(k), version))
        .when(k % 4 == 2, F.concat(F.lit("facebook and youtube "), _s(k), version))
        .when(k % 8 == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Plain "), _s(k)))
    )
    return _with_runs(media, k % 5 == 0).select(
        F.when(k == MEDIA_COUNT - 2, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("m"), _s(k))).alias("hashed_id"),
        name.alias("name"),
        F.lit(CREATED).alias("created"),
        "ingest_timestamp",
        "ingest_date",
        F.concat(F.lit("m"), _s(k)).alias("media_id"),
    )


_BUILDERS = {
    schemas.EVENTS: raw_events,
    schemas.BY_DATE: raw_by_date,
    schemas.MEDIA_METADATA: raw_media_metadata,
}


def raw_records(events: DataFrame, endpoint: str) -> DataFrame:
    """Whole API records with lineage, as the landing zone gets them.

    Events have fields that no schema declares, one of them nested; the daily
    rows of some days have a word where a number belongs (a variant column: the
    values of one field are of several types).
    """
    raw = _BUILDERS[endpoint](events)
    if endpoint == schemas.EVENTS:
        number = F.substring("media_id", 2, 10).cast("int")
        details = F.struct(
            F.element_at(F.array(F.lit("Chrome"), F.lit("Firefox")), (number % 2 + 1).cast("int")).alias("browser"),
            F.struct((number % 3 == 0).alias("mobile"), number.alias("build")).alias("platform"),
        )
        return raw.withColumn("city", F.concat(F.lit("City "), _s(number % 7))).withColumn("user_agent_details", details)
    if endpoint == schemas.BY_DATE:
        text = F.when(is_mistyped("date", "media_id"), F.lit('"lots"')).otherwise(_s(F.col("load_count")))
        return raw.withColumn("load_count", F.parse_json(F.coalesce(text, F.lit("null"))))
    return raw


def is_mistyped(date: str, media_id: str) -> Column:
    """Days whose ``load_count`` lands as a word."""
    day = F.dayofmonth(F.try_to_date(F.col(date)))
    return F.coalesce((F.substring(F.col(media_id), 2, 10).cast("int") + day) % 19 == 0, F.lit(False))


def raw_bronze(events: DataFrame, endpoint: str) -> DataFrame:
    """Bronze-shaped rows of ``endpoint`` derived from the events table."""
    return _BUILDERS[endpoint](events).select(*schemas.bronze_columns(endpoint))


def read_events(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
