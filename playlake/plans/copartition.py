"""Silver kept co-partitioned for the fact: the join and the grouping exchange nothing (J2, A2, T7).

What the fact reads of Silver is stored twice over, bucketed alike: the events'
columns and the daily measures, both by (media, day, salt). The fact's grouping by
visitor and its join with the daily measures then run bucket by bucket, straight from
the scans; each further fact (another build, a backfill of a measure, an ad-hoc
join on media and day) saves the shuffle of all events that the plain layer pays.

The salt is a hash of the visitor, so a visitor's events of a media and day stay
together, while a media that holds a third of all events, be it on one day, is dealt
to ``salts`` buckets instead of one. The daily rows, one per media and day, are
repeated once per salt. One visitor's events of one media and day are one group: they
are read by one task, which holds a single running sum for them.

Stored sets are published (``sources.published``): readers take the newest commit,
whose notes carry the bucketing.
"""

from __future__ import annotations

import json
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlake.functions.columns import utc_day
from playlake.operators.gold import FACT_COLUMNS, day_measures
from playlake.plans.concurrent import run_all
from playlake.session import use_utc
from playlake.sources import published, schemas
from playlake.sources.bucketed import read_bucketed, write_bucketed
from playlake.sources.layers import layer_reader
from playlake.sources.paths import layer_path

PLAYED, DAILY = "played", "daily"
KEYS = ("media_id", "date", "salt")
#: Buckets that one media and day may be dealt to.
SALTS = 16
#: Event rows of a bucket that the number of buckets aims at (some 256 MB of the stored columns).
BUCKET_ROWS = 8_000_000


def _salt(visitor: str, salts: int) -> Column:
    return F.pmod(F.xxhash64(visitor), F.lit(salts)).cast("int")


def played_rows(events: DataFrame, salts: int = SALTS) -> DataFrame:
    """What the fact needs of Silver events, with the key that they are stored by."""
    return events.select(
        "media_id",
        utc_day("received_at").alias("date"),
        _salt("visitor_key", salts).alias("salt"),
        F.col("visitor_key").alias("visitor_id"),
        F.col("percent_viewed").alias("watched"),
    )


def daily_rows(by_date: DataFrame, salts: int = SALTS) -> DataFrame:
    """The daily measures, once per salt. A null media or day never meets an event, so such rows stay out."""
    measures = day_measures(by_date).where("media_id IS NOT NULL AND date IS NOT NULL")
    each = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    return measures.select("media_id", "date", each, "play_rate", "total_watch_time")


def store(
    spark: SparkSession, silver_root: str, root: str, buckets: int | None = None, salts: int = SALTS
) -> published.Snapshot:
    """Store the newest Silver snapshot co-partitioned, as a new snapshot of ``root``.

    ``buckets`` defaults to one per ``BUCKET_ROWS`` events, at least one per shuffle partition of
    the session: a bucket is what one task reads.
    """
    if salts < 1:
        raise ValueError("salts must be at least 1")
    use_utc(spark)
    silver = layer_reader(spark, silver_root)
    events, by_date = silver(schemas.EVENTS), silver(schemas.BY_DATE)
    if buckets is None:
        rows = events.count()  # from the file footers
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
    frames = {PLAYED: played_rows(events, salts), DAILY: daily_rows(by_date, salts)}
    attempt = published.Attempt(spark, root, published.stamp())
    run_all(
        {
            name: partial(write_bucketed, df, layer_path(attempt.path, attempt.folder(name)), KEYS, buckets)
            for name, df in frames.items()
        }
    )
    notes = {"buckets": str(buckets)} | {f"schema of {name}": df.schema.json() for name, df in frames.items()}
    return attempt.commit([p for name in frames for p in attempt.written(name)], {}, notes=notes)


def stored(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Both tables of the newest snapshot, bucketed as they were written."""
    snapshot = published.newest(spark, root)
    if snapshot is None:
        raise ValueError(f"nothing is stored in {root}")
    found = {}
    for name in (PLAYED, DAILY):
        (part,) = snapshot.parts_of(name)
        path = layer_path(layer_path(root, published.DATA), part.path)
        schema = StructType.fromJson(json.loads(snapshot.notes[f"schema of {name}"]))
        found[name] = read_bucketed(spark, path, schema, KEYS, int(snapshot.notes["buckets"]))
    return found


def fact_from_stored(spark: SparkSession, root: str) -> DataFrame:
    """``gold.to_fact_media_engagement`` from the stored tables.

    The daily side is merged, not broadcast: it is in place already, and a merge spills
    where a hash table would not fit.
    """
    tables = stored(spark, root)
    per_visitor_day = tables[PLAYED].groupBy(*KEYS, "visitor_id").agg(
        F.count("*").alias("play_count"), F.avg("watched").alias("watched_percent")
    )
    return per_visitor_day.join(tables[DAILY].hint("merge"), list(KEYS), "left").select(*FACT_COLUMNS)
