"""Silver and Gold advanced by what is new, instead of recomputed from all of Bronze.

Silver (``advance_silver``): an upsert by key. A table is kept in key buckets
(``pmod(xxhash64(key), buckets)``), events also by day within a bucket. Each row
keeps its ``ingest_timestamp``, so new rows are weighed against stored ones under the
order that the full computation uses. It is a total order and filters come before
it, so the latest of (stored, new) is the latest of all rows ever seen: an older
play still survives a newer conversion of its key. Only the buckets that new keys
hash to are read and written; all others are taken over from the last snapshot.
Beside the tables the upsert publishes the *changes*: the Silver rows that came and
went (rows delivered again without a difference cancel out).

Gold (``advance_gold``): what the changes touch.

* fact: the days of changed events and totals are recomputed from those days of
  Silver (partition filters) and replace those days' directories alone;
* ``dim_visitor``: per visitor bucket, stored winners are merged with the rows that
  came. A visitor whose winning row went is recomputed from Silver;
* ``dim_media``: likewise, by the url last seen; media that the metadata names for the
  first time are looked up in Silver, as their url may be older than the run.

Both are published as snapshots (``sources.published``): a failed run changes
nothing, a repeated one gives the same tables. Gold notes the Silver snapshot it
reflects; where that is not the one before Silver's newest, it is built in full.

The driver holds bucket numbers and days (``column IN (...)`` and folder names), never
keys or rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType, TimestampType

from playlake.functions.columns import utc_day
from playlake.operators import gold as G
from playlake.operators.bronze import to_bronze
from playlake.operators.latest import ingest_rank, latest_per_key
from playlake.operators.silver import REFINEMENTS, Refinement, latest, screen
from playlake.plans.concurrent import run_all
from playlake.plans.incremental import landed_runs
from playlake.session import scratch_path, use_utc
from playlake.sources import published, schemas
from playlake.sources.landing import read_landing
from playlake.sources.layers import read_layer, remove, write_layer
from playlake.sources.published import Attempt, Part, Snapshot

#: Key buckets of a new table; a table keeps the number it was started with.
SILVER_BUCKETS, DIMENSION_BUCKETS = 16, 16
RECENCY = "ingest_timestamp"
#: Null partition values have this directory name.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
EVENTS, BY_DATE, METADATA = schemas.EVENTS, schemas.BY_DATE, schemas.MEDIA_METADATA
DIM_MEDIA, DIM_VISITOR, FACT = schemas.DIM_MEDIA, schemas.DIM_VISITOR, schemas.FACT_MEDIA_ENGAGEMENT


def changes_of(endpoint: str) -> str:
    return f"{endpoint}_changes"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


# --- Silver ---------------------------------------------------------------------


def stored_schema(endpoint: str) -> StructType:
    """A stored Silver table: its columns, the recency, and the partition columns."""
    extra = [StructField(RECENCY, StringType()), StructField("bucket", IntegerType())]
    day = [StructField("day", DateType())] if endpoint == EVENTS else []
    return StructType([*schemas.SILVER_SCHEMAS[endpoint].fields, *extra, *day])


def silver_table(spark: SparkSession, snapshot: Snapshot, endpoint: str, buckets: Sequence[int] | None = None) -> DataFrame:
    """A Silver table of ``snapshot`` with its partition columns, or only some of its buckets."""
    return snapshot.read(spark, endpoint, stored_schema(endpoint), None if buckets is None else map(str, buckets))


def _place(rows: DataFrame, endpoint: str, buckets: int) -> DataFrame:
    rows = rows.withColumn("bucket", bucket_of(REFINEMENTS[endpoint].key, buckets))
    return rows.withColumn("day", utc_day("received_at")) if endpoint == EVENTS else rows


def _write_placed(df: DataFrame, attempt: Attempt, table: str, by: Sequence[str]) -> list[Part]:
    """One directory per value of the first column of ``by``, few files in each."""
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(f"{attempt.path}/{attempt.folder(table)}")
    return attempt.written(table, by_part=True)


def _upsert(spark: SparkSession, bronze: DataFrame, endpoint: str, attempt: Attempt, buckets: int, stage: str) -> tuple[list[Part], int]:
    spec = REFINEMENTS[endpoint]
    stored_columns = stored_schema(endpoint).names
    fresh = latest(screen(bronze, spec), spec).select(*spec.output, RECENCY)
    write_layer(_place(fresh, endpoint, buckets), stage, endpoint)
    fresh = read_layer(spark, stage, endpoint).select(*stored_columns)
    touched = sorted(r["bucket"] for r in fresh.select("bucket").distinct().collect())
    base = attempt.base
    by = ("bucket", "day") if endpoint == EVENTS else ("bucket",)
    if base and base.parts_of(endpoint, map(str, touched)):
        stored = silver_table(spark, base, endpoint, touched).select(*stored_columns)
        merged = _place(latest(stored.unionByName(fresh), spec).select(*spec.output, RECENCY), endpoint, buckets)
        net = _net_changes(stored, fresh, spec)
    else:  # nothing to weigh the new rows against: one of each key, all of them come
        merged, net = fresh, fresh.select(*spec.output, F.lit(1).alias("n"))
    done = run_all(
        {
            "rows": partial(_write_placed, merged, attempt, endpoint, by) if touched else list,
            "changes": partial(write_layer, net, attempt.path, attempt.folder(changes_of(endpoint))),
        }
    )
    kept = [p for p in base.parts_of(endpoint) if p.part not in {str(b) for b in touched}] if base else []
    return [*kept, *done["rows"], *attempt.written(changes_of(endpoint))], done["changes"]


def _net_changes(stored: DataFrame, fresh: DataFrame, spec: Refinement) -> DataFrame:
    """What came (``n`` = 1) and what went (-1), by one join of the new rows with the stored rows of their
    keys, of which both have one each. A row that differs in its recency alone neither comes nor goes."""
    new, old = (df.select(F.struct(*spec.output, RECENCY).alias(side)) for df, side in ((fresh, "new"), (stored, "old")))

    def same(columns: Sequence[str]) -> Column:
        equal = [F.col(f"new.{c}").eqNullSafe(F.col(f"old.{c}")) for c in columns]
        return reduce(and_, equal)

    newer = ingest_rank("new", RECENCY, spec.tiebreak()) > ingest_rank("old", RECENCY, spec.tiebreak())
    pairs = new.join(old, same(spec.key), "left").where(F.col("old").isNull() | (newer & ~same(spec.output)))

    def change(side: str, n: int) -> Column:
        return F.struct(*(F.col(f"{side}.{c}").alias(c) for c in spec.output), F.lit(n).alias("n"))

    came, went = change("new", 1), change("old", -1)
    return pairs.select(F.inline(F.when(F.col("old").isNull(), F.array(came)).otherwise(F.array(came, went))))


def _empty(attempt: Attempt) -> Snapshot:
    return Snapshot(attempt.root, "", 0, "", None, None, ())


def advance_silver(
    spark: SparkSession, bronze: dict[str, DataFrame], silver_root: str, version: str, buckets: int = SILVER_BUCKETS
) -> Snapshot:
    """Upsert new Bronze rows (any endpoints) into Silver; the snapshot, which also has the changes.

    ``buckets`` counts for a new Silver only. Rows that were upserted before change nothing.
    """
    use_utc(spark)
    attempt = Attempt(spark, silver_root, version)
    if attempt.base:
        buckets = int(attempt.base.notes["buckets"])
    stage = scratch_path(spark, "upsert")
    done = run_all({e: partial(_upsert, spark, df, e, attempt, buckets, stage) for e, df in bronze.items()})
    parts = [p for found, _ in done.values() for p in found]
    if attempt.base:  # endpoints without new rows
        parts += [p for e in schemas.ENDPOINTS if e not in bronze for p in attempt.base.parts_of(e)]
    snapshot = attempt.commit(parts, {changes_of(e): n for e, (_, n) in done.items()}, notes={"buckets": str(buckets)})
    remove(spark, stage)
    return snapshot


def read_silver(spark: SparkSession, silver_root: str, endpoint: str) -> DataFrame:
    """The Silver table as ``to_silver`` gives it."""
    snapshot = published.newest(spark, silver_root)
    if snapshot is None:
        raise ValueError(f"nothing is published under {silver_root}")
    return silver_table(spark, snapshot, endpoint).select(*schemas.SILVER_SCHEMAS[endpoint].names)


# --- Gold -----------------------------------------------------------------------

# Dimensions keep what decides a later merge: when and by which event a visitor was
# last seen, and when the url of a media was.
VISITOR_STATE = StructType(
    [
        *schemas.GOLD_SCHEMAS[DIM_VISITOR].fields,
        StructField("seen_at", TimestampType()),
        StructField("seen_by", StringType()),
        StructField("bucket", IntegerType()),
    ]
)
MEDIA_STATE = StructType(
    [*schemas.GOLD_SCHEMAS[DIM_MEDIA].fields, StructField("url_seen", TimestampType()), StructField("bucket", IntegerType())]
)


def _visitor_state(events: DataFrame) -> DataFrame:
    """dim_visitor with the event that decided it."""
    return _latest_visitor(
        events.select(
            F.col("visitor_key").alias("visitor_id"), F.col("ip").alias("ip_address"), "country",
            F.col("received_at").alias("seen_at"), F.col("event_key").alias("seen_by"),
        )
    )


def _latest_visitor(rows: DataFrame) -> DataFrame:
    order = [F.col("seen_at").desc_nulls_last(), F.col("seen_by").desc_nulls_last()]
    return latest_per_key(rows, ["visitor_id"], order)


def _media_state(metadata: DataFrame, urls: DataFrame) -> DataFrame:
    named = G.to_dim_media(metadata, urls.withColumnsRenamed({"url": "media_url", "url_seen": "received_at"}))
    return named.join(urls.select("media_id", "url_seen"), "media_id", "left")


def _media_urls(events: DataFrame) -> DataFrame:
    """(media_id, url, url_seen): the url of the most recent event that has one."""
    seen = events.where(F.col("media_url").isNotNull()).groupBy("media_id", "media_url").agg(F.max("received_at").alias("t"))
    best = F.max(F.struct("t", "media_url")).alias("b")
    return seen.groupBy("media_id").agg(best).select("media_id", F.col("b.media_url").alias("url"), F.col("b.t").alias("url_seen"))


def _dim_parts(attempt: Attempt, table: str, new: Sequence[Part], touched: Sequence[int]) -> list[Part]:
    gone = {str(b) for b in touched}
    kept = [p for p in attempt.base.parts_of(table) if p.part not in gone] if attempt.base else []
    return [*kept, *new]


def _values(df: DataFrame, column: str) -> list:
    return [r[0] for r in df.select(column).distinct().orderBy(column).collect()]


def _full_gold(spark: SparkSession, silver: Snapshot, attempt: Attempt) -> list[Part]:
    events, by_date, metadata = (silver_table(spark, silver, e) for e in (EVENTS, BY_DATE, METADATA))
    visitors = _visitor_state(events).withColumn("bucket", bucket_of(["visitor_id"], DIMENSION_BUCKETS))
    media = _media_state(metadata, _media_urls(events)).withColumn("bucket", bucket_of(["media_id"], DIMENSION_BUCKETS))
    found = run_all(
        {
            FACT: partial(_write_placed, G.to_fact_media_engagement(events, by_date), attempt, FACT, ("date",)),
            DIM_VISITOR: partial(_write_placed, visitors, attempt, DIM_VISITOR, ("bucket",)),
            DIM_MEDIA: partial(_write_placed, media, attempt, DIM_MEDIA, ("bucket",)),
        }
    )
    return [p for parts in found.values() for p in parts]


def changed_days(spark: SparkSession, silver: Snapshot) -> list:
    """Days (null: None) of events and totals that came or went with ``silver``."""
    events = silver.read(spark, changes_of(EVENTS), _changes_schema(EVENTS)).select(utc_day("received_at").alias("day"))
    totals = silver.read(spark, changes_of(BY_DATE), _changes_schema(BY_DATE)).select(F.col("date").alias("day"))
    return _values(events.unionByName(totals), "day")


def _changes_schema(endpoint: str) -> StructType:
    return StructType([*schemas.SILVER_SCHEMAS[endpoint].fields, StructField("n", IntegerType())])


def fact_of_days(spark: SparkSession, silver: Snapshot, days: Sequence) -> DataFrame:
    """The fact of some days, from those days of Silver alone."""

    def of_days(table: DataFrame, column: str) -> DataFrame:
        among = F.col(column).isin([d for d in days if d is not None])
        return table.where(among | F.col(column).isNull() if None in days else among)

    events = of_days(silver_table(spark, silver, EVENTS), "day")
    by_date = of_days(silver_table(spark, silver, BY_DATE), "date")
    return G.to_fact_media_engagement(events, by_date)


def _advance_fact(spark: SparkSession, silver: Snapshot, attempt: Attempt) -> list[Part]:
    days = changed_days(spark, silver)
    if not days:
        return attempt.base.parts_of(FACT)
    new = _write_placed(fact_of_days(spark, silver, days), attempt, FACT, ("date",))
    gone = {NULL_PART if d is None else d.isoformat() for d in days}
    return [*(p for p in attempt.base.parts_of(FACT) if p.part not in gone), *new]


def _advance_visitors(spark: SparkSession, silver: Snapshot, attempt: Attempt, stage: str) -> list[Part]:
    changes = silver.read(spark, changes_of(EVENTS), _changes_schema(EVENTS))
    touched = changes.select(F.col("visitor_key").alias("visitor_id")).distinct()
    buckets = _values(touched.select(bucket_of(["visitor_id"], DIMENSION_BUCKETS).alias("b")), "b")
    if not buckets:
        return attempt.base.parts_of(DIM_VISITOR)
    stored = attempt.base.read(spark, DIM_VISITOR, VISITOR_STATE, map(str, buckets))
    went = changes.where("n < 0").select(F.col("visitor_key").alias("visitor_id"), F.col("event_key").alias("seen_by"))
    lost = stored.join(went, ["visitor_id", "seen_by"], "left_semi").select("visitor_id")
    write_layer(lost, stage, "visitors")
    lost = read_layer(spark, stage, "visitors")
    columns = [f.name for f in VISITOR_STATE.fields if f.name != "bucket"]
    rows = stored.select(*columns).unionByName(_visitor_state(changes.where("n > 0")).select(*columns))
    if not lost.isEmpty():
        events = silver_table(spark, silver, EVENTS)
        again = events.join(lost.withColumnRenamed("visitor_id", "visitor_key"), "visitor_key", "left_semi")
        rows = rows.join(lost, "visitor_id", "left_anti").unionByName(_visitor_state(again).select(*columns))
    merged = _latest_visitor(rows).withColumn("bucket", bucket_of(["visitor_id"], DIMENSION_BUCKETS))
    return _dim_parts(attempt, DIM_VISITOR, _write_placed(merged, attempt, DIM_VISITOR, ("bucket",)), buckets)


def _advance_media(spark: SparkSession, silver: Snapshot, attempt: Attempt, stage: str) -> list[Part]:
    changes = silver.read(spark, changes_of(EVENTS), _changes_schema(EVENTS)).where(F.col("media_url").isNotNull())
    named = silver.read(spark, changes_of(METADATA), _changes_schema(METADATA))
    touched = changes.select("media_id").unionByName(named.select("media_id")).distinct()
    buckets = _values(touched.select(bucket_of(["media_id"], DIMENSION_BUCKETS).alias("b")), "b")
    if not buckets:
        return attempt.base.parts_of(DIM_MEDIA)
    stored = attempt.base.read(spark, DIM_MEDIA, MEDIA_STATE, map(str, buckets)).select("media_id", "url", "url_seen")
    went = changes.where("n < 0").select("media_id", F.col("media_url").alias("url"), F.col("received_at").alias("url_seen"))
    same = [stored[c].eqNullSafe(went[c]) for c in ("media_id", "url", "url_seen")]
    lost = stored.join(went, same, "left_semi").select("media_id")
    unknown = named.where("n > 0").select("media_id").join(stored, "media_id", "left_anti")
    write_layer(lost.unionByName(unknown).distinct(), stage, "media")
    again = read_layer(spark, stage, "media")
    came = _media_urls(changes.where("n > 0"))
    rows = stored.where(F.col("url").isNotNull()).unionByName(came)
    if not again.isEmpty():
        events = silver_table(spark, silver, EVENTS).select("media_id", "media_url", "received_at")
        rows = rows.join(again, "media_id", "left_anti").unionByName(_media_urls(events.join(again, "media_id", "left_semi")))
    best = rows.groupBy("media_id").agg(F.max(F.struct("url_seen", "url")).alias("b"))
    urls = best.select("media_id", F.col("b.url").alias("url"), F.col("b.url_seen").alias("url_seen"))
    bucket = bucket_of(["media_id"], DIMENSION_BUCKETS)
    metadata = silver_table(spark, silver, METADATA).where(bucket.isin(buckets))
    merged = _media_state(metadata, urls).withColumn("bucket", bucket)
    return _dim_parts(attempt, DIM_MEDIA, _write_placed(merged, attempt, DIM_MEDIA, ("bucket",)), buckets)


def advance_gold(spark: SparkSession, silver_root: str, gold_root: str, version: str) -> Snapshot:
    """Bring Gold to Silver's newest snapshot: by its changes where Gold reflects the snapshot before it."""
    use_utc(spark)
    silver = published.newest(spark, silver_root)
    if silver is None:
        raise ValueError(f"nothing is published under {silver_root}")
    attempt = Attempt(spark, gold_root, version)
    if attempt.base and attempt.base.source == silver.id:
        return attempt.base
    if attempt.base is None or attempt.base.source is None or attempt.base.source != silver.previous:
        return attempt.commit(_full_gold(spark, silver, attempt), {}, silver.id, {"built": "full"})
    stage = scratch_path(spark, "advance")
    found = run_all(
        {
            FACT: partial(_advance_fact, spark, silver, attempt),
            DIM_VISITOR: partial(_advance_visitors, spark, silver, attempt, stage),
            DIM_MEDIA: partial(_advance_media, spark, silver, attempt, stage),
        }
    )
    snapshot = attempt.commit([p for parts in found.values() for p in parts], {}, silver.id, {"built": "changes"})
    remove(spark, stage)
    return snapshot


# --- a run ------------------------------------------------------------------------


def advance_lake(
    spark: SparkSession, landing_root: str, state_root: str, silver_root: str, gold_root: str, until: str | None = None
) -> Snapshot | None:
    """Take the runs that landed since the last time into Silver, and Silver's changes into Gold.

    The runs are those committed after Silver's version (``until``: no later ones);
    only their landing folders are listed and read. Without a new run Gold still
    catches up with Silver, where an earlier call failed between the two. Returns
    Gold's snapshot, or None if nothing has landed yet.
    """
    last = published.newest(spark, silver_root)
    landed = landed_runs(spark, state_root, last.version if last else None)
    runs = {version: folder for version, folder in landed.items() if until is None or version <= until}
    if not runs and last is None:
        return None
    version = max(runs) if runs else last.version
    if runs:
        folders = list(runs.values())
        new = {e: to_bronze(read_landing(spark, e, landing_root, runs=folders)) for e in schemas.ENDPOINTS}
        advance_silver(spark, new, silver_root, version)
    return advance_gold(spark, silver_root, gold_root, version)
