"""Incremental load: pull only what is new per media, land it, advance the state.

The source is a table of raw API records per endpoint (``media_id`` + record
fields), the way the pipeline sees the engagement API. One plan covers all
media at once — no loop over media on the driver.

Policy per endpoint:

* ``events``: records strictly newer than the media's high-water mark
  (``received_at > since``); ``since`` is the stored mark or, for a media
  without one, the backfill floor at midnight UTC.
* ``by_date``: days in ``[stored date or floor, today]``, inclusive — the
  stored day is pulled again, since its totals may have grown.
* ``media_metadata``: re-read in full every run.

Records are pulled whole, with all fields of the source. A source partitioned by
day (``day_column``: the UTC day of ``received_at``, null where that cannot be
told) is pruned: one scalar, the least mark of the run's media, is a partition
filter, and the exact test per media follows.

Bad records: an event whose ``received_at`` is unparseable or has no UTC offset
cannot be placed in time. It is *rejected*: set aside whole, counted per media in
the summary, and neither lands nor moves a mark. All other records of its media
load as usual. ``error`` is for a media whose mark is unusable: state in which
one media has several rows for an endpoint with different marks. Such a media is
not loaded and its state stays. A state whose mark columns are naive or mistyped
is refused as a whole.

State: one row per (endpoint, media): ``watermark_ts`` (events, an instant)
or ``watermark_date`` (by_date). It advances only at the end of a run: events
to the newest ``received_at`` pulled (unchanged when nothing new arrived),
by_date to ``today`` for every media loaded. A run publishes its state, its
rejected events and its summary together, as one version named by its stamp
(``sources.published``): a folder of its own, made visible by one commit that is
written last. What has no commit does not count, and no committed folder is ever
written to again, so a run that fails anywhere, also a retry, leaves the state as
it was. A run reads the newest committed version *before* its own stamp: tried
again, it reads the same marks, pulls the same records, and its commit is a later
attempt of the same version.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from playlake.functions.columns import is_zone_aware, parse_day, parse_instant
from playlake.plans.concurrent import run_all
from playlake.session import scratch_path, use_utc
from playlake.sources import published, schemas
from playlake.sources.landing import PULL_KEYS, build_envelopes, write_landing
from playlake.sources.layers import read_layer, remove, write_layer

STATE_SCHEMA = StructType(
    [
        StructField("endpoint", StringType()),
        StructField("media_id", StringType()),
        StructField("watermark_ts", TimestampType()),
        StructField("watermark_date", DateType()),
    ]
)
SUMMARY_COLUMNS = ("media_id", *schemas.ENDPOINTS, "rejected", "error")
AMBIGUOUS_MARK = "the state has several marks for one endpoint"
#: Tables that a run publishes with its state.
STATE, REJECTED, SUMMARY = "state", "rejected", "summary"
#: Note of a commit: the landing folder (``run=…``) of the attempt's pulls.
LANDED = "landed"


@dataclass(frozen=True)
class RunClock:
    """Time parameters of one run.

    ``floor``: first day pulled for a media without state. ``today``: last day
    of the by_date pull. ``run_at``: the run's UTC instant (ISO text with
    offset), stamped on every envelope.
    """

    floor: dt.date
    today: dt.date
    run_at: str

    def __post_init__(self) -> None:
        if not re.search(r"(Z|[+-]\d{2}:?\d{2})$", self.run_at):
            raise ValueError(f"run_at must carry a UTC offset: {self.run_at!r}")
        dt.datetime.fromisoformat(self.run_at)  # reject malformed stamps early

    @property
    def ingest_date(self) -> str:
        """UTC calendar date of the run instant (the landing partition)."""
        instant = dt.datetime.fromisoformat(self.run_at)
        return instant.astimezone(dt.timezone.utc).date().isoformat()

    @property
    def version(self) -> str:
        """State version stamp: the run instant in UTC, sortable as text."""
        instant = dt.datetime.fromisoformat(self.run_at).astimezone(dt.timezone.utc)
        return instant.strftime("%Y%m%dT%H%M%S%fZ")

    @property
    def floor_instant(self) -> Column:
        return F.to_timestamp(F.lit(f"{self.floor.isoformat()}T00:00:00Z"))


# --- state ---------------------------------------------------------------


def check_state(state: DataFrame) -> DataFrame:
    """Reject a state whose events marks are time-zone naive (or mistyped)."""
    fields = {f.name: f.dataType for f in state.schema.fields}
    kind = fields.get("watermark_ts")
    if isinstance(kind, TimestampNTZType):
        raise ValueError("watermark_ts must be a zone-aware TIMESTAMP, got TIMESTAMP_NTZ")
    if not isinstance(kind, TimestampType):
        raise ValueError(f"watermark_ts must be TIMESTAMP, got {kind!r}")
    if not isinstance(fields.get("watermark_date"), DateType):
        raise ValueError("watermark_date must be DATE")
    return state


def empty_state(spark: SparkSession) -> DataFrame:
    """A state without marks (first run), typed like a saved one."""
    return spark.range(0).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in STATE_SCHEMA.fields]
    )


def read_state(spark: SparkSession, state_root: str, before: str | None = None) -> DataFrame:
    """Newest committed state version (``before``: of those older than that stamp).

    Empty if none was ever committed. Only the commits (one tiny file per run) and
    the one version are read, not the footers of all versions.
    """
    snapshot = published.newest(spark, state_root, before)
    if snapshot is None:
        return empty_state(spark)
    # As written, not as declared: a naive or mistyped mark must show.
    return check_state(snapshot.read(spark, STATE)).select(*STATE_SCHEMA.names)


def write_state(state: DataFrame, attempt: published.Attempt) -> int:
    """Write ``state`` below the attempt; it counts once the attempt is committed."""
    return write_layer(check_state(state).select(*STATE_SCHEMA.names), attempt.path, attempt.folder(STATE))


def save_state(state: DataFrame, state_root: str, version: str) -> None:
    """Publish ``state`` alone as ``version``; doing so again makes a later attempt of it."""
    attempt = published.Attempt(state.sparkSession, state_root, version)
    rows = write_state(state, attempt)
    attempt.commit(attempt.written(STATE), {STATE: rows})


def landed_runs(spark: SparkSession, state_root: str, after: str | None = None) -> dict[str, str]:
    """Runs that were committed, oldest first, and the landing folder of each (``after``: later runs).

    The manifest of the landing tree: what an attempt that failed has left there is
    in a folder of its own, which no commit names.
    """
    return published.noted(spark, state_root, LANDED, after)


def _marks(state: DataFrame, endpoint: str, column: str) -> DataFrame:
    """One mark per media, however many rows the state has for it."""
    return state.where(F.col("endpoint") == endpoint).groupBy("media_id").agg(F.max(column).alias(column))


# --- cut-offs and pulls --------------------------------------------------


def placeable() -> Column:
    """An event that can be placed in time: its ``received_at`` parses and has an offset."""
    return parse_instant("received_at").isNotNull() & F.coalesce(is_zone_aware("received_at"), F.lit(False))


def rejected_events(source_events: DataFrame, media: DataFrame) -> DataFrame:
    """The run's events that cannot be placed in time, whole."""
    return source_events.where(~placeable()).join(media.select("media_id"), "media_id", "left_semi")


def mark_failures(state: DataFrame, media: DataFrame) -> DataFrame:
    """(media_id, error) for media with contradicting marks."""
    marks = state.groupBy("endpoint", "media_id").agg(
        F.count_distinct(F.struct("watermark_ts", "watermark_date")).alias("n")
    )
    bad = marks.where("n > 1").select("media_id").distinct().withColumn("error", F.lit(AMBIGUOUS_MARK))
    return bad.join(media.select("media_id"), "media_id", "left_semi")


def events_cutoff(media: DataFrame, state: DataFrame, clock: RunClock) -> DataFrame:
    """(media_id, since): stored mark, else the floor at 00:00 UTC."""
    return media.join(_marks(state, schemas.EVENTS, "watermark_ts"), "media_id", "left").select(
        "media_id", F.coalesce("watermark_ts", clock.floor_instant).alias("since")
    )


def by_date_start(media: DataFrame, state: DataFrame, clock: RunClock) -> DataFrame:
    """(media_id, start): stored day, else the floor."""
    return media.join(_marks(state, schemas.BY_DATE, "watermark_date"), "media_id", "left").select(
        "media_id", F.coalesce("watermark_date", F.lit(clock.floor)).alias("start")
    )


def pull_events(
    source_events: DataFrame, media: DataFrame, state: DataFrame, clock: RunClock, day_column: str | None = None
) -> DataFrame:
    """Events strictly newer than each media's mark, with all fields of the source."""
    since = events_cutoff(media, state, clock)
    if day_column:
        # One value, known before the scan starts: only days from the least mark on are listed and read.
        least = since.agg(F.to_date(F.min("since"))).scalar()
        source_events = source_events.where(F.col(day_column) >= least)
    return (
        source_events.where(placeable())
        .join(since, "media_id", "inner")
        .where(parse_instant("received_at") > F.col("since"))
        .drop("since")
    )


def pull_by_date(source_by_date: DataFrame, media: DataFrame, state: DataFrame, clock: RunClock) -> DataFrame:
    """Daily rows with ``start <= date <= today`` per media, with all fields of the source."""
    day = parse_day("date")
    return (
        source_by_date.where(day <= F.lit(clock.today))
        .join(by_date_start(media, state, clock), "media_id", "inner")
        .where(day >= F.col("start"))
        .drop("start")
    )


def pull_media_metadata(source_metadata: DataFrame, media: DataFrame) -> DataFrame:
    return source_metadata.join(media.select("media_id"), "media_id", "left_semi")


@dataclass(frozen=True)
class LoadPlan:
    media: DataFrame  # every media of the run
    loaded: DataFrame  # media whose marks are usable
    failures: DataFrame  # (media_id, error)
    pulls: dict[str, DataFrame]  # endpoint -> pulled records (media_id + fields)
    rejected: DataFrame  # events that cannot be placed in time, whole


def plan_load(
    sources: dict[str, DataFrame],
    media: DataFrame,
    state: DataFrame,
    clock: RunClock,
    failures: DataFrame | None = None,
    day_column: str | None = None,
) -> LoadPlan:
    """The run's pulls; ``failures`` (media_id, error) may be given precomputed."""
    check_state(state)
    media = media.select("media_id").distinct()
    if failures is None:
        failures = mark_failures(state, media)
    loaded = media.join(failures, "media_id", "left_anti")
    events = sources[schemas.EVENTS]
    pulls = {
        schemas.EVENTS: pull_events(events, loaded, state, clock, day_column),
        schemas.BY_DATE: pull_by_date(sources[schemas.BY_DATE], loaded, state, clock),
        schemas.MEDIA_METADATA: pull_media_metadata(sources[schemas.MEDIA_METADATA], loaded),
    }
    # With a day column the rejected rows are those of the null day: pruned likewise.
    bad = events.where(F.col(day_column).isNull()) if day_column else events
    return LoadPlan(media=media, loaded=loaded, failures=failures, pulls=pulls, rejected=rejected_events(bad, loaded))


# --- state advance and summary ---------------------------------------------


def advance_state(state: DataFrame, loaded: DataFrame, pulled_events: DataFrame, clock: RunClock) -> DataFrame:
    """State after the run: old marks merged with the new ones, new winning.

    The merge is a union of old and new rows followed by one aggregate per
    (endpoint, media) — a single shuffle, no full outer join.
    """
    old = state.select(
        "endpoint", "media_id", "watermark_ts", "watermark_date",
        F.lit(None).cast("timestamp").alias("new_ts"), F.lit(None).cast("date").alias("new_date"),
    )
    new_events = pulled_events.select(
        F.lit(schemas.EVENTS).alias("endpoint"),
        "media_id",
        F.lit(None).cast("timestamp").alias("watermark_ts"),
        F.lit(None).cast("date").alias("watermark_date"),
        parse_instant("received_at").alias("new_ts"),
        F.lit(None).cast("date").alias("new_date"),
    )
    new_by_date = loaded.select(
        F.lit(schemas.BY_DATE).alias("endpoint"),
        "media_id",
        F.lit(None).cast("timestamp").alias("watermark_ts"),
        F.lit(None).cast("date").alias("watermark_date"),
        F.lit(None).cast("timestamp").alias("new_ts"),
        F.lit(clock.today).alias("new_date"),
    )
    merged = (
        old.unionByName(new_events)
        .unionByName(new_by_date)
        .groupBy("endpoint", "media_id")
        .agg(
            F.max("watermark_ts").alias("old_ts"),
            F.max("watermark_date").alias("old_date"),
            F.max("new_ts").alias("new_ts"),
            F.max("new_date").alias("new_date"),
        )
    )
    return merged.select(
        "endpoint",
        "media_id",
        F.coalesce("new_ts", "old_ts").alias("watermark_ts"),
        F.coalesce("new_date", "old_date").alias("watermark_date"),
    )


def summarize(plan: LoadPlan, pulls: dict[str, DataFrame] | None = None, rejected: DataFrame | None = None) -> DataFrame:
    """One row per media: records pulled per endpoint, events rejected, and the error if it failed.

    Media list, pulled and rejected records and failures are unioned and
    aggregated once per media (no joins). Only fixed-width values are aggregated —
    counts and a failure flag — so it stays a hash aggregate; the message is
    attached after.
    """
    pulls = pulls or plan.pulls
    rejected = plan.rejected if rejected is None else rejected

    def tag(df: DataFrame, kind: str | None, failed: bool = False) -> DataFrame:
        return df.select("media_id", F.lit(kind).cast("string").alias("kind"), F.lit(failed).alias("failed"))

    tagged = tag(plan.media, None).unionByName(tag(plan.failures, None, True)).unionByName(tag(rejected, "rejected"))
    for endpoint in schemas.ENDPOINTS:
        tagged = tagged.unionByName(tag(pulls[endpoint], endpoint))
    counted = tagged.groupBy("media_id").agg(
        *[F.count_if(F.col("kind") == e).alias(e) for e in (*schemas.ENDPOINTS, "rejected")],
        F.bool_or("failed").alias("failed"),
    )
    return counted.select(
        "media_id",
        *schemas.ENDPOINTS,
        "rejected",
        F.when(F.col("failed"), F.lit(AMBIGUOUS_MARK)).alias("error"),
    )


def run_status(summary: DataFrame) -> DataFrame:
    """One row: media in the run, media that failed, and whether any failed."""
    failed = F.col("error").isNotNull()
    return summary.agg(
        F.count(F.lit(1)).alias("media"),
        F.count_if(failed).alias("failed"),
        F.coalesce(F.bool_or(failed), F.lit(False)).alias("had_errors"),
    )


# --- the run ----------------------------------------------------------------


def _with_run(records: DataFrame, clock: RunClock) -> DataFrame:
    return records.withColumn("ingest_timestamp", F.lit(clock.run_at)).withColumn(
        "ingest_date", F.lit(clock.ingest_date)
    )


def run_load(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    media: DataFrame,
    landing_root: str,
    state_root: str,
    clock: RunClock,
    max_records: int | None = None,
    day_column: str | None = None,
) -> DataFrame:
    """Pull, land, advance the state; return the per-media summary.

    Two rounds of staging under the shared scratch folder. First the run's media
    list and failures (one row per media each). Then the pulled and the rejected
    records: landing, state and summary read the staged delta instead of the
    source again. A lost executor re-runs only the stage it was in. Rejected
    events and the summary are published with the state, by one commit; the staged
    copies are removed once everything that is made from them is stored.
    """
    use_utc(spark)
    state = read_state(spark, state_root, before=clock.version)
    stage_root = scratch_path(spark, "load-stage")
    run_media = media.select("media_id").distinct()
    run_all(
        {
            "media": partial(write_layer, run_media, stage_root, "media"),
            "failures": partial(write_layer, mark_failures(state, run_media), stage_root, "failures"),
        }
    )
    plan = plan_load(
        sources,
        read_layer(spark, stage_root, "media"),
        state,
        clock,
        failures=read_layer(spark, stage_root, "failures"),
        day_column=day_column,
    )
    attempt = published.Attempt(spark, state_root, clock.version, before=clock.version)
    rows = run_all(
        {e: partial(write_layer, records, stage_root, e) for e, records in plan.pulls.items()}
        | {REJECTED: partial(write_layer, plan.rejected, attempt.path, attempt.folder(REJECTED))}
    )
    staged = {e: read_layer(spark, stage_root, e) for e in plan.pulls}
    pulls_made = _with_run(plan.loaded, clock).select(*PULL_KEYS)
    sizing = {"max_records": max_records} if max_records else {}
    run_all(
        {
            e: partial(
                write_landing,
                build_envelopes(_with_run(records, clock), e, pulls=pulls_made, **sizing),
                e,
                landing_root,
                attempt.id,
            )
            for e, records in staged.items()
        }
    )
    new_state = advance_state(state, plan.loaded, staged[schemas.EVENTS], clock)
    summary = summarize(plan, staged, read_layer(spark, attempt.path, attempt.folder(REJECTED)))
    rows = {
        REJECTED: rows[REJECTED],
        SUMMARY: write_layer(summary, attempt.path, attempt.folder(SUMMARY)),
        STATE: write_state(new_state, attempt),
    }
    done = attempt.commit([part for name in rows for part in attempt.written(name)], rows, notes={LANDED: attempt.id})
    remove(spark, stage_root)
    return done.read(spark, SUMMARY)
