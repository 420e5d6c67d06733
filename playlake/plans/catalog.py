"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator group of the inventory, each over the driver's whole ``events``
table through the ``sources.eventmap`` mapping.

Output conventions (shared with ``plans.oracle``): dates as ``yyyy-MM-dd``
text, timestamps as ``yyyy-MM-dd HH:mm:ss.SSS`` text (UTC), doubles rounded to
6 decimals. The library operators themselves return typed columns; only the
final projection here is made engine-neutral.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from playlake.functions.columns import parse_day, parse_instant
from playlake.operators import reports
from playlake.operators.bronze import to_bronze
from playlake.operators.silver import to_silver
from playlake.plans import copartition, incremental, oracle
from playlake.plans.advance import advance_lake, read_silver
from playlake.plans.concurrent import run_all
from playlake.plans.dashboard import dashboard_frames
from playlake.plans.reach import publish_reach, reach_reports
from playlake.plans.refresh import (
    counts_frame,
    full_refresh,
    gold_tables,
    load_gold,
    publish_layer,
    run_bronze,
    run_gold,
    run_silver,
)
from playlake.session import scratch_path, use_utc
from playlake.sources import eventmap, published, schemas
from playlake.sources.landing import build_envelopes, read_landing, write_landing
from playlake.sources.layers import read_layer, remove, write_layer
from playlake.streaming.bronze_stream import start_bronze_stream
from playlake.streaming.lake_stream import start_lake_stream

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Engine-neutral final projection (see module docstring)."""
    cols = []
    for field in df.schema.fields:
        c = F.col(field.name)
        kind = field.dataType
        if isinstance(kind, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")
        elif isinstance(kind, (DoubleType, FloatType)):
            c = F.round(c, 6)
        cols.append(c.alias(field.name))
    return df.select(*cols)


# --- shared building blocks ---------------------------------------------------
#
# Queries run the way the deployed pipeline does: each layer reads the previous
# layer from Parquet. The raw records mapped from ``events`` are written once
# per (application, sf_dir) as the Bronze layer in the shared scratch folder;
# Silver and Gold are materialised from it on first use by the same operators
# the queries exercise. Silver queries then run their operator on Bronze
# Parquet, Gold queries on Silver Parquet and reports on Gold Parquet, each
# scan pruned to the columns it needs. The landing, stream and incremental
# queries take that same raw record table as their source of pulls.

_LAKES: dict[tuple, dict[str, str]] = {}
# Queries may be called from several driver threads; one lake build at a time.
_LAKE_LOCK = threading.RLock()


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_utc(spark)
    return eventmap.read_events(spark, sf_dir)


def _session_key(spark: SparkSession, sf_dir: str) -> tuple:
    """The application, the folder, and the files that the events table has now:
    after a change of the source nothing built from it earlier is used."""
    files = (
        spark.read.format("binaryFile")
        .load(f"{sf_dir.rstrip('/')}/events.parquet")
        .select("path", "length", F.unix_micros("modificationTime").alias("modified"))
    )
    seen = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modified").cast("decimal(38,0)"))).first()
    return spark.sparkContext.applicationId, sf_dir.rstrip("/"), *seen


def _lake(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    key = _session_key(spark, sf_dir)
    if key not in _LAKES:
        root = scratch_path(spark, "lake")
        _LAKES[key] = {"root": root}
    return _LAKES[key]


def bronze_root(spark: SparkSession, sf_dir: str) -> str:
    with _LAKE_LOCK:
        return _bronze_root(spark, sf_dir)


def _bronze_root(spark: SparkSession, sf_dir: str) -> str:
    lake = _lake(spark, sf_dir)
    if "bronze" not in lake:
        ev = _events(spark, sf_dir)
        path = f"{lake['root']}/bronze"
        run_all({e: partial(write_layer, eventmap.raw_bronze(ev, e), path, e) for e in schemas.ENDPOINTS})
        lake["bronze"] = path
    use_utc(spark)
    return lake["bronze"]


def silver_root(spark: SparkSession, sf_dir: str) -> str:
    with _LAKE_LOCK:
        return _silver_root(spark, sf_dir)


def _silver_root(spark: SparkSession, sf_dir: str) -> str:
    lake = _lake(spark, sf_dir)
    if "silver" not in lake:
        path = f"{lake['root']}/silver"
        run_silver(spark, bronze_root(spark, sf_dir), path)
        lake["silver"] = path
    use_utc(spark)
    return lake["silver"]


def gold_root(spark: SparkSession, sf_dir: str) -> str:
    with _LAKE_LOCK:
        return _gold_root(spark, sf_dir)


def _gold_root(spark: SparkSession, sf_dir: str) -> str:
    lake = _lake(spark, sf_dir)
    if "gold" not in lake:
        path = f"{lake['root']}/gold"
        run_gold(spark, silver_root(spark, sf_dir), path)
        lake["gold"] = path
    use_utc(spark)
    return lake["gold"]


def build_lake(spark: SparkSession, sf_dir: str) -> None:
    """Materialise Bronze, Silver and Gold for ``sf_dir`` (idempotent per session)."""
    gold_root(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Silver tables computed now from the Bronze layer."""
    root = bronze_root(spark, sf_dir)
    return {e: to_silver(read_layer(spark, root, e), e) for e in schemas.ENDPOINTS}


def _gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Gold tables computed now from the Silver layer."""
    return gold_tables(spark, silver_root(spark, sf_dir))


def _dashboard(frame: str) -> Query:
    """A table of the dashboard: the report with the mean in percent (P9)."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(dashboard_frames(spark, gold_root(spark, sf_dir))[frame])

    return run


def _reach(report: str) -> Query:
    """A report from visitor bitmaps, which are published beside Gold once per session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with _LAKE_LOCK:
            gold = _gold_root(spark, sf_dir)
            lake = _lake(spark, sf_dir)
            if "reach" not in lake:
                path = f"{lake['root']}/reach"
                publish_reach(spark, gold, path)
                lake["reach"] = path
        return portable(reach_reports(spark, lake["reach"], load_gold(spark, gold)[DIM_MEDIA])[report]())

    return run


def copartitioned_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from Silver stored co-partitioned (once per session): no exchange under its join."""
    with _LAKE_LOCK:
        silver = _silver_root(spark, sf_dir)
        lake = _lake(spark, sf_dir)
        if "copartitioned" not in lake:
            path = f"{lake['root']}/copartitioned"
            copartition.store(spark, silver, path)
            lake["copartitioned"] = path
    return portable(copartition.fact_from_stored(spark, lake["copartitioned"]))


def _report(fn: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(load_gold(spark, gold_root(spark, sf_dir))))

    return run


FACT, DIM_MEDIA, DIM_VISITOR = schemas.FACT_MEDIA_ENGAGEMENT, schemas.DIM_MEDIA, schemas.DIM_VISITOR


# --- Bronze and landing --------------------------------------------------------


def _raw(spark: SparkSession, sf_dir: str, endpoint: str) -> DataFrame:
    """The endpoint's raw records (record fields + lineage), as mapped from the
    events table and written once per session with the lake."""
    return read_layer(spark, bronze_root(spark, sf_dir), endpoint)


def _records(spark: SparkSession, sf_dir: str, endpoint: str) -> DataFrame:
    """Whole records, undeclared and mistyped fields included, straight from the events table."""
    return eventmap.raw_records(_events(spark, sf_dir), endpoint)


def _land_all(spark: SparkSession, sf_dir: str, root: str) -> None:
    """Land every endpoint's raw records as envelopes (concurrent write jobs)."""
    run_all(
        {
            e: partial(write_landing, build_envelopes(_raw(spark, sf_dir, e), e), e, root)
            for e in schemas.ENDPOINTS
        }
    )


def _landed(spark: SparkSession, sf_dir: str, endpoint: str) -> str:
    """The endpoint's whole records landed as JSON; the landing root."""
    root = scratch_path(spark, "landing")
    write_landing(build_envelopes(_records(spark, sf_dir, endpoint), endpoint), endpoint, root)
    return root


def landing_raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records landed whole and read back with a schema of all their fields."""
    root = _landed(spark, sf_dir, schemas.EVENTS)
    declared = schemas.RECORD_SCHEMAS[schemas.EVENTS]
    wide = StructType(
        [
            *declared.fields,
            StructField("city", StringType()),
            StructField(
                "user_agent_details",
                StructType(
                    [
                        StructField("browser", StringType()),
                        StructField(
                            "platform", StructType([StructField("mobile", BooleanType()), StructField("build", LongType())])
                        ),
                    ]
                ),
            ),
        ]
    )
    flat = to_bronze(read_landing(spark, schemas.EVENTS, root, wide))
    details = F.col("user_agent_details")
    return portable(
        flat.select(
            *declared.names,
            "city",
            details["browser"].alias("browser"),
            details["platform"]["mobile"].alias("mobile"),
            details["platform"]["build"].alias("build"),
            *schemas.LINEAGE,
        )
    )


def _bronze_landed(endpoint: str) -> Query:
    """Bronze rows of an endpoint's whole records, through the JSON files."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(to_bronze(read_landing(spark, endpoint, _landed(spark, sf_dir, endpoint))))

    return run


def bronze_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events -> envelopes (chunked ``collect_list``) -> flattened Bronze rows."""
    raw = _raw(spark, sf_dir, schemas.EVENTS)
    envelopes = build_envelopes(raw, schemas.EVENTS)
    return portable(to_bronze(envelopes))


def landed_counts(spark: SparkSession, landing_root: str, runs: list[str] | None = None) -> DataFrame:
    """Per (endpoint, pull): records announced by the envelope headers, rows the
    flatten gives back, and whether an empty pull landed. One scan per endpoint:
    an envelope's header counts at its first record, or alone if it has none."""
    parts = []
    for endpoint in schemas.ENDPOINTS:
        flat = read_landing(spark, endpoint, landing_root, runs=runs).select(
            F.lit(endpoint).alias("endpoint"),
            *[F.col(f"ingestion_metadata.{c}").alias(c) for c in schemas.LINEAGE],
            F.col("ingestion_metadata.record_count").alias("announced"),
            F.posexplode_outer(F.transform("records", lambda r: F.lit(True))).alias("pos", "row"),
        )
        parts.append(flat)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    return out.groupBy("endpoint", *schemas.LINEAGE).agg(
        F.sum(F.when(first, F.col("announced")).otherwise(0)).cast("long").alias("records"),
        F.count("row").cast("long").alias("bronze_rows"),
        F.bool_or(F.col("announced") == 0).alias("empty_pull"),
    )


def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three endpoints landed as JSON in the shared scratch folder, scanned back."""
    root = scratch_path(spark, "landing")
    _land_all(spark, sf_dir, root)
    return landed_counts(spark, root).drop("empty_pull")


def bronze_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze kept by the ``availableNow`` stream: run 1 landed and streamed,
    then run 2 landed and streamed again (only its new files are read)."""
    raw = _raw(spark, sf_dir, schemas.EVENTS)
    root = scratch_path(spark, "stream")
    landing, bronze = f"{root}/landing", f"{root}/bronze"
    for stamp in (eventmap.RUN_STAMPS[1], eventmap.RUN_STAMPS[2]):
        run = raw.where(F.col("ingest_timestamp") == stamp)
        write_landing(build_envelopes(run, schemas.EVENTS), schemas.EVENTS, landing)
        query = start_bronze_stream(spark, schemas.EVENTS, landing, bronze)
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    return portable(read_layer(spark, bronze, schemas.EVENTS))


# --- Silver and Gold -------------------------------------------------------------


def _silver_query(endpoint: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(_silver(spark, sf_dir)[endpoint])

    return run


def _gold_query(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(_gold(spark, sf_dir)[table])

    return run


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full refresh landing -> Bronze -> Silver -> Gold in the shared scratch folder."""
    root = scratch_path(spark, "lake")
    landing = f"{root}/landing"
    _land_all(spark, sf_dir, landing)
    counts = full_refresh(spark, landing, f"{root}/bronze", f"{root}/silver", f"{root}/gold")
    return counts_frame(spark, counts)


# A full refresh from the landing files, once per (application, sf_dir), for the
# three queries that give its Gold tables by value.
_REFRESHED: dict[tuple, str] = {}


def refreshed_lake(spark: SparkSession, sf_dir: str) -> str:
    """Gold after a full refresh, a Gold run that failed in a task, and a repeated Gold run."""
    with _LAKE_LOCK:
        key = _session_key(spark, sf_dir)
        if key not in _REFRESHED:
            root = scratch_path(spark, "lake")
            landing, silver, gold = f"{root}/landing", f"{root}/silver", f"{root}/gold"
            _land_all(spark, sf_dir, landing)
            full_refresh(spark, landing, f"{root}/bronze", silver, gold)
            remove(spark, landing)
            # a Gold run that writes both dimensions anew, emptied, and then fails on the fact
            tables = {name: df.limit(0) for name, df in gold_tables(spark, silver).items()}
            tables[FACT] = failing(gold_tables(spark, silver)[FACT], "play_count")
            expect_failure(lambda: publish_layer(spark, gold, tables))
            run_gold(spark, silver, gold)
            expect_failure(lambda: publish_layer(spark, gold, tables))
            _REFRESHED[key] = gold
        use_utc(spark)
        return _REFRESHED[key]


INJECTED = "injected failure"


def failing(df: DataFrame, column: str) -> DataFrame:
    """``df``, planned as usual, failing in the tasks that compute ``column``."""
    kind = df.schema[column].dataType
    return df.withColumn(column, F.when(F.length(F.lit(INJECTED)) > F.size(F.array()), F.raise_error(F.lit(INJECTED)).cast(kind)))


def expect_failure(run: Callable[[], object]) -> None:
    """Run what must fail with the injected failure; any other outcome is an error."""
    try:
        run()
    except Exception as failure:
        if INJECTED not in str(failure):
            raise
    else:
        raise AssertionError("the injected failure did not happen")


def _refreshed(table: str) -> Query:
    """A Gold table as a full refresh leaves it, by value: neither a failed run nor a repeated one changes it."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(load_gold(spark, refreshed_lake(spark, sf_dir))[table])

    return run


# --- incremental load ---------------------------------------------------------------

INCREMENTAL_CLOCK = incremental.RunClock(
    floor=dt.date.fromisoformat(oracle.INC_FLOOR),
    today=dt.date.fromisoformat(oracle.INC_TODAY),
    run_at=f"{oracle.INC_TODAY}T06:00:00+00:00",
)


def incremental_inputs(spark: SparkSession, sf_dir: str):
    """Sources (all records, redelivered and unparseable ones included), media list
    and a state with marks for media m0..m29, all derived from the events table."""
    root = bronze_root(spark, sf_dir)
    sources = {
        e: read_layer(spark, root, e).select("media_id", *schemas.record_fields(e)) for e in schemas.ENDPOINTS
    }
    media = read_layer(spark, root, schemas.EVENTS).select("media_id").distinct()
    tracked = media.where(F.substring("media_id", 2, 10).cast("int") < oracle.INC_STATE_MEDIA_BELOW)
    state = tracked.select(
        F.lit(schemas.EVENTS).alias("endpoint"),
        "media_id",
        F.to_timestamp(F.lit(oracle.INC_STATE_TS)).alias("watermark_ts"),
        F.lit(None).cast("date").alias("watermark_date"),
    ).unionByName(
        tracked.select(
            F.lit(schemas.BY_DATE).alias("endpoint"),
            "media_id",
            F.lit(None).cast("timestamp").alias("watermark_ts"),
            F.to_date(F.lit(oracle.INC_STATE_DATE)).alias("watermark_date"),
        )
    )
    return sources, media, state


def _load_plan(spark: SparkSession, sf_dir: str) -> tuple[incremental.LoadPlan, DataFrame]:
    sources, media, state = incremental_inputs(spark, sf_dir)
    return incremental.plan_load(sources, media, state, INCREMENTAL_CLOCK), state


def incremental_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, _ = _load_plan(spark, sf_dir)
    return portable(
        plan.pulls[schemas.EVENTS].select(
            "media_id", "event_key", "visitor_key", "received_at", "percent_viewed"
        )
    )


def incremental_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, _ = _load_plan(spark, sf_dir)
    return portable(
        plan.pulls[schemas.BY_DATE].select(
            "media_id", "date", "load_count", "play_count", "hours_watched"
        )
    )


def state_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, state = _load_plan(spark, sf_dir)
    new_state = incremental.advance_state(
        state, plan.loaded, plan.pulls[schemas.EVENTS], INCREMENTAL_CLOCK
    )
    return portable(new_state)


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan, _ = _load_plan(spark, sf_dir)
    return incremental.summarize(plan)


def incremental_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load with contradicting marks for the first media: those fail and pull
    nothing, the others load, past their unparseable events."""
    sources, media, state = incremental_inputs(spark, sf_dir)
    doubled = state.where(F.substring("media_id", 2, 10).cast("int") < oracle.INC_AMBIGUOUS_BELOW).withColumn(
        "watermark_ts", F.col("watermark_ts") + F.expr("INTERVAL 1 DAY")
    )
    state = state.unionByName(doubled.where(F.col("endpoint") == schemas.EVENTS))
    return incremental.summarize(incremental.plan_load(sources, media, state, INCREMENTAL_CLOCK))


# The end-to-end run: the initial state is saved as its own version, then
# ``run_load`` pulls, lands every pull (empty ones too), appends the advanced
# state and returns the summary. One run per (application, sf_dir); its
# landing tree, state table and summary sit in the shared scratch folder.
INITIAL_STATE_VERSION = "20240120T000000000000Z"
_RUNS: dict[tuple, dict[str, str]] = {}


def _incremental_run(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    with _LAKE_LOCK:
        key = _session_key(spark, sf_dir)
        if key not in _RUNS:
            sources, media, state = incremental_inputs(spark, sf_dir)
            root = scratch_path(spark, "incremental")
            landing, state_root = f"{root}/landing", f"{root}/state"
            incremental.save_state(state, state_root, INITIAL_STATE_VERSION)
            summary = incremental.run_load(
                spark, sources, media, landing, state_root, INCREMENTAL_CLOCK
            )
            write_layer(summary, root, "summary")
            _RUNS[key] = {"root": root, "landing": landing, "state": state_root}
        use_utc(spark)
        return _RUNS[key]


def incremental_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary returned by the end-to-end run (records pulled per media and endpoint)."""
    run = _incremental_run(spark, sf_dir)
    return read_layer(spark, run["root"], "summary")


def incremental_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the run landed, scanned back: per endpoint and media, the records,
    the flattened rows and whether an empty pull landed as an empty envelope."""
    run = _incremental_run(spark, sf_dir)
    return landed_counts(spark, run["landing"])


def incremental_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state version the run saved, read back as the next run would."""
    run = _incremental_run(spark, sf_dir)
    return portable(incremental.read_state(spark, run["state"]))


# Two loads in a row, as on two days: the first sees the source as it was before
# ``INC_SPLIT``, the second all of it; then Bronze and Silver over what both landed.
FIRST_CLOCK = incremental.RunClock(
    floor=INCREMENTAL_CLOCK.floor,
    today=dt.date.fromisoformat(oracle.INC_SPLIT),
    run_at=f"{oracle.INC_SPLIT}T06:00:00+00:00",
)


def _first_sources(sources: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The sources before the split day; what cannot be placed in time was there already."""
    split = F.lit(oracle.INC_SPLIT).cast("date")
    early = {
        schemas.EVENTS: F.coalesce(F.to_date(parse_instant("received_at")) < split, F.lit(True)),
        schemas.BY_DATE: F.coalesce(parse_day("date") < split, F.lit(True)),
    }
    return {e: df.where(early[e]) if e in early else df for e, df in sources.items()}


_TWO_RUNS: dict[tuple, str] = {}


def two_runs(spark: SparkSession, sf_dir: str, mishap: str = "") -> str:
    """Both loads in a row, once per (application, sf_dir); the root of landing and state.

    ``mishap``: "retry", the first load is run twice; "failed retry", it is tried
    again twice and fails, once at its pulls and once while it saves its state.
    """
    with _LAKE_LOCK:
        key = (*_session_key(spark, sf_dir), mishap)
        if key not in _TWO_RUNS:
            sources, media, state = incremental_inputs(spark, sf_dir)
            root = scratch_path(spark, "two-runs")
            landing, state_root = f"{root}/landing", f"{root}/state"
            incremental.save_state(state, state_root, INITIAL_STATE_VERSION)
            early = _first_sources(sources)
            for _ in range(2 if mishap == "retry" else 1):
                incremental.run_load(spark, early, media, landing, state_root, FIRST_CLOCK)
            if mishap == "failed retry":
                broken = early | {schemas.BY_DATE: failing(early[schemas.BY_DATE], "play_count")}
                expect_failure(lambda: incremental.run_load(spark, broken, media, landing, state_root, FIRST_CLOCK))
                saved = incremental.read_state(spark, state_root)
                expect_failure(
                    lambda: incremental.save_state(failing(saved, "watermark_ts"), state_root, FIRST_CLOCK.version)
                )
            incremental.run_load(spark, sources, media, landing, state_root, INCREMENTAL_CLOCK)
            _TWO_RUNS[key] = root
        use_utc(spark)
        return _TWO_RUNS[key]


def _two_runs_silver(endpoint: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        landing = f"{two_runs(spark, sf_dir)}/landing"
        return portable(to_silver(to_bronze(read_landing(spark, endpoint, landing)), endpoint))

    return run


def incremental_two_runs_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The marks after both loads."""
    return portable(incremental.read_state(spark, f"{two_runs(spark, sf_dir)}/state"))


def landing_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the committed runs landed, each read from its own folder, after failed retries of the first."""
    root = two_runs(spark, sf_dir, "failed retry")
    return landed_counts(spark, f"{root}/landing", list(incremental.landed_runs(spark, f"{root}/state").values()))


def _after(mishap: str, table: str) -> Query:
    """What the second load published after a mishap of the first: as if that had run once."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = two_runs(spark, sf_dir, mishap)
        return portable(published.newest(spark, f"{root}/state").read(spark, table))

    return run


# Silver and Gold kept up with both loads: by ``advance_lake`` after each, and by the
# stream over the files of both. Each once per (application, sf_dir).
_ADVANCED: dict[tuple, str] = {}


def advanced_lake(spark: SparkSession, sf_dir: str, streamed: bool = False) -> str:
    """The root of a Silver and a Gold that took in one load after the other."""
    with _LAKE_LOCK:
        key = (*_session_key(spark, sf_dir), streamed)
        if key not in _ADVANCED:
            loads, root = two_runs(spark, sf_dir), scratch_path(spark, "advanced")
            landing = f"{loads}/landing"
            silver, gold = f"{root}/silver", f"{root}/gold"
            if streamed:
                query = start_lake_stream(spark, landing, silver, gold, f"{root}/checkpoint", max_files_per_trigger=60, buckets=4)
                query.awaitTermination()
                if query.exception() is not None:
                    raise query.exception()
            else:
                for clock in (FIRST_CLOCK, INCREMENTAL_CLOCK):
                    advance_lake(spark, landing, f"{loads}/state", silver, gold, until=clock.version)
                    publish_reach(spark, gold, f"{root}/reach")
            _ADVANCED[key] = root
        use_utc(spark)
        return _ADVANCED[key]


def _advanced_silver(endpoint: str) -> Query:
    """Silver after both loads, upserted: what the full computation over both gives."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(read_silver(spark, f"{advanced_lake(spark, sf_dir)}/silver", endpoint))

    return run


def _advanced_gold(table: str, streamed: bool = False) -> Query:
    """Gold after both loads, recomputed where Silver changed: what the full computation gives."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(load_gold(spark, f"{advanced_lake(spark, sf_dir, streamed)}/gold")[table])

    return run


def advanced_reach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months from bitmaps that were kept up over both loads: only days that Gold rewrote are counted again."""
    root = advanced_lake(spark, sf_dir)
    dim_media = load_gold(spark, f"{root}/gold")[DIM_MEDIA]
    return portable(reach_reports(spark, f"{root}/reach", dim_media)["monthly"]())


def incremental_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events pull from a source partitioned by the UTC day: only days from the least mark on are read."""
    sources, media, state = incremental_inputs(spark, sf_dir)
    with _LAKE_LOCK:
        lake = _lake(spark, sf_dir)
        if "by_day" not in lake:
            path = f"{lake['root']}/by_day"
            day = F.when(incremental.placeable(), F.to_date(parse_instant("received_at")))
            sources[schemas.EVENTS].withColumn("day", day).hint("rebalance", "day").write.partitionBy("day").parquet(path)
            lake["by_day"] = path
    tracked = state.select("media_id").distinct()  # media with marks: a first run reads from the floor on
    plan = incremental.plan_load(
        sources | {schemas.EVENTS: spark.read.parquet(lake["by_day"])}, tracked, state, INCREMENTAL_CLOCK, day_column="day"
    )
    pulled, rejected = plan.pulls[schemas.EVENTS], plan.rejected
    columns = ["media_id", "event_key", "visitor_key", "received_at", "percent_viewed"]
    tagged = [df.select(*columns, F.lit(tag).alias("taken")) for df, tag in ((pulled, True), (rejected, False))]
    return portable(tagged[0].unionByName(tagged[1]))


def incremental_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of a load in which the media with contradicting marks fail."""
    return incremental.run_status(incremental_validation(spark, sf_dir))


# --- registry -------------------------------------------------------------------------


def queries() -> dict[str, Query]:
    return {
        "bronze_flatten": bronze_flatten,
        "landing_roundtrip": landing_roundtrip,
        "bronze_incremental": bronze_incremental,
        "silver_events": _silver_query(schemas.EVENTS),
        "silver_by_date": _silver_query(schemas.BY_DATE),
        "silver_media": _silver_query(schemas.MEDIA_METADATA),
        "dim_media": _gold_query(DIM_MEDIA),
        "dim_visitor": _gold_query(DIM_VISITOR),
        "fact_engagement": _gold_query(FACT),
        "kpi_summary": _report(lambda g: reports.kpi_summary(g[FACT])),
        "engagement_by_media": _report(lambda g: reports.engagement_by_media(g[FACT], g[DIM_MEDIA])),
        "daily_trends": _report(lambda g: reports.daily_trends(g[FACT], g[DIM_MEDIA])),
        "monthly_engagement": _report(lambda g: reports.monthly_engagement(g[FACT], g[DIM_MEDIA])),
        "recent_7d": _report(lambda g: reports.recent_engagement(g[FACT], g[DIM_MEDIA], 7)),
        "recent_30d": _report(lambda g: reports.recent_engagement(g[FACT], g[DIM_MEDIA], 30)),
        "top_visitors": _report(lambda g: reports.top_visitors(g[FACT], g[DIM_VISITOR], 10)),
        "dashboard_by_media": _dashboard("by_media"),
        "dashboard_last_7_days": _dashboard("last_7_days"),
        "dashboard_last_30_days": _dashboard("last_30_days"),
        "dashboard_monthly": _dashboard("monthly"),
        "dashboard_top_visitors": _dashboard("top_visitors"),
        "reach_kpi": _reach("kpi"),
        "reach_by_media": _reach("by_media"),
        "reach_monthly": _reach("monthly"),
        "reach_last_7_days": _reach("last_7_days"),
        "reach_last_30_days": _reach("last_30_days"),
        "copartitioned_fact": copartitioned_fact,
        "layer_counts": layer_counts,
        "landed_fact": _refreshed(FACT),
        "landed_dim_media": _refreshed(DIM_MEDIA),
        "landed_dim_visitor": _refreshed(DIM_VISITOR),
        "landing_raw_records": landing_raw_records,
        "bronze_by_date": _bronze_landed(schemas.BY_DATE),
        "bronze_media": _bronze_landed(schemas.MEDIA_METADATA),
        "incremental_cutoff": incremental_cutoff,
        "incremental_by_date": incremental_by_date,
        "state_advance": state_advance,
        "load_summary": load_summary,
        "incremental_validation": incremental_validation,
        "incremental_run": incremental_run,
        "incremental_landing": incremental_landing,
        "incremental_state": incremental_state,
        "incremental_two_runs_silver": _two_runs_silver(schemas.EVENTS),
        "incremental_two_runs_by_date": _two_runs_silver(schemas.BY_DATE),
        "incremental_two_runs_state": incremental_two_runs_state,
        "incremental_retry": _after("retry", incremental.SUMMARY),
        "incremental_failed_retry": _after("failed retry", incremental.SUMMARY),
        "incremental_failed_retry_state": _after("failed retry", incremental.STATE),
        "incremental_status": incremental_status,
        "incremental_pruned": incremental_pruned,
        "landing_by_run": landing_by_run,
        "advanced_silver_events": _advanced_silver(schemas.EVENTS),
        "advanced_silver_by_date": _advanced_silver(schemas.BY_DATE),
        "advanced_silver_media": _advanced_silver(schemas.MEDIA_METADATA),
        "advanced_fact": _advanced_gold(FACT),
        "advanced_dim_media": _advanced_gold(DIM_MEDIA),
        "advanced_dim_visitor": _advanced_gold(DIM_VISITOR),
        "advanced_reach": advanced_reach,
        "streamed_fact": _advanced_gold(FACT, streamed=True),
        "streamed_dim_media": _advanced_gold(DIM_MEDIA, streamed=True),
        "streamed_dim_visitor": _advanced_gold(DIM_VISITOR, streamed=True),
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
