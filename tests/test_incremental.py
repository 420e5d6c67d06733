"""Incremental load: cut-offs, floor default, validation, state advance, run."""

import datetime as dt

import pytest

from playlake.operators.bronze import to_bronze
from playlake.plans import incremental as inc
from playlake.sources import published, schemas
from playlake.sources.landing import read_landing
from playlake.sources.layers import write_layer

CLOCK = inc.RunClock(floor=dt.date(2024, 1, 10), today=dt.date(2024, 1, 30), run_at="2024-01-30T06:00:00+00:00")
EVENT_SRC = (
    "media_id string, received_at string, event_key string, ip string, country string, "
    "percent_viewed double, conversion_type string, visitor_key string, media_name string, media_url string"
)
BY_DATE_SRC = "media_id string, date string, load_count bigint, play_count bigint, hours_watched double"
META_SRC = "media_id string, hashed_id string, name string, created string"


def ev(media, received, key):
    return (media, received, key, "ip", "US", 0.5, "", "v1", "M", "u")


def state_df(spark, rows):
    return spark.createDataFrame(rows, inc.STATE_SCHEMA)


def sources(spark, events, by_date=(), meta=()):
    return {
        schemas.EVENTS: spark.createDataFrame(list(events), EVENT_SRC),
        schemas.BY_DATE: spark.createDataFrame(list(by_date), BY_DATE_SRC),
        schemas.MEDIA_METADATA: spark.createDataFrame(list(meta), META_SRC),
    }


def media(spark, *ids):
    return spark.createDataFrame([(m,) for m in ids], "media_id string")


def test_cutoff_is_strict_and_floor_is_default(spark):
    mark = dt.datetime(2024, 1, 20, 0, 0)
    state = state_df(spark, [("events", "m1", mark, None)])
    src = sources(spark, [
        ev("m1", "2024-01-20T00:00:00.000Z", "at-mark"),
        ev("m1", "2024-01-20T00:00:00.001Z", "after"),
        ev("m1", "2024-01-19T00:00:00.000Z", "before"),
        ev("m2", "2024-01-09T23:59:59.999Z", "before-floor"),
        ev("m2", "2024-01-10T00:00:00.001Z", "after-floor"),
    ])
    plan = inc.plan_load(src, media(spark, "m1", "m2"), state, CLOCK)
    keys = sorted(r["event_key"] for r in plan.pulls[schemas.EVENTS].collect())
    assert keys == ["after", "after-floor"]


def test_cutoff_compares_instants_across_offsets(spark):
    state = state_df(spark, [("events", "m1", dt.datetime(2024, 1, 20, 0, 0), None)])
    src = sources(spark, [ev("m1", "2024-01-20T01:00:00+02:00", "earlier"),
                          ev("m1", "2024-01-19T23:00:00-02:00", "later")])
    plan = inc.plan_load(src, media(spark, "m1"), state, CLOCK)
    assert [r["event_key"] for r in plan.pulls[schemas.EVENTS].collect()] == ["later"]


def test_by_date_range_inclusive_and_rereads_mark_day(spark):
    state = state_df(spark, [("by_date", "m1", None, dt.date(2024, 1, 20))])
    src = sources(spark, [], by_date=[
        ("m1", "2024-01-19", 1, 1, 0.1), ("m1", "2024-01-20", 1, 1, 0.1),
        ("m1", "2024-01-30", 1, 1, 0.1), ("m1", "2024-01-31", 1, 1, 0.1),
        ("m2", "2024-01-09", 1, 1, 0.1), ("m2", "2024-01-10", 1, 1, 0.1), ("m2", "bad", 1, 1, 0.1),
    ])
    plan = inc.plan_load(src, media(spark, "m1", "m2"), state, CLOCK)
    got = sorted((r["media_id"], r["date"]) for r in plan.pulls[schemas.BY_DATE].collect())
    assert got == [("m1", "2024-01-20"), ("m1", "2024-01-30"), ("m2", "2024-01-10")]


def test_naive_state_is_rejected(spark):
    naive = spark.createDataFrame(
        [("events", "m1", dt.datetime(2024, 1, 1), None)],
        "endpoint string, media_id string, watermark_ts timestamp_ntz, watermark_date date",
    )
    with pytest.raises(ValueError, match="zone-aware"):
        inc.check_state(naive)


def test_bad_rows_are_rejected_and_their_media_loads_on(spark):
    src = sources(
        spark,
        [ev("m1", "2024-01-25T00:00:00", "naive"), ev("m1", "2024-01-26T00:00:00Z", "ok1"), ev("m1", "bad", "x"),
         ev("m1", "2024-01-29", "day only"), ev("m1", None, "none"), ev("m2", "2024-01-25T00:00:00Z", "ok2"),
         ev("m9", "bad", "not in the run")],
        meta=[("m1", "m1", "A", "x"), ("m2", "m2", "B", "x")],
    )
    plan = inc.plan_load(src, media(spark, "m1", "m2"), inc.empty_state(spark), CLOCK)
    summary = {r["media_id"]: r for r in inc.summarize(plan).collect()}
    assert summary["m1"]["error"] is None and summary["m1"]["events"] == 1 and summary["m1"]["rejected"] == 4
    assert summary["m2"]["error"] is None and summary["m2"]["events"] == 1 and summary["m2"]["rejected"] == 0
    assert set(summary) == {"m1", "m2"}
    assert {r["event_key"] for r in plan.rejected.collect()} == {"naive", "x", "day only", "none"}
    new_state = inc.advance_state(inc.empty_state(spark), plan.loaded, plan.pulls[schemas.EVENTS], CLOCK)
    marks = {(r["endpoint"], r["media_id"]): r["watermark_ts"] for r in new_state.collect()}
    assert marks[("events", "m1")] == dt.datetime(2024, 1, 26)  # no mark comes from a rejected row


def test_contradicting_marks_fail_their_media_alone(spark):
    state = state_df(spark, [("events", "m1", dt.datetime(2024, 1, 20), None), ("events", "m1", dt.datetime(2024, 1, 21), None),
                             ("events", "m2", dt.datetime(2024, 1, 20), None), ("events", "m2", dt.datetime(2024, 1, 20), None)])
    src = sources(spark, [ev("m1", "2024-01-25T00:00:00Z", "a"), ev("m2", "2024-01-25T00:00:00Z", "b")],
                  meta=[("m1", "m1", "A", "x"), ("m2", "m2", "B", "x")])
    plan = inc.plan_load(src, media(spark, "m1", "m2"), state, CLOCK)
    summary = {r["media_id"]: r for r in inc.summarize(plan).collect()}
    assert summary["m1"]["error"] == inc.AMBIGUOUS_MARK and summary["m1"]["events"] == 0 == summary["m1"]["media_metadata"]
    assert summary["m2"]["error"] is None and summary["m2"]["events"] == 1  # equal rows do not fan out
    status = inc.run_status(inc.summarize(plan)).collect()[0]
    assert (status["media"], status["failed"], status["had_errors"]) == (2, 1, True)


@pytest.mark.parametrize("text,aware", [
    ("2024-01-20", False), ("2024-01-20T10:00:00", False), ("2024-01-20T10:00:00Z", True), ("2024-01-20T10:00:00.123+02:00", True),
    ("2024-01-20T10:00-0200", True), ("2024-01-20 10:00:00 +01", True), ("bad", False), (None, None),
])
def test_zone_aware(spark, text, aware):
    from playlake.functions.columns import is_zone_aware

    assert spark.createDataFrame([(text,)], "t string").select(is_zone_aware("t")).first()[0] is aware


def test_pulls_keep_undeclared_fields(spark):
    src = sources(spark, [ev("m1", "2024-01-25T00:00:00Z", "a")])
    src[schemas.EVENTS] = src[schemas.EVENTS].selectExpr("*", "'Oslo' as city", "named_struct('x', 1) as nested")
    plan = inc.plan_load(src, media(spark, "m1"), inc.empty_state(spark), CLOCK)
    row = plan.pulls[schemas.EVENTS].first()
    assert row["city"] == "Oslo" and row["nested"]["x"] == 1


def test_source_by_day_is_pruned(spark, lake_dir):
    """Only the days from the least mark on are read, and those of events without a day for the rejects."""
    from lake_helpers import plan_text

    rows = [ev("m1", f"2024-01-{d:02d}T10:00:00Z", f"e{d}") for d in range(1, 29)] + [ev("m1", "bad", "x")]
    events = sources(spark, rows)[schemas.EVENTS]
    path = f"{lake_dir}/by_day"
    events.selectExpr("*", "to_date(try_to_timestamp(received_at)) as day").write.partitionBy("day").parquet(path)
    src = sources(spark, []) | {schemas.EVENTS: spark.read.parquet(path)}
    state = state_df(spark, [("events", "m1", dt.datetime(2024, 1, 20, 12), None)])
    plan = inc.plan_load(src, media(spark, "m1"), state, CLOCK, day_column="day")
    pulled = plan.pulls[schemas.EVENTS]
    assert "PartitionFilters: [isnotnull(day" in plan_text(pulled) and "Subquery" in plan_text(pulled)
    assert sorted(r["event_key"] for r in pulled.collect()) == [f"e{d}" for d in range(21, 29)]
    assert [r["event_key"] for r in plan.rejected.collect()] == ["x"]


def test_retried_run_changes_nothing(spark, lake_dir):
    """Same stamp again: same state, same version, same next pull; a version without a commit does not count."""
    landing, state_root = f"{lake_dir}/landing", f"{lake_dir}/state"
    src = sources(spark, [ev("m1", "2024-01-25T10:00:00Z", "a")], by_date=[("m1", "2024-01-30", 3, 1, 0.1)])
    first = inc.run_load(spark, src, media(spark, "m1"), landing, state_root, CLOCK).collect()
    state = sorted(inc.read_state(spark, state_root).collect())
    assert inc.run_load(spark, src, media(spark, "m1"), landing, state_root, CLOCK).collect() == first
    assert sorted(inc.read_state(spark, state_root).collect()) == state and len(state) == 2
    inc.write_state(inc.empty_state(spark), published.Attempt(spark, state_root, "99990101T000000000000Z"))  # no commit
    assert sorted(inc.read_state(spark, state_root).collect()) == state
    clock2 = inc.RunClock(CLOCK.floor, dt.date(2024, 1, 31), "2024-01-31T06:00:00+00:00")
    second = inc.run_load(spark, src, media(spark, "m1"), landing, state_root, clock2).collect()[0]
    assert (second["events"], second["by_date"]) == (0, 1)


def test_run_load_leaves_no_stage(spark, lake_dir):
    import os

    from playlake.session import shared_dir

    root = shared_dir(spark).removeprefix("file://").removeprefix("file:")
    before = {f for f in os.listdir(root) if f.startswith("load-stage")}
    src = sources(spark, [ev("m1", "2024-01-25T10:00:00Z", "a"), ev("m1", "bad", "x")])
    summary = inc.run_load(spark, src, media(spark, "m1"), f"{lake_dir}/l", f"{lake_dir}/s", CLOCK)
    assert {f for f in os.listdir(root) if f.startswith("load-stage")} == before
    assert (summary.first()["events"], summary.first()["rejected"]) == (1, 1)
    assert published.newest(spark, f"{lake_dir}/s").read(spark, inc.REJECTED).first()["event_key"] == "x"


def test_only_a_missing_state_is_a_first_run(spark, lake_dir):
    from pyspark.errors import AnalysisException

    state = state_df(spark, [("events", "m1", dt.datetime(2024, 1, 20), None)])
    attempt = published.Attempt(spark, f"{lake_dir}/s", "v1")
    write_layer(state.selectExpr("endpoint", "media_id"), attempt.path, attempt.folder(inc.STATE))
    attempt.commit(attempt.written(inc.STATE), {})
    with pytest.raises((AnalysisException, ValueError)):
        inc.read_state(spark, f"{lake_dir}/s")


def test_state_advance_unchanged_when_empty_and_by_date_to_today(spark):
    old = dt.datetime(2024, 1, 20)
    state = state_df(spark, [("events", "m1", old, None), ("events", "m3", old, None),
                             ("by_date", "m1", None, dt.date(2024, 1, 20))])
    src = sources(spark, [ev("m2", "2024-01-25T10:00:00.000Z", "a"), ev("m2", "2024-01-26T10:00:00.000Z", "b")])
    plan = inc.plan_load(src, media(spark, "m1", "m2"), state, CLOCK)
    new = {(r["endpoint"], r["media_id"]): r for r in
           inc.advance_state(state, plan.loaded, plan.pulls[schemas.EVENTS], CLOCK).collect()}
    assert new[("events", "m1")]["watermark_ts"] == old  # nothing new: unchanged
    assert new[("events", "m3")]["watermark_ts"] == old  # not in this run: kept
    assert new[("events", "m2")]["watermark_ts"] == dt.datetime(2024, 1, 26, 10)
    assert new[("by_date", "m1")]["watermark_date"] == CLOCK.today
    assert new[("by_date", "m2")]["watermark_date"] == CLOCK.today


def test_run_load_end_to_end_with_versioned_state(spark, lake_dir):
    landing, state_root = f"{lake_dir}/landing", f"{lake_dir}/state"
    src = sources(
        spark,
        [ev("m1", "2024-01-25T10:00:00.000Z", "a"), ev("m1", "2024-01-26T10:00:00.000Z", "b")],
        by_date=[("m1", "2024-01-25", 3, 1, 0.1)],
        meta=[("m1", "m1", "A", "2024-01-01T00:00:00+00:00"), ("m2", "m2", "B", "2024-01-01T00:00:00+00:00")],
    )
    summary = {r["media_id"]: r for r in inc.run_load(spark, src, media(spark, "m1", "m2"), landing, state_root, CLOCK).collect()}
    assert (summary["m1"]["events"], summary["m1"]["by_date"], summary["m1"]["media_metadata"]) == (2, 1, 1)
    assert (summary["m2"]["events"], summary["m2"]["by_date"]) == (0, 0)
    # The empty pulls of m2 landed too.
    heads = read_landing(spark, schemas.EVENTS, landing).select("ingestion_metadata.*").collect()
    assert {(h["media_id"], h["record_count"]) for h in heads} == {("m1", 2), ("m2", 0)}
    assert to_bronze(read_landing(spark, schemas.EVENTS, landing)).count() == 2
    # A second run with nothing new pulls nothing and keeps the events mark.
    clock2 = inc.RunClock(CLOCK.floor, dt.date(2024, 1, 31), "2024-01-31T06:00:00+00:00")
    second = {r["media_id"]: r for r in inc.run_load(spark, src, media(spark, "m1", "m2"), landing, state_root, clock2).collect()}
    assert second["m1"]["events"] == 0
    state = inc.read_state(spark, state_root)
    marks = {(r["endpoint"], r["media_id"]): r for r in state.collect()}
    assert marks[("events", "m1")]["watermark_ts"] == dt.datetime(2024, 1, 26, 10)
    assert marks[("by_date", "m2")]["watermark_date"] == dt.date(2024, 1, 31)
    versions = spark.read.schema(published.COMMIT_SCHEMA).parquet(f"{state_root}/{published.COMMITS}/*")
    assert versions.select("version").distinct().count() == 2


def test_read_state_missing_is_empty(spark, lake_dir):
    assert inc.read_state(spark, f"{lake_dir}/nothing").count() == 0


def test_run_clock_requires_offset():
    with pytest.raises(ValueError):
        inc.RunClock(dt.date(2024, 1, 1), dt.date(2024, 1, 2), "2024-01-02T00:00:00")


def test_ingest_date_is_the_utc_day_of_the_run():
    late = inc.RunClock(dt.date(2024, 1, 1), dt.date(2024, 1, 30), "2024-01-30T23:00:00-05:00")
    assert late.ingest_date == "2024-01-31"
    assert CLOCK.ingest_date == "2024-01-30"
    assert late.version == "20240131T040000000000Z" and CLOCK.version < late.version


def test_empty_state_is_typed_like_a_saved_one(spark):
    state = inc.empty_state(spark)
    assert state.schema == inc.STATE_SCHEMA and state.count() == 0
    inc.check_state(state)
