"""Layer runs end to end (landing -> Bronze -> Silver -> Gold) and the CLI."""

import pytest

from lake_helpers import SF_SMALL
from playlake.operators.gold import FACT_COLUMNS
from playlake.plans import refresh
from playlake.sources import eventmap, schemas
from playlake.sources.landing import build_envelopes, write_landing


def test_full_refresh_counts_match_the_mapping(spark, lake_dir):
    ev = eventmap.read_events(spark, SF_SMALL)
    landing = f"{lake_dir}/landing"
    for e in schemas.ENDPOINTS:
        write_landing(build_envelopes(eventmap.raw_bronze(ev, e), e, max_records=100), e, landing)
    counts = refresh.full_refresh(spark, landing, f"{lake_dir}/bronze", f"{lake_dir}/silver", f"{lake_dir}/gold")
    # Figures of FIXTURES.md section 4 at sf0.001.
    assert counts["bronze"] == {"events": 1143, "by_date": 903, "media_metadata": 47}
    assert counts["silver"] == {"events": 466, "by_date": 538, "media_metadata": 38}
    assert counts["gold"]["dim_media"] == 38
    assert counts["gold"]["fact_media_engagement"] == 454

    gold = refresh.load_gold(spark, f"{lake_dir}/gold")
    fact = gold[schemas.FACT_MEDIA_ENGAGEMENT]
    assert fact.columns == list(FACT_COLUMNS)
    assert fact.count() == 454 and fact.where("play_rate is null").count() == 128
    assert dict(fact.dtypes)["date"] == "date"
    assert all("/date=" in file for file in fact.inputFiles())


def test_refresh_over_empty_bronze(spark, lake_dir):
    """No record yet: Silver and Gold are tables without rows, and every dashboard frame has its columns."""
    from pyspark.sql import types as T

    from playlake.plans.dashboard import dashboard_frames
    from playlake.sources.layers import write_layer

    for e in schemas.ENDPOINTS:
        lineage = [T.StructField(c, T.StringType()) for c in schemas.LINEAGE]
        empty = spark.createDataFrame([], T.StructType([*schemas.RECORD_SCHEMAS[e].fields, *lineage]))
        write_layer(empty, f"{lake_dir}/bronze", e)
    assert set(refresh.run_silver(spark, f"{lake_dir}/bronze", f"{lake_dir}/silver").values()) == {0}
    assert set(refresh.run_gold(spark, f"{lake_dir}/silver", f"{lake_dir}/gold").values()) == {0}
    for name, frame in dashboard_frames(spark, f"{lake_dir}/gold").items():
        assert frame.columns, name
        frame.collect()
    gold = refresh.load_gold(spark, f"{lake_dir}/gold")
    assert all(gold[n].schema == schemas.GOLD_SCHEMAS[n] for n in schemas.GOLD_TABLES)


def test_main_stops_the_session_on_failure(monkeypatch):
    stopped = []

    class FakeSession:
        def stop(self):
            stopped.append(True)

    import playlake.session as session_mod

    monkeypatch.setattr(session_mod, "job_session", lambda *a, **k: FakeSession())

    def boom(*args, **kwargs):
        raise RuntimeError("layer failed")

    monkeypatch.setattr(refresh, "full_refresh", boom)
    with pytest.raises(RuntimeError):
        refresh.main(["l", "b", "s", "g"])
    assert stopped == [True]
    assert refresh.main([]) == 2


def test_envelope_schema_wraps_record_schema():
    env = schemas.ENVELOPES[schemas.BY_DATE]
    assert env.names == ["ingestion_metadata", "records"]
    assert env["ingestion_metadata"].dataType.names == [
        "endpoint", "media_id", "ingest_timestamp", "ingest_date", "record_count"
    ]
    assert env["records"].dataType.elementType == schemas.RECORD_SCHEMAS[schemas.BY_DATE]
    assert "media_id" not in schemas.RECORD_SCHEMAS[schemas.EVENTS].names


def test_dashboard_frames_over_gold(spark):
    from playlake.plans import catalog
    from playlake.plans.dashboard import dashboard_frames

    frames = dashboard_frames(spark, catalog.gold_root(spark, SF_SMALL))
    assert list(frames) == [
        "kpi", "last_7_days", "last_30_days", "by_media", "daily_trends", "monthly", "top_visitors"
    ]
    kpi = frames["kpi"].collect()[0]
    assert kpi["total_plays"] == 466 and abs(kpi["total_watch_hours"] - 5.7712333) < 1e-6
    by_media = frames["by_media"].collect()
    assert all(r["avg_watched_percent"] is None or r["avg_watched_percent"] > 1 for r in by_media)
    assert "channel" in frames["daily_trends"].columns
    assert frames["top_visitors"].count() == 10


def test_counts_frame_types_and_empty(spark):
    df = refresh.counts_frame(spark, {"bronze": {"events": 3, "by_date": 2}})
    assert df.schema.simpleString() == "struct<layer:string,table_name:string,row_count:bigint>"
    assert sorted(tuple(r) for r in df.collect()) == [("bronze", "by_date", 2), ("bronze", "events", 3)]
    empty = refresh.counts_frame(spark, {})
    assert empty.schema.simpleString() == df.schema.simpleString() and empty.count() == 0
