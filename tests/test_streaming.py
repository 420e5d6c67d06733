"""Landing -> Bronze as an availableNow stream: incremental and equal to batch."""

from pyspark.sql import functions as F

from playlake.operators.bronze import to_bronze
from playlake.sources import eventmap, schemas
from playlake.sources.landing import build_envelopes, read_landing, write_landing
from playlake.sources.layers import read_layer
from playlake.streaming.bronze_stream import stream_bronze

from lake_helpers import SF_SMALL


def test_stream_reads_only_new_files_and_matches_batch(spark, lake_dir):
    landing, bronze = f"{lake_dir}/landing", f"{lake_dir}/bronze"
    ev = eventmap.read_events(spark, SF_SMALL)
    raw = eventmap.raw_bronze(ev, schemas.EVENTS)
    first = raw.where(raw.ingest_timestamp == eventmap.RUN_STAMPS[1])
    second = raw.where(raw.ingest_timestamp == eventmap.RUN_STAMPS[2])
    write_landing(build_envelopes(first, schemas.EVENTS), schemas.EVENTS, landing)
    for e in (schemas.BY_DATE, schemas.MEDIA_METADATA):
        write_landing(build_envelopes(eventmap.raw_bronze(ev, e), e), e, landing)

    consumed = stream_bronze(spark, landing, bronze)
    assert consumed[schemas.EVENTS] > 0
    assert read_layer(spark, bronze, schemas.EVENTS).count() == first.count()

    write_landing(build_envelopes(second, schemas.EVENTS), schemas.EVENTS, landing)
    again = stream_bronze(spark, landing, bronze)
    assert again[schemas.BY_DATE] == 0 and again[schemas.MEDIA_METADATA] == 0
    streamed = read_layer(spark, bronze, schemas.EVENTS)
    batch = to_bronze(read_landing(spark, schemas.EVENTS, landing))
    assert streamed.count() == raw.count()
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_counts_all_batches(spark, lake_dir):
    """More micro-batches than the session remembers progress of: the count is still whole."""
    ev = eventmap.read_events(spark, SF_SMALL)
    for e in schemas.ENDPOINTS:
        raw = eventmap.raw_bronze(ev, e).where("media_id in ('m1', 'm2', 'm3', 'm4', 'm5', 'm6')")
        write_landing(build_envelopes(raw, e, max_records=50), e, f"{lake_dir}/landing")
    key = "spark.sql.streaming.numRecentProgressUpdates"
    spark.conf.set(key, "2")
    try:
        consumed = stream_bronze(spark, f"{lake_dir}/landing", f"{lake_dir}/bronze", max_files_per_trigger=4)
    finally:
        spark.conf.unset(key)
    for e in schemas.ENDPOINTS:
        assert consumed[e] == read_landing(spark, e, f"{lake_dir}/landing").count()
    assert consumed[schemas.EVENTS] > 8


def test_a_batch_is_kept_while_its_endpoints_are_upserted(spark, lake_dir, monkeypatch):
    """Its files are parsed once, not once for each endpoint."""
    from playlake.streaming import lake_stream

    row = ("2024-01-01T00:00:00Z", "e1", "v1", "m1", "2024-02-01T06:00:00+00:00", "2024-02-01", schemas.EVENTS)
    names = ["received_at", "event_key", "visitor_key", "media_id", "ingest_timestamp", "ingest_date", "__endpoint"]
    columns = dict.fromkeys(f for e in schemas.ENDPOINTS for f in schemas.bronze_columns(e))
    kinds = {f.name: f.dataType for e in schemas.ENDPOINTS for f in schemas.RECORD_SCHEMAS[e].fields}
    batch = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
    batch = batch.select("*", *(F.lit(None).cast(kinds.get(c, "string")).alias(c) for c in columns if c not in names))
    kept, advance_silver = [], lake_stream.advance_silver

    def seen(*args):
        kept.append(batch.storageLevel.useMemory)
        return advance_silver(*args)

    monkeypatch.setattr(lake_stream, "advance_silver", seen)
    lake_stream.take_batch(batch, 0, f"{lake_dir}/silver", f"{lake_dir}/gold", 2)
    assert kept == [True] and not batch.storageLevel.useMemory
    lake_stream.take_batch(batch, 0, f"{lake_dir}/silver", f"{lake_dir}/gold", 2)  # published before
    assert kept == [True]
