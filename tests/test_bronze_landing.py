"""Bronze flatten, landing sink (envelopes, chunks, empty pulls) and scan."""

import json
import os

from pyspark.sql import functions as F

from lake_helpers import plan_text
from playlake.operators.bronze import to_bronze
from playlake.sources import schemas
from playlake.sources.landing import build_envelopes, read_landing, write_landing
from playlake.sources.paths import layer_path

RUN1 = "2024-02-01T06:00:00+00:00"


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def envelope(endpoint, media, records, stamp=RUN1):
    return {
        "ingestion_metadata": {
            "endpoint": endpoint, "media_id": media, "ingest_timestamp": stamp,
            "ingest_date": stamp[:10], "record_count": len(records),
        },
        "records": records,
    }


def write_json(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def test_flatten_explodes_with_lineage(spark):
    env = spark.createDataFrame(
        [envelope("by_date", "m1", [{"date": "2024-01-01", "load_count": 3, "play_count": 1, "hours_watched": 0.5},
                                    {"date": "2024-01-02", "load_count": 4, "play_count": 2, "hours_watched": 0.0}])],
        schemas.ENVELOPES[schemas.BY_DATE],
    )
    out = to_bronze(env).collect()
    assert len(out) == 2
    assert out[0].asDict() == {
        "date": "2024-01-01", "load_count": 3, "play_count": 1, "hours_watched": 0.5,
        "ingest_timestamp": RUN1, "ingest_date": "2024-02-01", "media_id": "m1",
    }


def test_empty_and_null_record_arrays_give_no_rows(spark):
    env = spark.createDataFrame(
        [envelope("events", "m1", []), {"ingestion_metadata": envelope("events", "m2", [])["ingestion_metadata"], "records": None}],
        schemas.ENVELOPES[schemas.EVENTS],
    )
    assert to_bronze(env).count() == 0


def test_read_pretty_printed_envelopes_and_bad_inputs(spark, lake_dir):
    root = _local(lake_dir)
    folder = os.path.join(root, "events", "media_id=m1", "ingest_date=2024-02-01")
    rec = {"received_at": "2024-01-01T00:00:00.000Z", "event_key": "e1", "ip": "1", "country": "US",
           "percent_viewed": 0.5, "conversion_type": "", "visitor_key": "v1", "media_name": "M",
           "media_url": "u", "user_agent_details": {"browser": "x"}, "email": None}
    write_json(folder, "data_a.json", json.dumps(envelope("events", "m1", [rec]), indent=2))
    # A mistyped field becomes null while the rest of the record survives.
    bad_type = dict(rec, event_key="e2", percent_viewed="lots")
    write_json(folder, "data_b.json", json.dumps(envelope("events", "m1", [bad_type]), indent=2))
    # A null array element yields a lineage-only row.
    write_json(folder, "data_c.json", json.dumps(envelope("events", "m1", [None]), indent=2))
    # A truncated file yields no Bronze row.
    write_json(folder, "data_d.json", json.dumps(envelope("events", "m1", [rec]))[:40])
    rows = to_bronze(read_landing(spark, "events", lake_dir)).collect()
    by_key = {r["event_key"]: r for r in rows}
    assert set(by_key) == {"e1", "e2", None}
    assert by_key["e1"]["percent_viewed"] == 0.5 and by_key["e1"]["media_id"] == "m1"
    assert by_key["e2"]["percent_viewed"] is None and by_key["e2"]["ip"] == "1"
    assert by_key[None]["ingest_timestamp"] == RUN1 and by_key[None]["received_at"] is None
    # Undeclared nested fields are not in the schema.
    assert "user_agent_details" not in rows[0].asDict()


def _raw_events(spark, media_counts):
    rows = []
    for media, n in media_counts.items():
        for i in range(n):
            rows.append((f"2024-01-01T00:00:{i % 60:02d}.000Z", f"{media}-e{i}", "ip", "US", 0.1, "",
                         f"v{i % 7}", "M", "u", RUN1, RUN1[:10], media))
    schema = (
        "received_at string, event_key string, ip string, country string, percent_viewed double, "
        "conversion_type string, visitor_key string, media_name string, media_url string, "
        "ingest_timestamp string, ingest_date string, media_id string"
    )
    return spark.createDataFrame(rows, schema)


def test_envelopes_are_chunked_and_keep_every_record(spark):
    raw = _raw_events(spark, {"hot": 1000, "cold": 3})
    env = build_envelopes(raw, schemas.EVENTS, max_records=100).select(
        "ingestion_metadata.media_id", "ingestion_metadata.record_count", F.size("records").alias("n")
    )
    rows = env.collect()
    hot = [r for r in rows if r["media_id"] == "hot"]
    cold = [r for r in rows if r["media_id"] == "cold"]
    assert sum(r["n"] for r in hot) == 1000 and len(hot) == 10
    assert all(r["record_count"] == r["n"] for r in rows)
    assert max(r["n"] for r in hot) < 200  # a hash spread, not one giant envelope
    assert len(cold) == 1 and cold[0]["n"] == 3


def test_records_are_collected_only_after_the_exchange(spark):
    raw = _raw_events(spark, {"hot": 50, "cold": 3})
    lines = plan_text(build_envelopes(raw, schemas.EVENTS), "simple").splitlines()
    partial = [i for i, line in enumerate(lines) if "partial_collect_list" in line]
    exchange = [i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line and "__chunk" in line]
    # One partial collect, printed above (so run after) the shuffle of flat rows.
    assert len(partial) == 1 and len(exchange) == 1 and partial[0] < exchange[0]


def test_identical_records_still_spread(spark):
    raw = _raw_events(spark, {"hot": 1}).unionByName(_raw_events(spark, {"hot": 1}))
    for _ in range(6):
        raw = raw.unionByName(raw)
    raw = raw.repartition(8)
    env = build_envelopes(raw, schemas.EVENTS, max_records=16)
    sizes = [r["n"] for r in env.select(F.size("records").alias("n")).collect()]
    assert sum(sizes) == 128 and len(sizes) > 1


def test_empty_pull_still_lands(spark, lake_dir):
    raw = _raw_events(spark, {"m1": 2})
    pulls = spark.createDataFrame(
        [("m1", RUN1, RUN1[:10]), ("m2", RUN1, RUN1[:10])], "media_id string, ingest_timestamp string, ingest_date string"
    )
    write_landing(build_envelopes(raw, schemas.EVENTS, pulls=pulls), schemas.EVENTS, lake_dir)
    env = read_landing(spark, schemas.EVENTS, lake_dir)
    heads = {r["media_id"]: r["record_count"] for r in env.select("ingestion_metadata.*").collect()}
    assert heads == {"m1": 2, "m2": 0}
    assert to_bronze(env).count() == 2
    layout = os.listdir(os.path.join(_local(layer_path(lake_dir, "events")), "media_id=m2"))
    assert layout == ["ingest_date=2024-02-01"]


def test_a_pull_with_a_null_key_is_split_like_any_other(spark):
    raw = _raw_events(spark, {"hot": 100}).withColumn("ingest_date", F.lit(None).cast("string"))
    pulls = raw.select("media_id", "ingest_timestamp", "ingest_date").distinct()
    sizes = [r["n"] for r in build_envelopes(raw, schemas.EVENTS, pulls=pulls, max_records=10).select(F.size("records").alias("n")).collect()]
    assert sum(sizes) == 100 and len(sizes) == 10 and min(sizes) > 0  # and no false empty pull


def test_records_land_whole_and_uncast(spark, lake_dir):
    """Undeclared, nested and mistyped fields are in the files; a scan takes what it declares."""
    from pyspark.sql import types as T

    raw = spark.sql(
        """SELECT 'm1' media_id, '2024-02-01T06:00:00+00:00' ingest_timestamp, '2024-02-01' ingest_date, '2024-01-01' date,
                  parse_json(v) load_count, named_struct('a', map('k', 1)) nested, 'Oslo' city
           FROM VALUES ('"lots"'), ('7') AS t(v)"""
    )
    write_landing(build_envelopes(raw, schemas.BY_DATE), schemas.BY_DATE, lake_dir)
    rows = to_bronze(read_landing(spark, schemas.BY_DATE, lake_dir)).collect()
    assert sorted((r["date"], r["load_count"]) for r in rows if r["load_count"]) == [("2024-01-01", 7)]
    assert [r["load_count"] for r in rows].count(None) == 1
    wide = T.StructType(
        [T.StructField("load_count", T.StringType()), T.StructField("city", T.StringType()),
         T.StructField("nested", T.StructType([T.StructField("a", T.MapType(T.StringType(), T.LongType()))]))]
    )
    whole = to_bronze(read_landing(spark, schemas.BY_DATE, lake_dir, wide)).collect()
    assert sorted(r["load_count"] for r in whole) == ["7", "lots"]
    assert {(r["city"], r["nested"]["a"]["k"]) for r in whole} == {("Oslo", 1)}


def test_landing_is_append_only_same_day_runs_kept(spark, lake_dir):
    raw = _raw_events(spark, {"m1": 5})
    for _ in range(2):
        write_landing(build_envelopes(raw, schemas.EVENTS), schemas.EVENTS, lake_dir)
    assert to_bronze(read_landing(spark, schemas.EVENTS, lake_dir)).count() == 10


def test_one_envelope_per_file_so_multiline_scan_reads_all(spark, lake_dir):
    raw = _raw_events(spark, {"m1": 500})
    write_landing(build_envelopes(raw, schemas.EVENTS, max_records=50), schemas.EVENTS, lake_dir)
    assert to_bronze(read_landing(spark, schemas.EVENTS, lake_dir)).count() == 500


def test_layer_path_single_slash():
    assert layer_path("s3://bucket/lake/", "/events") == "s3://bucket/lake/events"
    assert layer_path("/tmp/lake", "gold/") == "/tmp/lake/gold"


def test_identical_records_spread_under_sort_merge_join(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        test_identical_records_still_spread(spark)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_records_of_a_null_pull_key_are_kept(spark):
    raw = _raw_events(spark, {"m1": 3}).unionByName(
        _raw_events(spark, {"m2": 2}).withColumn("media_id", F.lit(None).cast("string"))
    )
    env = build_envelopes(raw, schemas.EVENTS, max_records=2)
    assert to_bronze(env).count() == 5


def test_records_of_a_run_are_exchanged_once(spark, lake_dir):
    """Also with keys that are constant in the run, and whatever pulls are split: collected after the one exchange."""
    raw = _raw_events(spark, {"hot": 50, "cold": 3}).withColumns({"ingest_timestamp": F.lit(RUN1), "ingest_date": F.lit(RUN1[:10])})
    lines = plan_text(build_envelopes(raw, schemas.EVENTS), "simple").splitlines()
    partial = [i for i, line in enumerate(lines) if "partial_collect_list" in line]
    exchanges = [i for i, line in enumerate(lines) if "Exchange" in line and i > partial[0] and "BroadcastExchange" not in line]
    of_records = [i for i in exchanges if "__chunk" in lines[i]]
    assert len(partial) == 1 and len(of_records) == 1
    assert not any("Exchange hashpartitioning" in line for line in lines[: partial[0]])
    assert any("BroadcastHashJoin" in line for line in lines) and not any("SortMergeJoin" in line for line in lines)
    write_landing(build_envelopes(raw, schemas.EVENTS), schemas.EVENTS, lake_dir)
    files = read_landing(spark, schemas.EVENTS, lake_dir).inputFiles()
    assert len(files) == 2 and all(f.endswith(".json.gz") for f in files)
    assert to_bronze(read_landing(spark, schemas.EVENTS, lake_dir)).count() == 53
