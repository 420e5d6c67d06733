"""Published snapshots: a failed write leaves readers what was there, retries are later attempts, old ones go."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from playlake.plans import incremental as inc
from playlake.plans import refresh
from playlake.sources import published, schemas
from playlake.sources.layers import layer_reader, read_layer, write_layer

STAMP = "20240130T060000000000Z"


def _publish(spark, root, version, n, by=None):
    attempt = published.Attempt(spark, root, version)
    rows = write_layer(spark.range(n).withColumn("k", F.col("id") % 2), attempt.path, attempt.folder("t"), by)
    return attempt.commit(attempt.written("t", by_part=bool(by)), {"t": rows})


def _boom(df, column):
    """A frame that is planned as usual and fails in a task."""
    return df.withColumn(column, F.when(F.lit(True), F.raise_error(F.lit("injected")).cast(df.schema[column].dataType)))


def test_newest_commit_wins_and_before_excludes(spark, lake_dir):
    assert published.newest(spark, lake_dir) is None
    for version, n in (("v1", 1), ("v3", 3), ("v2", 2), ("v3", 4)):
        _publish(spark, lake_dir, version, n)
    found = published.newest(spark, lake_dir)
    assert (found.version, found.attempt, found.rows["t"]) == ("v3", 2, 4)
    assert read_layer(spark, lake_dir, "t").count() == 4
    assert published.newest(spark, lake_dir, before="v3").version == "v2"
    assert published.newest(spark, lake_dir, before="v1") is None


def test_parts_of_several_attempts_are_one_pruned_table(spark, lake_dir):
    from lake_helpers import plan_text

    first = _publish(spark, lake_dir, "v1", 4, by="k")
    attempt = published.Attempt(spark, lake_dir, "v2")
    write_layer(spark.sql("select 100L as id, 1L as k"), attempt.path, attempt.folder("t"), "k")
    new = attempt.written("t", by_part=True)
    kept = [p for p in first.parts if p.part not in {n.part for n in new}]
    attempt.commit([*kept, *new], {})
    table = read_layer(spark, lake_dir, "t")
    assert table.columns == ["id", "k"] and sorted(map(tuple, table.collect())) == [(0, 0), (2, 0), (100, 1)]
    only = table.where("k = 1")
    assert "PartitionFilters: [isnotnull(k" in plan_text(only) and only.count() == 1
    assert first.read(spark, "t").count() == 4  # the earlier snapshot is as it was


def test_failed_write_leaves_the_layer_readable(spark, lake_dir):
    root = f"{lake_dir}/gold"
    frames = {"a": spark.range(3).withColumn("x", F.lit(1)), "b": spark.range(5).withColumn("x", F.lit(2))}
    assert refresh.publish_layer(spark, root, frames) == {"a": 3, "b": 5}
    for broken in ({"a": spark.range(9).withColumn("x", F.lit(9)), "b": _boom(frames["b"], "x")}, {"a": _boom(frames["a"], "x")}):
        with pytest.raises(Exception, match="injected"):
            refresh.publish_layer(spark, root, broken)
        assert (read_layer(spark, root, "a").count(), read_layer(spark, root, "b").count()) == (3, 5)
    assert refresh.publish_layer(spark, root, {"a": spark.range(9), "b": frames["b"]}) == {"a": 9, "b": 5}
    assert read_layer(spark, root, "a").count() == 9


def test_a_reader_keeps_its_snapshot(spark, lake_dir):
    refresh.publish_layer(spark, lake_dir, {"a": spark.range(3), "b": spark.range(3)})
    read = layer_reader(spark, lake_dir)
    a = read("a")
    refresh.publish_layer(spark, lake_dir, {"a": spark.range(7), "b": spark.range(7)})
    assert (a.count(), read("b").count(), read_layer(spark, lake_dir, "b").count()) == (3, 3, 7)


def test_expire_removes_old_commits_and_unfinished_attempts(spark, lake_dir):
    first = _publish(spark, lake_dir, "v1", 4, by="k")
    attempt = published.Attempt(spark, lake_dir, "v2")
    write_layer(spark.sql("select 9L as id, 1L as k"), attempt.path, attempt.folder("t"), "k")
    attempt.commit([*first.parts_of("t", ["0"]), *attempt.written("t", by_part=True)], {})
    unfinished = published.Attempt(spark, lake_dir, "v3")
    write_layer(spark.range(2), unfinished.path, unfinished.folder("t"))
    assert published.expire(spark, lake_dir, keep=1) == []  # nothing is that old
    assert published.expire(spark, lake_dir, keep=1, older_than=dt.timedelta(0)) == [first.id]
    left = os.listdir(f"{lake_dir}/{published.DATA}".removeprefix("file:"))
    assert sorted(left) == sorted(f"attempt={i}" for i in (first.id, attempt.id))  # the first still lends a part
    assert sorted(r["id"] for r in read_layer(spark, lake_dir, "t").collect()) == [0, 2, 9]


# --- the incremental load's state --------------------------------------------


def _state(spark, *marks):
    rows = [("events", m, dt.datetime(2024, 1, d), None) for m, d in marks]
    return spark.createDataFrame(rows, inc.STATE_SCHEMA)


def test_failed_retry_of_a_state_version(spark, lake_dir):
    """A second attempt of the newest version that fails while writing leaves the first one in place."""
    inc.save_state(_state(spark, ("m1", 20)), lake_dir, "v1")
    inc.save_state(_state(spark, ("m1", 21)), lake_dir, "v2")
    before = inc.read_state(spark, lake_dir).collect()
    with pytest.raises(Exception, match="injected"):
        inc.save_state(_boom(_state(spark, ("m1", 25)), "watermark_ts"), lake_dir, "v2")
    assert inc.read_state(spark, lake_dir).collect() == before
    inc.save_state(_state(spark, ("m1", 26)), lake_dir, "v2")
    assert inc.read_state(spark, lake_dir).first()["watermark_ts"] == dt.datetime(2024, 1, 26)
    assert inc.read_state(spark, lake_dir, before="v2").first()["watermark_ts"] == dt.datetime(2024, 1, 20)


@pytest.mark.parametrize("step", ["write_state", "summarize", "build_envelopes", "commit"])
def test_failed_retry_of_a_load(spark, lake_dir, monkeypatch, step):
    """Whatever step of a retried run fails, the state and the next run's pulls are as if it had not been tried."""
    from test_incremental import CLOCK, ev, media, sources

    landing, state_root = f"{lake_dir}/landing", f"{lake_dir}/state"
    src = sources(spark, [ev("m1", "2024-01-25T10:00:00Z", "a")], by_date=[("m1", "2024-01-30", 3, 1, 0.1)])
    first = inc.run_load(spark, src, media(spark, "m1"), landing, state_root, CLOCK).collect()
    state = sorted(inc.read_state(spark, state_root).collect())

    def fail(*args, **kwargs):
        raise RuntimeError("injected")

    with monkeypatch.context() as broken:
        broken.setattr(published.Attempt if step == "commit" else inc, step, fail)
        with pytest.raises(RuntimeError, match="injected"):
            inc.run_load(spark, src, media(spark, "m1"), landing, state_root, CLOCK)
    assert sorted(inc.read_state(spark, state_root).collect()) == state
    assert inc.run_load(spark, src, media(spark, "m1"), landing, state_root, CLOCK).collect() == first
    assert sorted(inc.read_state(spark, state_root).collect()) == state
    assert published.newest(spark, state_root).attempt == 2


def test_gold_tables_after_a_failed_run(spark, lake_dir):
    silver, gold = f"{lake_dir}/silver", f"{lake_dir}/gold"
    rows = {
        schemas.EVENTS: "select 'e' event_key, 'v' visitor_key, 'm' media_id, 'n' media_name, 'u' media_url, "
        "timestamp'2024-01-05 01:00:00' received_at, 'i' ip, 'c' country, 0.5D percent_viewed",
        schemas.BY_DATE: "select 'm' media_id, date'2024-01-05' date, 4L load_count, 2L play_count, 1.5D hours_watched",
        schemas.MEDIA_METADATA: "select 'm' media_id, 'youtube' name, timestamp'2024-01-01 00:00:00' created",
    }
    refresh.publish_layer(spark, silver, {e: spark.sql(q) for e, q in rows.items()})
    refresh.run_gold(spark, silver, gold)
    want = {n: df.collect() for n, df in refresh.load_gold(spark, gold).items()}
    broken = {e: spark.sql(q) for e, q in rows.items()}
    broken[schemas.BY_DATE] = _boom(broken[schemas.BY_DATE], "hours_watched")
    refresh.publish_layer(spark, f"{lake_dir}/broken", {e: df for e, df in broken.items() if e != schemas.BY_DATE})
    with pytest.raises(Exception):  # Silver without one of its tables
        refresh.run_gold(spark, f"{lake_dir}/broken", gold)
    assert {n: df.collect() for n, df in refresh.load_gold(spark, gold).items()} == want
