"""Visitor bitmaps kept beside Gold, and Silver stored co-partitioned: the same rows as the plain
reports and the plain fact, with nulls, hot keys, no rows, failures and days that change."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lake_helpers import plan_text
from playlake.operators import gold, reach, reports
from playlake.plans import copartition
from playlake.plans import reach as kept_reach
from playlake.plans.refresh import publish_layer
from playlake.sources import published, schemas

FACT, DIM_MEDIA = schemas.FACT_MEDIA_ENGAGEMENT, schemas.DIM_MEDIA
FACT_SCHEMA = schemas.GOLD_SCHEMAS[FACT]
DIM = [("m0", "A youtube", None, "Youtube", None), ("hot", "B", None, "Unknown", None)]
EVENTS = (
    "event_key string, visitor_key string, media_id string, media_name string, media_url string, "
    "received_at timestamp, ip string, country string, percent_viewed double"
)
BY_DATE = "media_id string, date date, load_count bigint, play_count bigint, hours_watched double"


def _fact_rows(seed, days, rows=400):
    """Unique (media, visitor, day); a hot media, null keys and days, null means."""
    rng = random.Random(seed)
    found = {}
    for _ in range(rows):
        media = rng.choice(["hot", "hot", "m0", "m1", "m2", None])
        visitor = rng.choice([None, *[f"v{i}" for i in range(60)]])
        day = rng.choice([None, *days])
        found[media, visitor, day] = rng.choice([None, rng.random()])
    return [
        (m, v, d, rng.randrange(1, 5), w, 0.5, None if d is None else float(d.day))
        for (m, v, d), w in sorted(found.items(), key=str)
    ]


def _frame(spark, rows):
    columns = ["media_id", "visitor_id", "date", "play_count", "watched_percent", "play_rate", "total_watch_time"]
    types = {f.name: f.dataType.simpleString() for f in FACT_SCHEMA.fields}
    return spark.createDataFrame(rows, ", ".join(f"{c} {types[c]}" for c in columns)).select(*FACT_SCHEMA.names)


def _rows(df):
    cols = sorted(df.columns)
    return sorted(
        (tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in cols) for r in df.collect()), key=str
    )


def _dim(spark):
    return spark.createDataFrame(DIM, "media_id string, title string, url string, channel string, created_at timestamp")


def _same_reports(spark, root, fact, dim):
    got = kept_reach.reach_reports(spark, root, dim)
    want = {
        "kpi": reports.kpi_summary(fact),
        "by_media": reports.engagement_by_media(fact, dim),
        "monthly": reports.monthly_engagement(fact, dim),
        "last_7_days": reports.recent_engagement(fact, dim, 7),
        "last_30_days": reports.recent_engagement(fact, dim, 30),
    }
    assert set(got) == set(want)
    for name, df in want.items():
        found = got[name]()
        assert found.columns == df.columns, name
        assert [f.dataType for f in found.schema.fields] == [f.dataType for f in df.schema.fields], name
        assert _rows(found) == _rows(df), name


def _publish_by_day(spark, root, rows):
    """Gold's fact as ``plans.advance`` publishes it: by day, unchanged days taken over."""
    attempt = published.Attempt(spark, root, published.stamp())
    old = {p.part: p for p in attempt.base.parts_of(FACT)} if attempt.base else {}
    notes = dict(attempt.base.notes) if attempt.base else {}
    days = {}
    for r in rows:
        days.setdefault("__HIVE_DEFAULT_PARTITION__" if r[2] is None else str(r[2]), []).append(r)
    changed = [r for d, rs in days.items() if notes.get(d) != repr(rs) for r in rs]
    if changed:
        _frame(spark, changed).write.partitionBy("date").parquet(f"{attempt.path}/{attempt.folder(FACT)}")
    new = {p.part: p for p in attempt.written(FACT, by_part=True)} if changed else {}
    parts = [new.get(d) or old[d] for d in days]
    attempt.commit(parts, {}, notes={d: repr(rs) for d, rs in days.items()})
    return set(new)


def test_reports_from_bitmaps_match_the_plain_ones(spark, lake_dir):
    days = [dt.date(2024, 1, 20) + dt.timedelta(n) for n in range(0, 45, 3)]
    fact, dim = _frame(spark, _fact_rows(1, days)), _dim(spark)
    publish_layer(spark, f"{lake_dir}/gold", {FACT: fact}, {FACT: "date"})
    kept_reach.publish_reach(spark, f"{lake_dir}/gold", f"{lake_dir}/reach", part_visitors=7)
    _same_reports(spark, f"{lake_dir}/reach", fact, dim)
    # no visitor is exchanged twice for the distinct count, and none at all by a report
    for report in kept_reach.reach_reports(spark, f"{lake_dir}/reach", dim).values():
        text = plan_text(report())
        assert "Expand" not in text and "visitor_id" not in text
    numbers = kept_reach.load_reach(spark, f"{lake_dir}/reach")[kept_reach.NUMBERS]
    held = numbers.agg(F.count("*"), F.countDistinct("visitor_id"), F.countDistinct("part", "number")).first()
    assert len(set(held)) == 1 and numbers.select("part").distinct().count() > 1


def test_only_changed_days_are_counted_again(spark, lake_dir):
    days = [dt.date(2024, 3, 1) + dt.timedelta(n) for n in range(6)]
    rows = _fact_rows(2, days, 200)
    gold_root, root, dim = f"{lake_dir}/gold", f"{lake_dir}/reach", _dim(spark)
    _publish_by_day(spark, gold_root, rows)
    first = kept_reach.publish_reach(spark, gold_root, root)
    before = {r["visitor_id"]: (r["part"], r["number"]) for r in kept_reach.load_reach(spark, root)[kept_reach.NUMBERS].collect()}

    # one day gets other visitors, one is new, one goes
    late = [r for r in rows if r[2] != days[1]]
    late += [("hot", f"new{i}", days[2], 1, 0.1, 0.5, 3.0) for i in range(40)] + [("m9", "v1", dt.date(2024, 4, 2), 2, None, None, None)]
    touched = _publish_by_day(spark, gold_root, late)
    assert touched == {str(days[2]), "2024-04-02"}
    second = kept_reach.publish_reach(spark, gold_root, root, part_visitors=16)
    same = set(first.parts_of(kept_reach.BITS)) & set(second.parts_of(kept_reach.BITS))
    assert {p.part for p in second.parts_of(kept_reach.BITS)} - {p.part for p in same} == touched
    assert str(days[1]) not in {p.part for p in second.parts_of(kept_reach.DAYS)}
    after = {r["visitor_id"]: (r["part"], r["number"]) for r in kept_reach.load_reach(spark, root)[kept_reach.NUMBERS].collect()}
    assert {v: after[v] for v in before} == before and len(set(after.values())) == len(after) == len(before) + 40
    _same_reports(spark, root, _frame(spark, late), dim)
    assert kept_reach.publish_reach(spark, gold_root, root) == second  # nothing to do


def test_a_failed_publication_leaves_the_earlier_one(spark, lake_dir, monkeypatch):
    gold_root, root, dim = f"{lake_dir}/gold", f"{lake_dir}/reach", _dim(spark)
    rows = _fact_rows(3, [dt.date(2024, 5, 1), dt.date(2024, 5, 2)], 80)
    _publish_by_day(spark, gold_root, rows)
    kept_reach.publish_reach(spark, gold_root, root)
    more = [*rows, ("m5", "late", dt.date(2024, 5, 9), 1, 1.0, None, None)]
    _publish_by_day(spark, gold_root, more)
    with monkeypatch.context() as broken:
        broken.setattr(reach, "media_day_bits", lambda fact, numbers: fact.select(F.raise_error(F.lit("lost")).alias("date"), F.lit(1).alias("bits")))
        with pytest.raises(Exception):
            kept_reach.publish_reach(spark, gold_root, root)
    _same_reports(spark, root, _frame(spark, rows), dim)
    kept_reach.publish_reach(spark, gold_root, root)
    _same_reports(spark, root, _frame(spark, more), dim)


def test_reach_of_no_rows(spark, lake_dir):
    fact, dim = _frame(spark, []), _dim(spark)
    publish_layer(spark, f"{lake_dir}/gold", {FACT: fact}, {FACT: "date"})
    kept_reach.publish_reach(spark, f"{lake_dir}/gold", f"{lake_dir}/reach")
    _same_reports(spark, f"{lake_dir}/reach", fact, dim)


def test_numbers_cross_bitmap_ranges(spark):
    """More than 32,768 visitors of one part: several bitmaps a day, merged per range."""
    fact = spark.range(70_000).select(
        F.lit("m").alias("media_id"), F.concat(F.lit("v"), F.col("id") % 40_000).alias("visitor_id"),
        F.when(F.col("id") < 40_000, F.lit("2024-01-31")).otherwise(F.lit("2024-02-01")).cast("date").alias("date"),
        F.lit(1).cast("long").alias("play_count"), F.lit(0.5).alias("watched_percent"),
        F.lit(None).cast("double").alias("play_rate"), F.lit(2.0).alias("total_watch_time"),
    )
    known = kept_reach._empty(spark, kept_reach.NUMBERS)
    numbers = reach.number_visitors(reach.new_visitors(fact, known), known, 1)
    days, bits = reach.media_days(fact), reach.media_day_bits(fact, numbers)
    assert bits.count() == 4
    assert reach.kpi_summary(days, bits).first()["unique_visitors"] == 40_000
    months = {r["month"]: r["unique_visitors"] for r in reach.monthly_engagement(days, bits, _dim(spark)).collect()}
    assert months == {"2024-01": 40_000, "2024-02": 30_000}


def _silver(spark, root, n=700):
    rows = []
    for i in range(n):
        media = None if i % 29 == 0 else "hot" if i % 3 == 0 else f"m{i % 5}"
        at = None if i % 31 == 0 else dt.datetime(2024, 1, 1 if media == "hot" else 1 + i % 9, i % 24)
        rows.append((f"e{i}", None if i % 37 == 0 else f"v{i % 23}", media, "M", None, at, "ip", "US", None if i % 7 == 0 else i / n))
    daily = [(m, dt.date(2024, 1, d), d * 10, d * 3, float(d)) for m in ("hot", "m1", "m2") for d in range(1, 8)]
    daily += [(None, dt.date(2024, 1, 1), 1, 1, 1.0), ("m1", None, 1, 1, 1.0)]
    frames = {
        schemas.EVENTS: spark.createDataFrame(rows, EVENTS),
        schemas.BY_DATE: spark.createDataFrame(daily, BY_DATE),
    }
    publish_layer(spark, root, frames)
    return frames


def test_copartitioned_fact_exchanges_nothing(spark, lake_dir):
    silver = _silver(spark, f"{lake_dir}/silver")
    want = gold.to_fact_media_engagement(silver[schemas.EVENTS], silver[schemas.BY_DATE])
    copartition.store(spark, f"{lake_dir}/silver", f"{lake_dir}/by", buckets=12, salts=5)
    got = copartition.fact_from_stored(spark, f"{lake_dir}/by")
    text = plan_text(got)
    assert "Exchange" not in text and "SortMergeJoin" in text and "12 out of 12" in text
    assert got.columns == want.columns
    assert _rows(got) == _rows(want)
    # one media on one day is a third of all rows: it is dealt to several buckets, each file to one
    hot = copartition.stored(spark, f"{lake_dir}/by")[copartition.PLAYED].where("media_id = 'hot' AND date = '2024-01-01'")
    assert hot.select(F.input_file_name()).distinct().count() >= 3


def test_stored_sets_are_replaced_as_a_whole(spark, lake_dir, monkeypatch):
    small = _silver(spark, f"{lake_dir}/silver", 90)
    want = _rows(gold.to_fact_media_engagement(small[schemas.EVENTS], small[schemas.BY_DATE]))
    copartition.store(spark, f"{lake_dir}/silver", f"{lake_dir}/by", buckets=4)
    large = _silver(spark, f"{lake_dir}/silver", 200)
    with monkeypatch.context() as broken:
        broken.setattr(copartition, "daily_rows", lambda by_date, salts: by_date.select(F.raise_error(F.lit("lost")).alias("media_id"), "date", F.lit(0).alias("salt")))
        with pytest.raises(Exception):
            copartition.store(spark, f"{lake_dir}/silver", f"{lake_dir}/by", buckets=6)
    assert _rows(copartition.fact_from_stored(spark, f"{lake_dir}/by")) == want
    copartition.store(spark, f"{lake_dir}/silver", f"{lake_dir}/by", buckets=6, salts=1)
    got = copartition.fact_from_stored(spark, f"{lake_dir}/by")
    assert _rows(got) == _rows(gold.to_fact_media_engagement(large[schemas.EVENTS], large[schemas.BY_DATE]))


def test_nothing_stored(spark, lake_dir):
    publish_layer(
        spark, f"{lake_dir}/silver",
        {schemas.EVENTS: spark.createDataFrame([], EVENTS), schemas.BY_DATE: spark.createDataFrame([], BY_DATE)},
    )
    copartition.store(spark, f"{lake_dir}/silver", f"{lake_dir}/by", buckets=3)
    assert copartition.fact_from_stored(spark, f"{lake_dir}/by").count() == 0
    with pytest.raises(ValueError):
        copartition.stored(spark, f"{lake_dir}/none")
