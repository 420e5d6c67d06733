"""Reports over Gold: KPI, by media, trends, monthly, recent window, top visitors."""

import datetime as dt

import pytest

from lake_helpers import plan_text
from playlake.operators import reports

FACT = (
    "media_id string, visitor_id string, date date, play_count bigint, "
    "watched_percent double, play_rate double, total_watch_time double"
)
DIM_MEDIA = "media_id string, title string, url string, channel string, created_at timestamp"
DIM_VISITOR = "visitor_id string, ip_address string, country string"


def d(day, month=1):
    return dt.date(2024, month, day)


@pytest.fixture()
def fact(spark):
    return spark.createDataFrame(
        [
            ("m1", "v1", d(1), 2, 0.5, 0.8, 1.5),
            ("m1", "v2", d(1), 1, 0.1, 0.8, 1.5),  # same media-day: 1.5 counted once
            ("m2", "v1", d(2), 3, 0.3, 0.5, 0.9),
            ("m2", "v3", None, 4, 0.7, None, None),  # null day: counted in plays only
        ],
        FACT,
    )


@pytest.fixture()
def dim_media(spark):
    return spark.createDataFrame(
        [("m1", "One", "u1", "Youtube", None), ("m2", "Two", None, "Facebook", None)], DIM_MEDIA
    )


def test_kpi_dedupes_watch_time_per_media_day(spark, fact):
    row = reports.kpi_summary(fact).collect()[0]
    assert row["total_plays"] == 10
    assert row["unique_visitors"] == 3
    assert abs(row["avg_watched_percent"] - (0.5 + 0.1 + 0.3 + 0.7) / 4) < 1e-12
    assert abs(row["total_watch_hours"] - (1.5 + 0.9)) < 1e-12


def test_kpi_on_empty_fact(spark):
    row = reports.kpi_summary(spark.createDataFrame([], FACT)).collect()[0]
    assert row["total_plays"] == 0 and row["unique_visitors"] == 0
    assert row["avg_watched_percent"] is None and row["total_watch_hours"] == 0.0


def test_engagement_by_media_with_labels(spark, fact, dim_media):
    out = {r["media_id"]: r for r in reports.engagement_by_media(fact, dim_media).collect()}
    assert out["m1"]["plays"] == 3 and out["m1"]["unique_visitors"] == 2
    assert abs(out["m1"]["avg_watched_percent"] - 0.3) < 1e-12
    assert out["m2"]["plays"] == 7 and out["m2"]["title"] == "Two"
    assert out["m2"]["channel"] == "Facebook"


def test_media_missing_from_dim_gets_null_labels(spark, fact):
    dim = spark.createDataFrame([("m1", "One", "u1", "Youtube", None)], DIM_MEDIA)
    out = {r["media_id"]: r for r in reports.engagement_by_media(fact, dim).collect()}
    assert out["m2"]["title"] is None and out["m2"]["channel"] is None


def test_daily_trends_global_grid_and_fill(spark, fact):
    out = reports.daily_trends(fact).collect()
    assert [(r["media_id"], r["date"]) for r in out] == [
        ("m1", d(1)), ("m1", d(2)), ("m2", d(1)), ("m2", d(2))
    ]
    m1_day2 = out[1]
    assert m1_day2["plays"] == 0 and m1_day2["play_rate"] is None
    assert m1_day2["total_watch_time"] is None
    assert out[0]["plays"] == 3 and out[0]["play_rate"] == 0.8


def test_daily_trends_channel_and_empty(spark, fact, dim_media):
    out = reports.daily_trends(fact, dim_media).collect()
    assert {r["media_id"]: r["channel"] for r in out} == {"m1": "Youtube", "m2": "Facebook"}
    empty = reports.daily_trends(spark.createDataFrame([], FACT))
    assert empty.count() == 0
    assert empty.columns == ["media_id", "date", "plays", "play_rate", "total_watch_time"]


def test_daily_trends_grid_has_no_join_for_bounds(spark, fact):
    plan = plan_text(reports.daily_trends(fact))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Subquery" in plan


def test_monthly_key_and_null_days_dropped(spark, dim_media):
    fact = spark.createDataFrame(
        [("m1", "v1", d(31, 1), 1, 0.2, None, None), ("m1", "v1", d(1, 2), 2, 0.4, None, None),
         ("m1", "v2", d(2, 2), 1, 0.6, None, None), ("m1", "v3", None, 5, 0.9, None, None)],
        FACT,
    )
    out = {r["month"]: r for r in reports.monthly_engagement(fact, dim_media).collect()}
    assert set(out) == {"2024-01", "2024-02"}
    assert out["2024-02"]["plays"] == 3 and out["2024-02"]["unique_visitors"] == 2
    assert out["2024-02"]["title"] == "One"


def test_recent_window_anchored_on_newest_day_inclusive(spark, fact, dim_media):
    one = reports.recent_engagement(fact, dim_media, 1).collect()
    assert [(r["media_id"], r["plays"], r["active_days"]) for r in one] == [("m2", 3, 1)]
    two = {r["media_id"]: r for r in reports.recent_engagement(fact, dim_media, 2).collect()}
    assert set(two) == {"m1", "m2"} and two["m1"]["unique_visitors"] == 2
    assert reports.recent_engagement(fact, dim_media, 2).columns == list(reports.RECENT_COLUMNS)


def test_recent_on_empty_keeps_schema(spark, dim_media):
    out = reports.recent_engagement(spark.createDataFrame([], FACT), dim_media, 7)
    assert out.count() == 0 and out.columns == list(reports.RECENT_COLUMNS)


def test_top_visitors_rank_limit_and_country(spark, fact):
    dim = spark.createDataFrame([("v1", "ip", "US"), ("v2", "ip", "DE")], DIM_VISITOR)
    out = reports.top_visitors(fact, dim, 2).collect()
    assert [(r["visitor_id"], r["plays"], r["country"]) for r in out] == [
        ("v1", 5, "US"), ("v3", 4, None)
    ]
    assert out[0].asDict().keys() == {"visitor_id", "plays", "avg_watched_percent", "country"}


def test_top_visitors_ties_by_id(spark):
    fact = spark.createDataFrame(
        [("m1", f"v{i}", d(1), 1, 0.1, None, None) for i in (3, 1, 2)], FACT
    )
    dim = spark.createDataFrame([], DIM_VISITOR)
    assert [r["visitor_id"] for r in reports.top_visitors(fact, dim, 2).collect()] == ["v1", "v2"]


def test_top_visitors_limits_before_join_and_streams_dim(spark, fact):
    dim = spark.createDataFrame([("v1", "ip", "US")], DIM_VISITOR)
    plan = plan_text(reports.top_visitors(fact, dim, 10))
    assert "TakeOrderedAndProject" in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_top_visitors_aggregates_the_fact_once(spark, fact):
    dim = spark.createDataFrame([("v1", "ip", "US")], DIM_VISITOR)
    out = reports.top_visitors(fact, dim, 10)
    out.collect()
    # The outer final plan ends where the outer (unindented) initial plan starts.
    plan = plan_text(out, "simple").split("\n+- == Initial Plan ==")[0]
    # Both uses of the ranking (the ids that filter the dimension, the result
    # rows) are one subquery; nothing stays cached.
    assert "ReusedSubquery" in plan and "InMemoryTableScan" not in plan
    assert plan.count("TakeOrderedAndProject") <= 2  # in the subquery's own final and initial plan


def test_top_visitors_sees_a_rewritten_fact(spark, lake_dir):
    dim = spark.createDataFrame([("v1", "ip", "US"), ("v2", "ip", "DE")], DIM_VISITOR)
    for visitor in ("v1", "v2"):
        spark.createDataFrame([("m1", visitor, d(1), 1, 0.1, None, None)], FACT).write.mode("overwrite").parquet(f"{lake_dir}/f")
        out = reports.top_visitors(spark.read.parquet(f"{lake_dir}/f"), dim, 10).collect()
        assert [r["visitor_id"] for r in out] == [visitor]
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


@pytest.mark.parametrize("rows", [[], [("m1", "v1", None, 1, 0.1, None, None)]])
def test_reports_of_a_fact_without_days(spark, lake_dir, rows):
    """Gold without events, and with null days only, read back through the layer."""
    from playlake.plans.refresh import GOLD_PARTITIONING, load_gold
    from playlake.sources import schemas
    from playlake.sources.layers import write_layer
    from playlake.plans.dashboard import dashboard_frames

    for name in schemas.GOLD_TABLES:
        data = rows if name == schemas.FACT_MEDIA_ENGAGEMENT else []
        write_layer(spark.createDataFrame(data, schemas.GOLD_SCHEMAS[name]), lake_dir, name, GOLD_PARTITIONING.get(name))
    gold = load_gold(spark, lake_dir)
    fact = gold[schemas.FACT_MEDIA_ENGAGEMENT]
    assert fact.schema == schemas.GOLD_SCHEMAS[schemas.FACT_MEDIA_ENGAGEMENT] and fact.count() == len(rows)
    frames = dashboard_frames(spark, lake_dir)
    counts = {name: frame.count() for name, frame in frames.items()}
    assert reports.daily_trends(fact, gold[schemas.DIM_MEDIA]).collect() == []
    assert reports.monthly_engagement(fact, gold[schemas.DIM_MEDIA]).collect() == []
    assert reports.kpi_summary(fact).first()["total_plays"] == len(rows)
    assert counts


def test_in_percent(spark, fact, dim_media):
    base = reports.engagement_by_media(fact, dim_media)
    pct = {r["media_id"]: r["avg_watched_percent"] for r in reports.in_percent(base).collect()}
    assert abs(pct["m1"] - 30.0) < 1e-9


def test_plan_summary_counts_a_cached_relation_once(spark, fact):
    import os
    import re
    import sys

    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
    from plan_summary import final_plan

    dim = spark.createDataFrame([("v1", "ip", "US")], DIM_VISITOR)
    out = reports.top_visitors(fact, dim, 10)
    out.collect()
    text = final_plan(plan_text(out, "simple"))
    assert len(re.findall(r"TakeOrderedAndProject", text)) == 1
    assert "== Initial Plan ==" not in text
