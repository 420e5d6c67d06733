"""Every dashboard report over a Gold root, as lazy DataFrames.

The frames the engagement dashboard shows, in its order: headline KPIs, the
last 7 and 30 days, engagement by media, daily trends with channel, monthly
engagement and top visitors. Tables show ``avg_watched_percent`` as a
percentage (0..100); the KPI row and the trends keep raw values. Nothing is
collected here; a caller displays or writes each frame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from playlake.operators import reports
from playlake.plans.refresh import load_gold
from playlake.session import use_utc
from playlake.sources import schemas

# The dashboard's windows and leaderboard size.
RECENT_WINDOWS = (7, 30)
TOP_VISITORS = 10


def dashboard_frames(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    use_utc(spark)
    gold = load_gold(spark, gold_root)
    fact = gold[schemas.FACT_MEDIA_ENGAGEMENT]
    dim_media = gold[schemas.DIM_MEDIA]
    dim_visitor = gold[schemas.DIM_VISITOR]
    frames: dict[str, DataFrame] = {"kpi": reports.kpi_summary(fact)}
    for days in RECENT_WINDOWS:
        frames[f"last_{days}_days"] = reports.in_percent(
            reports.recent_engagement(fact, dim_media, days)
        )
    frames["by_media"] = reports.in_percent(reports.engagement_by_media(fact, dim_media))
    frames["daily_trends"] = reports.daily_trends(fact, dim_media)
    frames["monthly"] = reports.in_percent(reports.monthly_engagement(fact, dim_media))
    frames["top_visitors"] = reports.in_percent(reports.top_visitors(fact, dim_visitor, TOP_VISITORS))
    return frames
