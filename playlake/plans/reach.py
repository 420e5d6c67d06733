"""Visitor numbers, media-days and their bitmaps, published beside Gold and kept up by what changed.

``publish_reach`` reads the newest Gold snapshot. Gold's fact is published by day where it
is advanced (``plans.advance``): days whose folder is the one that the last reach snapshot
was made from are taken over, only the others are read and counted again. Gold that was
published as a whole is read as a whole. Numbers that were given stay, so the bitmaps of
old and new days merge.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlake.operators import reach
from playlake.plans.concurrent import run_all
from playlake.session import use_utc
from playlake.sources import published, schemas
from playlake.sources.layers import write_layer

NUMBERS, DAYS, BITS = "visitor_number", "media_day", "media_day_bits"
TABLES = {NUMBERS: reach.NUMBER_SCHEMA, DAYS: reach.DAY_SCHEMA, BITS: reach.BITS_SCHEMA}


def publish_reach(
    spark: SparkSession, gold_root: str, root: str, part_visitors: int = reach.PART_VISITORS
) -> published.Snapshot:
    """Bring the reach tables of ``root`` to the newest Gold snapshot; nothing to do is not an error."""
    use_utc(spark)
    gold = published.newest(spark, gold_root)
    if gold is None:
        raise ValueError(f"{gold_root} has no published Gold")
    base = published.newest(spark, root)
    if base is not None and base.source == gold.id:
        return base

    now = {p.part: p.path for p in gold.parts_of(schemas.FACT_MEDIA_ENGAGEMENT)}
    before = json.loads(base.notes["days"]) if base is not None else {}
    same = {day for day, path in now.items() if day and before.get(day) == path}
    fact_schema = schemas.GOLD_SCHEMAS[schemas.FACT_MEDIA_ENGAGEMENT]
    touched = gold.read(spark, schemas.FACT_MEDIA_ENGAGEMENT, fact_schema, only=set(now) - same).select(*fact_schema.names)

    attempt = published.Attempt(spark, root, published.stamp())
    kept = list(base.parts_of(NUMBERS)) if base is not None else []
    known = base.read(spark, NUMBERS, _schema(NUMBERS)) if base is not None else _empty(spark, NUMBERS)
    # The rows written say how many visitors there are, and so how many parts the next ones are dealt to.
    held = int(base.notes["visitors"]) if base is not None else 0
    new = reach.new_visitors(touched, known)
    added = new.count()
    parts = max(1, -(-(held + added) // part_visitors))
    if added:
        write_layer(reach.number_visitors(new, known, parts), attempt.path, attempt.folder(NUMBERS))
        kept += attempt.written(NUMBERS)
    numbers = _read(spark, root, kept, NUMBERS)

    frames = {DAYS: reach.media_days(touched), BITS: reach.media_day_bits(touched, numbers)}
    rows = run_all(
        {name: partial(write_layer, df, attempt.path, attempt.folder(name), "date") for name, df in frames.items()}
    )
    for name in frames:
        kept += [p for p in (base.parts_of(name) if base is not None else []) if p.part in same]
        kept += attempt.written(name, by_part=True)
    notes = {"days": json.dumps(now), "visitors": str(held + added)}
    return attempt.commit(kept, rows | {NUMBERS: added}, gold.id, notes)


def load_reach(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The reach tables of the newest snapshot, by name."""
    snapshot = published.newest(spark, root)
    if snapshot is None:
        raise ValueError(f"{root} has no published reach tables")
    return {name: snapshot.read(spark, name, _schema(name)) for name in TABLES}


def reach_reports(spark: SparkSession, root: str, dim_media: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Each report that counts visitors, from the reach tables."""
    tables = load_reach(spark, root)
    days, bits = tables[DAYS], tables[BITS]
    return {
        "kpi": lambda: reach.kpi_summary(days, bits),
        "by_media": lambda: reach.engagement_by_media(days, bits, dim_media),
        "monthly": lambda: reach.monthly_engagement(days, bits, dim_media),
        "last_7_days": lambda: reach.recent_engagement(days, bits, dim_media, 7),
        "last_30_days": lambda: reach.recent_engagement(days, bits, dim_media, 30),
    }


def _schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name])


def _empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in _schema(name).fields])


def _read(spark: SparkSession, root: str, parts: list[published.Part], name: str) -> DataFrame:
    written = published.Snapshot(root, "", 0, "", None, None, tuple(parts))
    return written.read(spark, name, _schema(name))
