"""Silver: validate, filter, type and de-duplicate each Bronze table.

Each endpoint is described by a ``Refinement`` and run through one generic
pipeline, in this order (the order decides results):

1. rename (metadata: the record's ``hashed_id`` becomes ``media_id``),
2. required keys must be non-null — checked on the *raw* text, so a present
   but unparseable timestamp passes and becomes null in step 4,
3. keep filter (events: plays only; by_date: days with loads),
4. parse with ``try_`` casts (null on bad input, ANSI-safe),
5. latest ingest wins per key — after filtering, so an older play survives a
   newer conversion of the same key, and on the *parsed* key, so all
   unparseable dates of one media collapse into one row,
6. fixed output projection.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.functions.columns import all_not_null, parse_day, parse_instant
from playlake.operators.latest import ingest_recency, latest_per_key
from playlake.sources import schemas


@dataclass(frozen=True)
class Refinement:
    key: tuple[str, ...]
    required: tuple[str, ...]
    output: tuple[str, ...]
    casts: Mapping[str, Callable[[str], Column]] = field(default_factory=dict)
    keep: Callable[[], Column] | None = None
    drop_first: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)

    def tiebreak(self) -> list[str]:
        """Output columns outside the key: ordering on them makes the winner unique."""
        return [c for c in self.output if c not in self.key]


def _plays_only() -> Column:
    kind = F.col("conversion_type")
    return kind.isNull() | (kind == "")


def _has_loads() -> Column:
    return F.col("load_count") > 0


# Per endpoint, the business key, the required fields and the
# Silver output columns in order.
REFINEMENTS: dict[str, Refinement] = {
    schemas.EVENTS: Refinement(
        key=("event_key",),
        required=("event_key", "visitor_key", "media_id", "received_at"),
        keep=_plays_only,
        casts={"received_at": parse_instant},
        output=(
            "event_key", "visitor_key", "media_id", "media_name", "media_url",
            "received_at", "ip", "country", "percent_viewed",
        ),
    ),
    schemas.BY_DATE: Refinement(
        key=("media_id", "date"),
        required=("media_id", "date", "load_count"),
        keep=_has_loads,
        casts={"date": parse_day},
        output=("media_id", "date", "load_count", "play_count", "hours_watched"),
    ),
    schemas.MEDIA_METADATA: Refinement(
        key=("media_id",),
        drop_first=("media_id",),
        renames={"hashed_id": "media_id"},
        required=("media_id",),
        casts={"created": parse_instant},
        output=("media_id", "name", "created"),
    ),
}


def screen(bronze: DataFrame, spec: Refinement) -> DataFrame:
    """Steps 1 to 4: the typed rows that may become a Silver row, of all ingests."""
    df = bronze.drop(*spec.drop_first) if spec.drop_first else bronze
    for old, new in spec.renames.items():
        df = df.withColumnRenamed(old, new)
    df = df.where(all_not_null(*spec.required))
    if spec.keep is not None:
        df = df.where(spec.keep())
    for name, cast in spec.casts.items():
        df = df.withColumn(name, cast(name))
    return df


def latest(screened: DataFrame, spec: Refinement) -> DataFrame:
    """Step 5. Newest under a total order, so the latest of latest rows is the latest of all."""
    return latest_per_key(screened, spec.key, ingest_recency(tiebreak=spec.tiebreak()))


def refine(bronze: DataFrame, spec: Refinement) -> DataFrame:
    return latest(screen(bronze, spec), spec).select(*spec.output)


def to_silver(bronze: DataFrame, endpoint: str) -> DataFrame:
    return refine(bronze, REFINEMENTS[endpoint])


def to_silver_events(bronze: DataFrame) -> DataFrame:
    return refine(bronze, REFINEMENTS[schemas.EVENTS])


def to_silver_by_date(bronze: DataFrame) -> DataFrame:
    return refine(bronze, REFINEMENTS[schemas.BY_DATE])


def to_silver_media_metadata(bronze: DataFrame) -> DataFrame:
    return refine(bronze, REFINEMENTS[schemas.MEDIA_METADATA])
