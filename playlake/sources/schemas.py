"""Declared schemas: landing envelopes, Bronze records, Gold tables.

A landing file holds one JSON document: a header that says which pull it is,
and the pull's records. What is declared here is what a *scan* reads; files may
hold more fields per record, and those stay in the file. The header names the
media for all three endpoints alike, so the media id is lineage and not a record
field, also for events.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Endpoint names and Gold table names (directory names of the lake).
EVENTS = "events"
BY_DATE = "by_date"
MEDIA_METADATA = "media_metadata"
ENDPOINTS = (EVENTS, BY_DATE, MEDIA_METADATA)

DIM_MEDIA = "dim_media"
DIM_VISITOR = "dim_visitor"
FACT_MEDIA_ENGAGEMENT = "fact_media_engagement"
GOLD_TABLES = (DIM_MEDIA, DIM_VISITOR, FACT_MEDIA_ENGAGEMENT)

# Lineage columns appended to every Bronze row, in this order.
LINEAGE = ("ingest_timestamp", "ingest_date", "media_id")


# Envelope header fields and, below, the record fields each
# endpoint declares (in record order, with their types).
HEADER = StructType(
    [
        StructField("endpoint", StringType()),
        StructField("media_id", StringType()),
        StructField("ingest_timestamp", StringType()),
        StructField("ingest_date", StringType()),
        StructField("record_count", LongType()),
    ]
)

RECORD_SCHEMAS: dict[str, StructType] = {
    EVENTS: StructType(
        [
            StructField("received_at", StringType()),
            StructField("event_key", StringType()),
            StructField("ip", StringType()),
            StructField("country", StringType()),
            StructField("percent_viewed", DoubleType()),
            StructField("conversion_type", StringType()),
            StructField("visitor_key", StringType()),
            StructField("media_name", StringType()),
            StructField("media_url", StringType()),
        ]
    ),
    BY_DATE: StructType(
        [
            StructField("date", StringType()),
            StructField("load_count", LongType()),
            StructField("play_count", LongType()),
            StructField("hours_watched", DoubleType()),
        ]
    ),
    MEDIA_METADATA: StructType(
        [
            StructField("hashed_id", StringType()),
            StructField("name", StringType()),
            StructField("created", StringType()),
        ]
    ),
}

# Columns and types of the Silver tables.
SILVER_SCHEMAS: dict[str, StructType] = {
    EVENTS: StructType(
        [
            StructField("event_key", StringType()),
            StructField("visitor_key", StringType()),
            StructField("media_id", StringType()),
            StructField("media_name", StringType()),
            StructField("media_url", StringType()),
            StructField("received_at", TimestampType()),
            StructField("ip", StringType()),
            StructField("country", StringType()),
            StructField("percent_viewed", DoubleType()),
        ]
    ),
    BY_DATE: StructType(
        [
            StructField("media_id", StringType()),
            StructField("date", DateType()),
            StructField("load_count", LongType()),
            StructField("play_count", LongType()),
            StructField("hours_watched", DoubleType()),
        ]
    ),
    MEDIA_METADATA: StructType(
        [
            StructField("media_id", StringType()),
            StructField("name", StringType()),
            StructField("created", TimestampType()),
        ]
    ),
}

# Columns and types of the Gold tables. Gold is read back with
# these: a table without rows, or with null days only, has no types to infer.
GOLD_SCHEMAS: dict[str, StructType] = {
    DIM_MEDIA: StructType(
        [
            StructField("media_id", StringType()),
            StructField("title", StringType()),
            StructField("url", StringType()),
            StructField("channel", StringType()),
            StructField("created_at", TimestampType()),
        ]
    ),
    DIM_VISITOR: StructType(
        [
            StructField("visitor_id", StringType()),
            StructField("ip_address", StringType()),
            StructField("country", StringType()),
        ]
    ),
    FACT_MEDIA_ENGAGEMENT: StructType(
        [
            StructField("media_id", StringType()),
            StructField("visitor_id", StringType()),
            StructField("date", DateType()),
            StructField("play_count", LongType()),
            StructField("watched_percent", DoubleType()),
            StructField("play_rate", DoubleType()),
            StructField("total_watch_time", DoubleType()),
        ]
    ),
}


def envelope(record_schema: StructType) -> StructType:
    """Envelope schema around one endpoint's record schema."""
    return StructType(
        [
            StructField("ingestion_metadata", HEADER),
            StructField("records", ArrayType(record_schema)),
        ]
    )


ENVELOPES: dict[str, StructType] = {name: envelope(s) for name, s in RECORD_SCHEMAS.items()}


def record_fields(endpoint: str) -> list[str]:
    return [f.name for f in RECORD_SCHEMAS[endpoint].fields]


def bronze_columns(endpoint: str) -> list[str]:
    """Column order of a Bronze table: record fields, then lineage."""
    return record_fields(endpoint) + list(LINEAGE)


# Options of the envelope scan, batch and stream alike.
ENVELOPE_OPTIONS = {"multiLine": "true", "recursiveFileLookup": "true"}
