"""Landing -> Bronze -> Silver -> Gold as one ``availableNow`` stream.

The three endpoints' new landing files make one micro-batch: each is flattened by
the same ``to_bronze``, and the batch is upserted into Silver
(``plans.advance``), whose changes go on into Gold. A batch is published as the
version that bears its number. A batch that is replayed after a failure finds
either no commit of its number, and writes it, or its commit, and changes nothing;
Gold catches up with whatever Silver has. So no failure, wherever it comes, makes a
row count twice or not at all.

Use either this stream or ``advance_lake`` for a given Silver, not both: their
versions are not numbered alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from playlake.operators.bronze import to_bronze
from playlake.plans.advance import SILVER_BUCKETS, advance_gold, advance_silver
from playlake.session import use_utc
from playlake.sources import published, schemas
from playlake.sources.paths import layer_path

_ENDPOINT = "__endpoint"


def batch_version(batch_id: int) -> str:
    """The version of a micro-batch: sorts as its number."""
    return f"batch-{batch_id:012d}"


def take_batch(
    batch: DataFrame, batch_id: int, silver_root: str, gold_root: str, buckets: int = SILVER_BUCKETS
) -> None:
    """Publish one micro-batch of Bronze rows of all endpoints, unless it was published before."""
    spark, version = batch.sparkSession, batch_version(batch_id)
    last = published.newest(spark, silver_root)
    if last is None or last.version < version:
        batch = batch.persist()  # each endpoint's upsert reads it: its files are parsed once
        try:
            bronze = {
                e: batch.where(F.col(_ENDPOINT) == e).select(*schemas.bronze_columns(e)) for e in schemas.ENDPOINTS
            }
            advance_silver(spark, bronze, silver_root, version, buckets)
        finally:
            batch.unpersist()
    advance_gold(spark, silver_root, gold_root, version)


def start_lake_stream(
    spark: SparkSession,
    landing_root: str,
    silver_root: str,
    gold_root: str,
    checkpoint_location: str,
    max_files_per_trigger: int = 10_000,
    buckets: int = SILVER_BUCKETS,
) -> StreamingQuery:
    """Take in all landing files not seen before, in batches of bounded size, then stop.

    ``max_files_per_trigger`` counts per endpoint; ``checkpoint_location`` must be on
    shared storage and stay with this Silver.
    """
    use_utc(spark)
    rows: DataFrame | None = None
    for endpoint in schemas.ENDPOINTS:
        envelopes = (
            spark.readStream.schema(schemas.ENVELOPES[endpoint])
            .options(**schemas.ENVELOPE_OPTIONS)
            .option("maxFilesPerTrigger", str(max_files_per_trigger))
            .json(layer_path(landing_root, endpoint))
        )
        flat = to_bronze(envelopes).withColumn(_ENDPOINT, F.lit(endpoint))
        rows = flat if rows is None else rows.unionByName(flat, allowMissingColumns=True)
    return (
        rows.writeStream.foreachBatch(lambda batch, n: take_batch(batch, n, silver_root, gold_root, buckets))
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
