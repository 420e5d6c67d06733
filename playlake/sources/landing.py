"""Landing zone: JSON envelopes, one per (endpoint, media, run, chunk).

Layout: ``<root>/<endpoint>[/run=<name>]/media_id=<id>/ingest_date=<YYYY-MM-DD>/part-*.json.gz``,
append-only (files of plain JSON beside them are read alike); every write job adds new files, so re-landed records are kept and
de-duplicated later by Silver. With a run's name, its files lie in a folder of their
own: whoever knows which runs were committed (``incremental.landed_runs``) reads
those folders and lists nothing else of the tree.

Sink (``build_envelopes`` + ``write_landing``)
  * Records land whole: every column of the pulled frame but the pull keys, with
    the type it came in. Landing is the only copy, so nothing is dropped or cast
    here; fields and types are chosen when a scan declares them.
  * A pull's records are gathered with ``collect_list`` per chunk, never per
    whole pull: a pull of ``n`` records is spread over ``ceil(n / max_records)``
    envelopes by a hash, so one hot media cannot put its whole history in one
    row or one task; ``record_count`` is then the chunk's. Pull sizes come from a
    partial aggregate (one row per pull); only pulls over ``max_records`` are
    joined back to the records, broadcast where ``max_records`` keeps them few. Pull keys are compared null-safely: a pull with a null key part is a
    pull like any other.
  * The flat records are hash-partitioned on the envelope key and collected
    only after that exchange (no map-side partial collect). The exchange may be
    coalesced unless ``write_tasks`` fixes the number of writing tasks.
  * A pull that returned nothing still lands, as one envelope with an empty
    array and ``record_count = 0``.
  * One envelope per file (``maxRecordsPerFile = 1``): the multi-line reader
    parses only the first JSON document of a file.

Scan (``read_landing``): explicit envelope schema, multi-line JSON (the
files may be pretty-printed), recursive lookup that ignores the partition
directory names. Fields not in the schema are dropped at read time, a value
that does not fit its declared type is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlake.sources import schemas
from playlake.sources.paths import layer_path

PULL_KEYS = ("media_id", "ingest_timestamp", "ingest_date")
DEFAULT_MAX_RECORDS = 50_000
#: Envelopes of so many records: the pulls of more than one are few, whatever the table.
_FEW_SPLITS = 10_000


def record_columns(records: DataFrame) -> list[str]:
    """Every column of a record: all but the pull keys."""
    return [c for c in records.columns if c not in PULL_KEYS]


def _same_pull(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """Join on the pull keys, null-safe; the right side's keys do not come along."""
    renamed = right.select(*(F.col(c).alias(f"__r_{c}" if c in PULL_KEYS else c) for c in right.columns))
    same = F.lit(True)
    for key in PULL_KEYS:
        same = same & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    joined = left.join(renamed, same, how)
    return joined if how == "left_anti" else joined.drop(*(f"__r_{key}" for key in PULL_KEYS))


def build_envelopes(
    records: DataFrame,
    endpoint: str,
    pulls: DataFrame | None = None,
    max_records: int = DEFAULT_MAX_RECORDS,
    write_tasks: int | None = None,
) -> DataFrame:
    """Envelopes (``ingestion_metadata``, ``records``) from pulled records.

    ``records``: one row per pulled record: ``media_id``, ``ingest_timestamp``,
    ``ingest_date`` and the record's own fields, whatever they are.
    ``pulls``: every pull that ran (same three columns), so that empty pulls
    land too; when omitted only pulls with records are written.
    ``write_tasks``: tasks the envelopes are spread over (default: by size, as
    AQE coalesces the exchange).
    """
    if max_records < 1:
        raise ValueError("max_records must be positive")
    if write_tasks is not None and write_tasks < 1:
        raise ValueError("write_tasks must be positive")
    keys = list(PULL_KEYS)
    fields = record_columns(records)
    sizes = records.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    # Only pulls larger than one envelope need a chunk count; there are at most
    # (records / max_records) of them. With envelopes of the usual size that side
    # is small and broadcast, so the records are not exchanged for this join.
    # Every other pull is chunk 0.
    split = sizes.where(F.col("__n") > max_records).select(
        *keys, F.ceil(F.col("__n") / F.lit(max_records)).alias("__chunks")
    )
    if max_records >= _FEW_SPLITS:
        split = F.broadcast(split)
    # The spread hash is taken before the join, on the input partitioning: the
    # task's partition id joins the record hash, so even identical records of
    # one pull spread across chunks (a retried task keeps its partition id).
    # Taken after a shuffle on the pull keys, all rows of a pull would share it.
    # As JSON, because a record may have fields of types that have no hash (maps).
    spread = F.xxhash64(F.spark_partition_id(), F.to_json(F.struct(*fields)))
    chunk = F.coalesce(F.pmod(F.col("__spread"), F.col("__chunks")), F.lit(0).cast("long"))
    chunked = (
        records.withColumn("__spread", spread)
        .transform(_same_pull, split, "left")
        .select(F.struct(*keys, chunk.alias("n")).alias("__chunk"), F.struct(*fields).alias("__record"))
        # Flat rows are shuffled on the envelope key and collected after the
        # exchange: a map-side partial collect_list would not shrink the data,
        # only hold each task's records as object buffers before shipping them.
        # The key is one column: of several, those that are constant in a run would
        # leave the grouping, and the exchange would no longer be what it needs.
        .repartition(*([write_tasks] if write_tasks else []), "__chunk")
        .groupBy("__chunk")
        .agg(F.collect_list("__record").alias("records"))
        .select(*(F.col(f"__chunk.{key}").alias(key) for key in keys), "records")
    )
    if pulls is not None:
        empty = _same_pull(pulls.select(*keys), sizes.select(*keys), "left_anti").withColumn(
            "records", F.array().cast(chunked.schema["records"].dataType)
        )
        chunked = chunked.unionByName(empty)
    header = F.struct(
        F.lit(endpoint).alias("endpoint"),
        F.col("media_id"),
        F.col("ingest_timestamp"),
        F.col("ingest_date"),
        F.size("records").cast("long").alias("record_count"),
    )
    return chunked.select(header.alias("ingestion_metadata"), "records")


def write_landing(envelopes: DataFrame, endpoint: str, landing_root: str, run: str | None = None) -> None:
    """Append envelopes under ``<root>/<endpoint>[/run=…]/media_id=…/ingest_date=…``."""
    out = envelopes.select(
        "ingestion_metadata",
        "records",
        F.col("ingestion_metadata.media_id").alias("media_id"),
        F.col("ingestion_metadata.ingest_date").alias("ingest_date"),
    )
    (
        out.write.mode("append")
        .option("maxRecordsPerFile", 1)
        .option("compression", "gzip")
        .partitionBy("media_id", "ingest_date")
        .json(_folder(landing_root, endpoint, run))
    )


def _folder(landing_root: str, endpoint: str, run: str | None) -> str:
    return layer_path(landing_root, f"{endpoint}/run={run}" if run else endpoint)


def read_landing(
    spark: SparkSession,
    endpoint: str,
    landing_root: str,
    record_schema: StructType | None = None,
    runs: Sequence[str] | None = None,
) -> DataFrame:
    """Every envelope of ``endpoint`` under ``landing_root``.

    ``record_schema``: the record fields to read (default: the declared ones).
    ``runs``: only what these runs landed; no other folder is listed.
    """
    schema = schemas.envelope(record_schema) if record_schema else schemas.ENVELOPES[endpoint]
    if runs is not None and not runs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    folders = [_folder(landing_root, endpoint, run) for run in runs or [None]]
    return spark.read.schema(schema).options(**schemas.ENVELOPE_OPTIONS).json(folders)
