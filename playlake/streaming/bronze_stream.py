"""Landing -> Bronze as an incremental file stream (``availableNow``).

The batch Bronze run re-reads every landing file and overwrites the table;
at scale the landing tree only grows, so that cost grows with history. This
stream runs the same ``to_bronze`` flatten over landing files it has not seen
yet and appends them to Bronze: the checkpoint records which files were
consumed, and the Parquet file sink commits each micro-batch exactly once
(its ``_spark_metadata`` log is honoured by batch readers of the table).

``trigger(availableNow=True)`` processes everything present at start, in
bounded micro-batches, then stops — the scheduling of a daily batch job with
the bookkeeping of a stream. The result equals the batch Bronze over the same
files, because landing files are immutable and append-only.

Use either the batch run or the stream for a given Bronze directory, not both.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from playlake.operators.bronze import to_bronze
from playlake.sources import schemas
from playlake.sources.paths import layer_path


def start_bronze_stream(
    spark: SparkSession,
    endpoint: str,
    landing_root: str,
    bronze_root: str,
    checkpoint_location: str | None = None,
    max_files_per_trigger: int = 1000,
) -> StreamingQuery:
    """Start the landing -> Bronze stream for one endpoint (``availableNow``).

    ``checkpoint_location`` must be stable across runs and on shared storage;
    by default it sits next to the table, under ``<bronze_root>/_checkpoints``.
    """
    source = (
        spark.readStream.schema(schemas.ENVELOPES[endpoint])
        .options(**schemas.ENVELOPE_OPTIONS)
        .option("maxFilesPerTrigger", str(max_files_per_trigger))
        .json(layer_path(landing_root, endpoint))
    )
    checkpoint = checkpoint_location or layer_path(bronze_root, f"_checkpoints/{endpoint}")
    return (
        to_bronze(source)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(layer_path(bronze_root, endpoint))
    )


class _RowsRead(StreamingQueryListener):
    """Rows read by each query, over all of its micro-batches.

    ``recentProgress`` keeps only the last ones (100 by default), so a run of
    many batches is counted by its progress events as they come.
    """

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _end(self, run_id: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run_id = str(event.progress.runId)
        with self._lock:
            self.rows[run_id] = self.rows.get(run_id, 0) + int(event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def total(self, query: StreamingQuery, timeout: float = 60.0) -> int:
        """All rows of a query that has ended; its events arrive in order, the end last."""
        run_id = str(query.runId)
        if not self._end(run_id).wait(timeout):
            raise TimeoutError(f"no end event of streaming query {run_id}")
        return self.rows.get(run_id, 0)


def stream_bronze(
    spark: SparkSession,
    landing_root: str,
    bronze_root: str,
    checkpoint_root: str | None = None,
    max_files_per_trigger: int = 1000,
) -> dict[str, int]:
    """Run the stream for every endpoint to completion; return envelopes consumed per endpoint."""
    consumed: dict[str, int] = {}
    listener = _RowsRead()
    spark.streams.addListener(listener)
    try:
        for endpoint in schemas.ENDPOINTS:
            checkpoint = layer_path(checkpoint_root, endpoint) if checkpoint_root else None
            query = start_bronze_stream(spark, endpoint, landing_root, bronze_root, checkpoint, max_files_per_trigger)
            query.awaitTermination()
            if query.exception() is not None:
                raise query.exception()
            consumed[endpoint] = listener.total(query)
    finally:
        spark.streams.removeListener(listener)
    return consumed
