"""Session helpers: UTC clock, shared scratch folder, local session builder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def use_utc(spark: SparkSession) -> None:
    """Derive calendar dates in UTC, whatever zone the session was started with."""
    spark.conf.set("spark.sql.session.timeZone", UTC)


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        current = spark.sparkContext.getCheckpointDir()
        if current:
            return current
    except Exception:  # no SparkContext (e.g. Spark Connect)
        pass
    for key in ("spark.checkpoint.dir",):
        try:
            value = spark.conf.get(key, None)
        except Exception:
            value = None
        if value:
            return value
    return None


def _is_local(spark: SparkSession) -> bool:
    try:
        master = spark.sparkContext.master
        # not "local-cluster[...]", whose executors are processes of their own
        return master == "local" or master.startswith("local[")
    except Exception:
        return False


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-wide scratch folder, taken from ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a machine-local folder would be
    invisible to other executors and lost with them). Only a local-mode session
    without the setting gets its own fresh folder, as in tests.
    """
    configured = _configured_checkpoint_dir(spark)
    if configured:
        if not spark.sparkContext.getCheckpointDir():  # set on the session only: checkpoint() needs it too
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder of the cluster"
        )
    local = tempfile.mkdtemp(prefix="playlake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return _configured_checkpoint_dir(spark) or local


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


# Settings for a large cluster (hundreds of executors, tens of TB per job),
# passed with ``--conf`` or ``build_session(extra=...)``. Shuffle partitions
# start high and AQE coalesces them to ~advisory size; skewed join partitions
# are split; dimensions up to the adaptive threshold become broadcast joins
# only after their stage has run and their real size is known.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": UTC,
}


def job_session(app_name: str = "playlake") -> SparkSession:
    """Session for a submitted job (``spark-submit``, or plain ``python``).

    Master, resources and shuffle sizing come from the submission and
    ``spark-defaults.conf`` (see ``CLUSTER_SETTINGS``); nothing local is forced.
    Only the clock is fixed: dates are derived in UTC.
    """
    return SparkSession.builder.appName(app_name).config("spark.sql.session.timeZone", UTC).getOrCreate()


def build_session(
    master: str | None = None,
    app_name: str = "playlake",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local session with the settings the pipeline expects (tests, bench).

    AQE stays on: it coalesces small shuffle partitions, turns joins whose
    measured build side is small into broadcast joins, and splits skewed join
    partitions at run time.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", UTC)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", os.environ.get("PLAYLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
