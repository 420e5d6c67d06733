"""Parquet layers (Bronze, Silver, Gold): scan, and writes with a row count.

A layer is published as a whole (``published``): its tables are written to a new
folder and become visible with one commit, so a reader sees the layer as one run
left it, also while the next run writes or after it has failed. ``write_layer``
alone overwrites a folder in place; it is for folders that only the caller knows.

The count is taken by an ``Observation`` on the write itself, so a table is
computed once — no cache-then-count-then-write pass. Layers hand over through
Parquet, which also cuts lineage: a lost executor re-runs at most the current
layer's stages.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from playlake.sources import published
from playlake.sources.paths import layer_path


def read_layer(spark: SparkSession, root: str, name: str, schema: StructType | None = None) -> DataFrame:
    """A layer's table: of the newest snapshot, or the plain folder of a root without commits.

    With ``schema`` it is read as declared, also without any file to infer from,
    or with nothing but null partition values.
    """
    return layer_reader(spark, root)(name, schema)


def layer_reader(spark: SparkSession, root: str) -> Callable[..., DataFrame]:
    """``read(name, schema=None)`` for tables of one layer, all of the same snapshot."""
    snapshot = published.newest(spark, root)

    def read(name: str, schema: StructType | None = None) -> DataFrame:
        if snapshot is not None:
            return snapshot.read(spark, name, schema)
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(layer_path(root, name))

    return read


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files (a scratch folder of the caller's own)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_layer(df: DataFrame, root: str, name: str, partition_by: str | None = None) -> int:
    """Overwrite ``root/name`` with ``df``; return the number of rows written.

    With ``partition_by``, rows are first rebalanced on that column (AQE keeps
    one column value per task where it can and splits values that are too
    large), then written one directory per value, so readers filtering on the
    column skip whole directories.
    """
    observation = Observation(f"rows_{name}_{uuid.uuid4().hex[:8]}")
    counted = df.observe(observation, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = counted.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by)
    writer.parquet(layer_path(root, name))
    try:
        return int(observation.get["rows"])
    except Py4JJavaError:
        # A plan that is known to be empty is replaced as a whole, observation
        # and all, and then there is no row of figures: count what was written.
        return df.sparkSession.read.schema(df.schema).parquet(layer_path(root, name)).count()
