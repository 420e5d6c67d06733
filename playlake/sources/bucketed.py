"""Bucketed Parquet tables in a folder of the caller's choice.

Spark keeps the bucketing of files in its catalog, not beside them. A table is
therefore declared over its folder, under a name that follows from the path, and
any session that knows the folder, the columns and the bucketing can declare it
again: the files alone carry the data, dropping the name removes none.

Every task writes one bucket (rows are first dealt by the same hash that numbers the
buckets), so a bucket is one file, split by ``maxRecordsPerFile`` only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _declare(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int) -> str:
    shape = f"{path}\n{schema.simpleString()}\n{','.join(keys)}\n{buckets}"
    name = f"playlake_{hashlib.md5(shape.encode()).hexdigest()}"
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    location = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY ({', '.join(map(_quoted, keys))}) INTO {int(buckets)} BUCKETS LOCATION '{location}'"
    )
    return name


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """Write ``df`` to the new folder ``path`` in ``buckets`` buckets of ``keys``."""
    if buckets < 1:
        raise ValueError("buckets must be at least 1")
    name = _declare(df.sparkSession, path, df.schema, keys, buckets)
    df.repartition(buckets, *keys).write.insertInto(name)


def read_bucketed(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int) -> DataFrame:
    """The table in ``path``; joins and groups on its keys need no exchange of it."""
    return spark.table(_declare(spark, path, schema, keys, buckets))
