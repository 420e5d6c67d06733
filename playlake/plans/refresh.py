"""Layer runs and the full refresh: landing -> Bronze -> Silver -> Gold.

Each run reads the previous layer's newest snapshot, builds its tables lazily, writes
them to a folder of their own and publishes all of them with one commit, returning
``{table: rows written}``. A run that fails leaves the layer as it was. The tables
of a layer are independent and are written as concurrent jobs. Counting rides on the
write (``Observation``), so every table is computed once. Silver events are
not cached for Gold: each Gold builder reads only the Parquet columns it
needs, which at scale is cheaper than materialising the whole table.

Entry point: ``python -m playlake.plans.refresh <landing> <bronze> <silver> <gold>``.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlake.operators.bronze import to_bronze
from playlake.operators.gold import build_gold
from playlake.operators.silver import to_silver
from playlake.plans.concurrent import run_all
from playlake.session import use_utc
from playlake.sources import published, schemas
from playlake.sources.landing import read_landing
from playlake.sources.layers import layer_reader, write_layer


# The fact is partitioned by day: the recent-window reports then read only the
# newest day directories (the cut-off is a partition filter evaluated at run time).
GOLD_PARTITIONING = {schemas.FACT_MEDIA_ENGAGEMENT: "date"}


def publish_layer(
    spark: SparkSession, root: str, frames: Mapping[str, DataFrame], partitioning: Mapping[str, str] | None = None
) -> dict[str, int]:
    """Write the tables of a layer as one snapshot; the rows of each."""
    attempt = published.Attempt(spark, root, published.stamp())
    by = partitioning or {}
    rows = run_all(
        {name: partial(write_layer, df, attempt.path, attempt.folder(name), by.get(name)) for name, df in frames.items()}
    )
    attempt.commit([part for name in frames for part in attempt.written(name)], rows)
    return rows


def run_bronze(spark: SparkSession, landing_root: str, bronze_root: str) -> dict[str, int]:
    use_utc(spark)
    return publish_layer(
        spark, bronze_root, {e: to_bronze(read_landing(spark, e, landing_root)) for e in schemas.ENDPOINTS}
    )


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str) -> dict[str, int]:
    use_utc(spark)
    bronze = layer_reader(spark, bronze_root)
    return publish_layer(spark, silver_root, {e: to_silver(bronze(e), e) for e in schemas.ENDPOINTS})


def gold_tables(spark: SparkSession, silver_root: str) -> dict[str, DataFrame]:
    silver = layer_reader(spark, silver_root)
    return build_gold(silver(schemas.MEDIA_METADATA), silver(schemas.EVENTS), silver(schemas.BY_DATE))


def run_gold(spark: SparkSession, silver_root: str, gold_root: str) -> dict[str, int]:
    use_utc(spark)
    return publish_layer(spark, gold_root, gold_tables(spark, silver_root), GOLD_PARTITIONING)


def full_refresh(
    spark: SparkSession, landing_root: str, bronze_root: str, silver_root: str, gold_root: str
) -> dict[str, dict[str, int]]:
    """Bronze, then Silver, then Gold in one session; stops at the first failure.

    Then snapshots of each layer are removed by age (``published.expire``).
    """
    counts = {
        "bronze": run_bronze(spark, landing_root, bronze_root),
        "silver": run_silver(spark, bronze_root, silver_root),
        "gold": run_gold(spark, silver_root, gold_root),
    }
    for root in (bronze_root, silver_root, gold_root):
        published.expire(spark, root)
    return counts


def load_gold(spark: SparkSession, gold_root: str) -> dict[str, DataFrame]:
    """The three Gold tables as lazy DataFrames, keyed by table name, with their
    declared columns (a partition column is read back last otherwise): Gold that
    no event has reached yet is three tables without rows."""
    gold = layer_reader(spark, gold_root)
    return {
        name: gold(name, schemas.GOLD_SCHEMAS[name]).select(*schemas.GOLD_SCHEMAS[name].names) for name in schemas.GOLD_TABLES
    }


def counts_frame(spark: SparkSession, counts: dict[str, dict[str, int]]) -> DataFrame:
    """Layer counts as a small DataFrame (layer, table_name, row_count).

    Built from literals in the JVM (one row inlined into several), so no
    Python worker has to start just to decode a handful of driver-side rows.
    """
    rows = [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(table).alias("table_name"),
            F.lit(int(n)).cast("long").alias("row_count"),
        )
        for layer, per in counts.items()
        for table, n in per.items()
    ]
    if not rows:
        return spark.range(0).select(
            F.lit(None).cast("string").alias("layer"),
            F.lit(None).cast("string").alias("table_name"),
            F.lit(None).cast("long").alias("row_count"),
        )
    return spark.range(1).select(F.inline(F.array(*rows)))


def main(argv: list[str]) -> int:
    from playlake import session

    if len(argv) != 4:
        print("usage: python -m playlake.plans.refresh LANDING BRONZE SILVER GOLD", file=sys.stderr)
        return 2
    spark = session.job_session("playlake-refresh")
    try:
        print(full_refresh(spark, *argv))
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
