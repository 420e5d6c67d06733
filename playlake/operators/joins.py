"""Join helpers that state how the small side is bounded.

Two cases:

* ``lookup``: a fact or aggregate against a dimension whose size grows with
  the data (one row per media or per visitor). No hint: Spark broadcasts it
  only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
  (planning time, from Parquet file sizes) or, with AQE, under
  ``spark.sql.adaptive.autoBroadcastJoinThreshold`` (run time, from the actual
  shuffle output of the dimension's stage). Above that it stays a sort-merge
  join, whose skewed partitions AQE splits.
* ``bounded_broadcast``: a side whose row count is bounded by construction
  (a ``limit(n)`` with ``n`` checked here). It is hinted for broadcast only
  under ``max_rows``; beyond that the hint is withheld and the lookup path above
  applies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest row bound for which a broadcast hint is given without measuring.
BROADCAST_ROW_CAP = 100_000


def lookup(left: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    return left.join(dim, on=list(on), how=how)


def bounded_broadcast(df: DataFrame, row_bound: int, max_rows: int = BROADCAST_ROW_CAP) -> DataFrame:
    """Broadcast hint for a frame known to hold at most ``row_bound`` rows."""
    return F.broadcast(df) if 0 <= row_bound <= max_rows else df
