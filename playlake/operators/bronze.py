"""Bronze: one row per landed record.

The header's lineage columns go onto every record of its envelope; the record's
declared fields stay as they landed, unparsed. Envelopes without records give
nothing. Scan, flatten and write are one stage: nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.sources.schemas import LINEAGE


def to_bronze(envelopes: DataFrame) -> DataFrame:
    """Declared record fields, then the lineage columns."""
    flat = envelopes.selectExpr("ingestion_metadata AS __header", "explode(records) AS __record")
    return flat.select("__record.*", *(F.col(f"__header.{name}").alias(name) for name in LINEAGE))
