"""Latest record per key — the primitive under all of Silver and ``dim_visitor``.

``row_number() = 1`` over a key window. Catalyst turns the rank filter into a
``WindowGroupLimit``: a partial top-1 per key runs in each map task *before*
the shuffle and a final one after it, so a key holding a third of all rows
ships one row per map task, not all of its rows, to one reducer.

Callers pass an ordering that is a total order (recency first, then the
remaining columns) so that ties never make the result depend on the plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.functions.columns import parse_instant

_RANK = "__latest_rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """Keep the first row per ``keys`` under ``newest_first`` ordering."""
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def ingest_recency(ingest_col: str = "ingest_timestamp", tiebreak: Sequence[str] = ()) -> list[Column]:
    """Newest ingest first, by the parsed instant, then the raw text, then ``tiebreak``.

    Ordering on the parsed instant (not the text) stays right when stamps carry
    different offsets or omit the fraction; nulls go last everywhere.
    """
    order = [
        parse_instant(ingest_col).desc_nulls_last(),
        F.col(ingest_col).desc_nulls_last(),
    ]
    order += [F.col(c).desc_nulls_last() for c in tiebreak]
    return order


def ingest_rank(of: str, ingest_col: str = "ingest_timestamp", tiebreak: Sequence[str] = ()) -> Column:
    """A value of the struct column ``of`` that is the greater, the sooner ``ingest_recency`` sorts its row."""
    stamp = f"{of}.{ingest_col}"
    return F.struct(parse_instant(stamp).alias("at"), F.col(stamp).alias("text"), *(F.col(f"{of}.{c}").alias(c) for c in tiebreak))
