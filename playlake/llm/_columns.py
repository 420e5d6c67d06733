"""Column helpers shared by the operators of this subpackage (JVM-side only)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words, and the white space between them.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` bound to a name, so that it is worked out once per row.

    Catalyst inlines a projected column that is used once, also into a lambda
    that runs for every element; a lambda's own argument is never inlined.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def constant_array(values: list[float]) -> Column:
    """A short list of numbers as one constant (folded once, not rebuilt for every row)."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")
