"""Send this package to the executors' Python workers, as ``--py-files`` would, and keep these small."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()
#: Bytes of an Arrow batch sent to a worker (Spark's default is 64 MB, far more than these operators use at a time).
BATCH_BYTES = 4 << 20
_LIMIT, _DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", f"{64 << 20}b"


def ship(spark: SparkSession) -> None:
    """Add the package's sources to the session once; workers may start in any folder."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="playlake-src-")) / "playlake_src.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def small_batches(spark: SparkSession) -> None:
    """Have the session send batches of about ``BATCH_BYTES``, or one longer row; a limit that the user has set stays.

    A batch is held twice, outside the heap: by the executor, whose threads each
    keep what their largest one took, and by the worker.
    """
    if spark.conf.get(_LIMIT) == _DEFAULT:
        spark.conf.set(_LIMIT, f"{BATCH_BYTES}b")


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its tasks, and what it keeps counts for the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # other C libraries than glibc have none
    if trim is not None:
        trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` of a mapInArrow, whose worker gives back what it used once its task is over."""

    @functools.wraps(run)
    def lean_run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return lean_run


def lean_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for the function of an applyInArrow: after each group."""

    @functools.wraps(run)
    def lean_run(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return lean_run
