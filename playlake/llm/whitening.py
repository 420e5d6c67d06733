"""Embedding whitening: shifted CholeskyQR over distributed Gram passes.

A vector counts in ticks, x = floor(64 * entry) + 1,000,000. The fit list is every
distinct x vector once, written to the shared folder. With its size n and sums S
the centred rows are (n * x - S) / n, exact before the division. Then

* pass 1: the Gram matrix G of the centred rows, R = chol(G + s I) with the shift
  s = 11 (n d + d (d + 1)) u trace(G) that keeps it positive definite;
* passes 2 and 3: the rows through the triangular solves of all R so far, their
  Gram matrix again, R <- chol(G) R (a shift again where G is singular);
* pass 4: the Gram matrix and sums of the orthonormal rows, which closes the
  product: centred rows = Q R with Q'Q = G. With G = W D W' the SVD of D^(1/2) W' R
  gives the principal axes (right singular vectors) and e = s^2 / n;
* pass 5: the covariance of the whitened rows, for the error against the identity.

Only d x d matrices leave the tasks; they are added in a tree of groups, in a
fixed order, so a task that is run again changes nothing. Components whose e is
below ``RANK`` of the trace are not whitened and not returned: the rows have no
spread along them.

Defined results
  * null vector, null or non-finite entry: no row; vectors of another length than
    most rows have (of equally frequent ones the longest): no row;
  * an entry beyond +-2^56 counts as that; ``deviation`` is null where it exceeds a long;
  * repeated rows: once in the fit, each in the result; null ids are kept;
  * empty table, one distinct vector, vectors without entries: no rows;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm._ship import ship
from playlake.llm._vectors import common_length, is_whole, matrix
from playlake.session import scratch_path
from playlake.sources.layers import remove

#: Ticks per unit, their zero, components returned at most.
TICKS, ZERO, COMPONENTS = 64, 1_000_000, 16
#: An axis with less than this share of all variance has none.
RANK = 1e-12
#: Rows of a Gram product, matrices added in one group.
BLOCK, FAN_IN = 8192, 64
_LIMIT = float(2**62)


def ticks(vec: Column) -> Column:
    """The vector in ticks (long)."""
    limit = F.lit(_LIMIT)
    return F.transform(
        vec.cast("array<double>"),
        lambda c: F.floor(F.greatest(F.least(c * TICKS, limit), -limit)).cast("long") + F.lit(ZERO).cast("long"),
    )


@dataclass(frozen=True)
class Centre:
    """n and S: the centre is S / n, held as whole ticks and a rest."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([s % self.n for s in self.sums], np.int64)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact (Python numbers where 64 bits would not do)."""
        off = x - self.whole
        most = max(-int(off.min()), int(off.max())) if off.size else 0
        if (most + 1) * self.n < 2**62:
            return off * self.n - self.rest
        return off.astype(object) * self.n - self.rest.astype(object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return np.asarray(self.scaled(x) / self.n, np.float64)

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """The sum of the squares of n * x - S per row, exact; None beyond a long."""
        scaled = self.scaled(x)
        most = max(-int(scaled.min()), int(scaled.max())) if scaled.size else 0
        if scaled.dtype != object and most**2 * scaled.shape[1] < 2**63:
            return (scaled * scaled).sum(1).tolist()
        exact = (scaled.astype(object) ** 2).sum(1).tolist()
        return [v if v < 2**63 else None for v in exact]


@dataclass(frozen=True)
class Whitening:
    """What a fit leaves: the centre, the axes (a column each) and their variances."""

    length: int
    centre: Centre | None
    axes: np.ndarray
    variances: np.ndarray
    trace: float
    identity_error: float


def _added(parts: DataFrame, n: int, shape: tuple[int, int]) -> np.ndarray:
    """The sum of matrices (at: place of the task, value: doubles), in the order of their places."""

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        total = sum((np.frombuffer(v.as_buffer(), np.float64) for v in table.column("value").combine_chunks()), np.zeros(1))
        return pa.table({"at": pa.array([table.column("at")[0].as_py() // FAN_IN], pa.int64()), "value": pa.array([total.tobytes()], pa.binary())})

    while n > FAN_IN:
        parts, n = parts.groupBy(F.floor(F.col("at") / FAN_IN)).applyInArrow(add, "at long, value binary"), -(-n // FAN_IN)
    total = np.zeros(shape)
    for row in sorted(parts.collect(), key=lambda r: r["at"]):
        total += np.frombuffer(row["value"], np.float64).reshape(shape)
    return total


def _gram(
    fit_list: DataFrame, tasks: int, length: int, centre: Centre, change: Callable[[np.ndarray], np.ndarray], width: int
) -> np.ndarray:
    """Sum over the fit list's rows y = change(centred row) of [y y', y]."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width + 1))
        for batch in batches:
            x = matrix(batch.column(0), length)
            for start in range(0, len(x), BLOCK):
                y = change(centre.centred(x[start : start + BLOCK]))
                total[:, :width] += y.T @ y
                total[:, width] += y.sum(0)
        yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())], names=["at", "value"])

    return _added(fit_list.mapInArrow(run, "at long, value binary"), tasks, (width, width + 1))


def _cholesky(gram: np.ndarray, n: int) -> np.ndarray:
    """Upper R with R'R = gram, shifted where gram is not positive definite in doubles."""
    d = len(gram)
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * max(float(np.trace(gram)), np.finfo(float).tiny)
    for _ in range(60):
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift *= 10
    raise ArithmeticError("the Gram matrix has entries that are not finite")


def _solved(factors: list[np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
    """Rows times the inverses of the triangular factors, one solve after the other."""

    def change(rows: np.ndarray) -> np.ndarray:
        for r in factors:
            rows = np.linalg.solve(r.T, rows.T).T
        return rows

    return change


def fit(vectors: DataFrame, vec_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """Centre and leading principal axes of the distinct vectors."""
    spark = vectors.sparkSession
    ship(spark)
    whole = vectors.where(is_whole(F.col(vec_col)))
    length = common_length(whole, vec_col)
    nothing = Whitening(length, None, np.zeros((length, 0)), np.zeros(0), 0.0, 0.0)
    if not length:
        return nothing
    path = scratch_path(spark, "whitening")
    whole.where(F.size(vec_col) == length).select(ticks(F.col(vec_col)).alias("x")).distinct().write.parquet(path)
    fit_list = spark.read.parquet(path)
    tasks = (fit_list.select(F.spark_partition_id().alias("at")).agg(F.max("at")).first()[0] or 0) + 1
    # sums of many millions of ticks beyond a long: as decimals
    total = fit_list.select(F.posexplode("x").alias("at", "v")).groupBy("at").agg(
        F.sum(F.col("v").cast("decimal(20,0)")).alias("s"), F.count("*").alias("n")
    )
    by_place = {r["at"]: r for r in total.collect()}
    if not by_place or by_place[0]["n"] < 2:
        remove(spark, path)
        return nothing
    centre = Centre(by_place[0]["n"], tuple(int(by_place[i]["s"]) for i in range(length)))
    n = centre.n

    factors: list[np.ndarray] = []
    gram = _gram(fit_list, tasks, length, centre, _solved([]), length)[:, :length]
    trace = float(np.trace(gram)) / n
    for _ in range(3):
        factors.append(_cholesky(gram, n if not factors else length))
        gram = _gram(fit_list, tasks, length, centre, _solved(list(factors)), length)[:, :length]
    r = np.eye(length)
    for factor in factors:
        r = factor @ r
    # what rounding and shifts left of Q'Q goes into the product
    d, w = np.linalg.eigh((gram + gram.T) / 2)
    _, s, vt = np.linalg.svd((np.sqrt(np.maximum(d, 0))[:, None] * w.T) @ r)
    variances = s**2 / n
    kept = min(components, int((variances > RANK * max(trace, np.finfo(float).tiny)).sum()))
    axes, variances = vt[:kept].T, variances[:kept]
    error = 0.0
    if kept:
        project = axes / np.sqrt(variances)
        mean = _gram(fit_list, tasks, length, centre, lambda y: y @ project, kept)[:, kept] / n
        covariance = _gram(fit_list, tasks, length, centre, lambda y: y @ project - mean, kept)[:, :kept] / n
        error = float(np.abs(covariance - np.eye(kept)).max())
    remove(spark, path)
    return Whitening(length, centre, axes, variances, trace, error)


SCHEMA = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, model: Whitening, vec_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """One row per vector that takes part and component."""
    ship(vectors.sparkSession)
    whole = vectors.where(is_whole(F.col(vec_col)) & (F.size(vec_col) == model.length))
    rows = whole.select(F.col(id_col).cast("long").alias("vec_id"), ticks(F.col(vec_col)).alias("x"))
    kept = len(model.variances)
    if not kept:
        rows = rows.limit(0)
    project = model.axes / np.sqrt(model.variances)
    explained = model.variances / model.trace if kept else model.variances

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                x, n = matrix(part.column(1), model.length), part.num_rows
                every = np.repeat(np.arange(n), kept)
                yield pa.record_batch(
                    [
                        part.column(0).take(pa.array(every)),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * kept, model.centre.n, np.int64)),
                        pa.array(model.centre.deviation(x), pa.int64()).take(pa.array(every)),
                        pa.array((model.centre.centred(x) @ project).ravel()),
                        pa.array(np.tile(explained, n)),
                        pa.array(np.full(n * kept, model.identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(run, SCHEMA)
