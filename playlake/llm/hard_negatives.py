"""Hard-negative mining: score bounds along a spanning tree of the anchors.

Vectors count as whole numbers floor(256 * entry); a score is an inner product of
two of them, exact. Anchors (``anchor_of`` of the id) hang in minimum spanning
trees of at most about ``TREE`` anchors of one label, by Euclidean distance. A
candidate x that has the score s with a parent has a score within
s +- |parent - child| * |x| with its child, and an interval in place of s widens
likewise. A task walks each tree from its root, where it scores all of its
candidates; below, a candidate is scored exactly only if its interval overlaps
what the anchor still looks for, else the interval is handed down.

Two walks over all rows:

* positives: rows of the anchor's label; what is looked for are scores from the
  least of the task's best so far on;
* negatives: rows of other labels; looked for are scores in the window of one of
  the anchor's positives, not below the task's best so far in that window.

Each task sends on its best rows per anchor (and window); these are ranked once
more over all tasks. Anchors go in blocks of about ``BLOCK``, a walk over the rows
for each block; the driver holds one block of anchors at a time, broadcast to the
walk's tasks. The trees are built in groups, a tree in one task. No candidate
list is cut: what a bound leaves out cannot be among the best.

Defined results
  * null label, null vector, null or non-finite entry, or another length than most
    rows have (of equally frequent ones the longest): no part;
  * an entry beyond +-2^27 / 256 counts as that (a score then fits a long);
  * null ids: never anchors, last among equal scores; repeated ids and rows: each a
    row of its own; an anchor that repeats has its result as often, and the other
    copies are candidates for it;
  * a positive with a negative score has no window, one with score 0 only zeros;
  * an anchor without positives gives no row; empty table, no anchor, or vectors
    without entries: no rows;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from playlake.llm._ship import ship
from playlake.llm._vectors import common_length, is_whole, matrix
from playlake.session import scratch_path
from playlake.sources.layers import remove

#: Units of an entry, positives of an anchor, negatives of a positive,
#: and the window of negatives in per cent of the positive's score.
UNITS, POSITIVES, NEGATIVES = 256, 5, 10
LEAST, MOST = 30, 90
#: Anchors of a tree, anchors of a walk, candidates that go through a tree together.
TREE, BLOCK, CANDIDATES = 1024, 16384, 8192
_LIMIT = 2.0**27
_LOW, _HIGH = -(2**62), 2**62


def units(vec: Column) -> Column:
    """The vector in whole units (int)."""
    limit = F.lit(_LIMIT)
    return F.transform(
        vec.cast("array<double>"), lambda c: F.floor(F.greatest(F.least(c * UNITS, limit), -limit)).cast("int")
    )


def _spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in walking order (a parent before its children), each one's parent's place, and edge length."""
    n, point = len(points), points.astype(np.float64)
    near, parent = np.full(n, np.inf), np.zeros(n, np.int64)
    inside, children, edge = np.zeros(n, bool), [[] for _ in range(n)], np.zeros(n)
    now = 0
    for _ in range(n):
        inside[now] = True
        if now:
            children[parent[now]].append(now)
            edge[now] = near[now]
        far = np.sqrt(((point - point[now]) ** 2).sum(1))
        closer = ~inside & (far < near)
        near[closer], parent[closer] = far[closer], now
        now = int(np.where(inside, np.inf, near).argmin())
    order, stack = [], [0]
    while stack:
        order.append(at := stack.pop())
        stack += children[at]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return np.array(order), place[parent[order]], edge[order]


TREE_SCHEMA = "tree long, place long, parent long, edge double, anchor_id long, label long, copies long, x array<int>"


def _tree(table: pa.Table) -> pa.Table:
    x = matrix(table.column("x").combine_chunks(), len(table.column("x")[0]))
    first = np.lexsort([*x.T[::-1], table.column("anchor_id").to_numpy()])  # the same tree whatever the order of rows
    order, parent, edge = _spanning_tree(x[first])
    rows = table.take(pa.array(first[order]))
    return pa.table(
        {
            "tree": rows.column("tree"), "place": pa.array(np.arange(len(order))), "parent": pa.array(parent), "edge": pa.array(edge),
            "anchor_id": rows.column("anchor_id"), "label": rows.column("label"), "copies": rows.column("copies"),
            "x": rows.column("x"),
        }
    )


@dataclass(frozen=True)
class Anchors:
    """One block: anchors in walking order, tree after tree."""

    x: np.ndarray
    parent: np.ndarray  # place of the parent in the block, -1 at a root
    edge: np.ndarray
    label: np.ndarray
    last_child: np.ndarray  # place of the last child, its own place without children

    @staticmethod
    def of(rows: list, length: int) -> Anchors:
        start, at = {}, 0
        for i, r in enumerate(rows):
            start.setdefault(r["tree"], i)
        parent = np.array([start[r["tree"]] + r["parent"] if r["place"] else -1 for r in rows], np.int64)
        last = np.arange(len(rows))
        for at, up in enumerate(parent.tolist()):
            if up >= 0:
                last[up] = at
        x = np.array([r["x"] for r in rows], np.int64).reshape(len(rows), length)
        return Anchors(x, parent, np.array([r["edge"] for r in rows]), np.array([r["label"] for r in rows], np.int64), last)


class Best:
    """The best rows by score, then smaller id, of each list."""

    def __init__(self, lists: int, most: int):
        self.score = np.full((lists, most), _LOW, np.int64)
        self.id = np.zeros((lists, most), np.int64)
        self.no_id = np.zeros((lists, most), bool)  # null ids come last among equal scores
        self.size = np.zeros(lists, np.int64)
        self.most = most

    def floor(self, at: int) -> int:
        """Scores below this cannot enter the list any more."""
        return int(self.score[at, -1]) if self.size[at] == self.most else _LOW

    def add(self, at: int, score: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        if len(score) > 4 * self.most:  # keep what the best scores among these allow
            least = np.partition(score, len(score) - self.most)[len(score) - self.most]
            some = score >= least
            score, ids, no_id = score[some], ids[some], no_id[some]
        n = self.size[at]
        score = np.concatenate([self.score[at, :n], score])
        ids = np.concatenate([self.id[at, :n], ids])
        no_id = np.concatenate([self.no_id[at, :n], no_id])
        order = np.lexsort([ids, no_id, -score])[: self.most]
        n = self.size[at] = len(order)
        self.score[at, :n], self.id[at, :n], self.no_id[at, :n] = score[order], ids[order], no_id[order]

    def batch(self) -> pa.RecordBatch:
        held = np.arange(self.most) < self.size[:, None]
        at = np.repeat(np.arange(len(self.size)), self.size)
        return pa.record_batch(
            [pa.array(at), pa.array(self.score[held]), pa.array(self.id[held], mask=self.no_id[held])], names=["at", "score", "id"]
        )


def _walk(
    anchors: Anchors, x: np.ndarray, wanted: Callable[[int], tuple[int, int]], take: Callable[[int, np.ndarray, np.ndarray], None],
    may: Callable[[int], np.ndarray],
) -> int:
    """Walk the trees with candidates ``x``; the number of scores worked out.

    ``wanted(a)``: the least and greatest score that anchor ``a`` looks for;
    ``may(a)``: candidates that its label allows; ``take(a, rows, scores)``.
    """
    norm = np.sqrt((x.astype(np.float64) ** 2).sum(1)) * (1 + 1e-9)
    exact = np.float64 if x.size and float(np.abs(x).max()) * float(np.abs(anchors.x).max()) * x.shape[1] < 2**53 else np.int64
    x, points = x.astype(exact), anchors.x.astype(exact)
    bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    scored = 0
    for a, up in enumerate(anchors.parent.tolist()):
        least, greatest = wanted(a)
        if up < 0:
            score = x @ points[a]
            low, high = score.astype(np.float64), score.astype(np.float64)
            scored += len(x)
            rows = np.flatnonzero(may(a) & (score >= least) & (score <= greatest))
            score = score[rows]
        else:
            reach = norm * (anchors.edge[a] * (1 + 1e-9)) + 1
            low, high = bounds[up][0] - reach, bounds[up][1] + reach
            open_ = np.flatnonzero(may(a) & (high >= least) & (low <= greatest))
            score = x[open_] @ points[a]
            scored += len(open_)
            low[open_], high[open_] = score, score
            inside = (score >= least) & (score <= greatest)
            rows, score = open_[inside], score[inside]
            if anchors.last_child[up] == a:
                del bounds[up]
        if anchors.last_child[a] != a:
            bounds[a] = (low, high)
        if len(rows):
            take(a, rows, score.astype(np.int64))
    return scored


def _candidates(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(x, label, id, id is null) of candidates, some thousands at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, CANDIDATES):
            part = batch.slice(start, CANDIDATES)
            ids = part.column(0)
            yield (
                matrix(part.column(2), length).astype(np.int64),
                part.column(1).to_numpy(zero_copy_only=False).astype(np.int64),
                ids.fill_null(0).to_numpy(zero_copy_only=False),
                ids.is_null().to_numpy(zero_copy_only=False),
            )


_BEST = "at long, score long, id long"


def _positives(rows: DataFrame, anchors: Anchors, most: int) -> DataFrame:
    """(at, score, id): each task's best rows of the anchor's label."""
    length = anchors.x.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(anchors.x), most)
        for x, label, ids, no_id in _candidates(batches, length):
            of_label = {v: label == v for v in np.unique(anchors.label).tolist()}
            _walk(
                anchors, x, lambda a: (best.floor(a), _HIGH),
                lambda a, i, score: best.add(a, score, ids[i], no_id[i]), lambda a: of_label[int(anchors.label[a])],  # noqa: B023
            )
        yield best.batch()

    return rows.mapInArrow(run, _BEST)


def _negatives(rows: DataFrame, anchors: Anchors, positives: np.ndarray, most: int) -> DataFrame:
    """(at, score, id): each task's best rows of other labels in window ``at`` = anchor * columns + column.

    ``positives``: the scores of each anchor's positives, a negative number where there is none.
    """
    length, columns = anchors.x.shape[1], positives.shape[1]
    low, high = -(-LEAST * positives // 100), MOST * positives // 100
    none = positives < 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(positives.size, most)

        def windows(a: int) -> list[tuple[int, int, int]]:
            return [
                (at := a * columns + j, max(int(low[a, j]), best.floor(at)), int(high[a, j])) for j in range(columns) if not none[a, j]
            ]

        def wanted(a: int) -> tuple[int, int]:
            found = [(lo, hi) for _, lo, hi in windows(a) if lo <= hi]
            return (min(lo for lo, _ in found), max(hi for _, hi in found)) if found else (_HIGH, _LOW)

        for x, label, ids, no_id in _candidates(batches, length):
            of_label = {v: label != v for v in np.unique(anchors.label).tolist()}

            def take(a: int, i: np.ndarray, score: np.ndarray) -> None:
                for at, lo, hi in windows(a):
                    some = (score >= lo) & (score <= hi)
                    if some.any():
                        best.add(at, score[some], ids[i[some]], no_id[i[some]])  # noqa: B023

            _walk(anchors, x, wanted, take, lambda a: of_label[int(anchors.label[a])])  # noqa: B023
        yield best.batch()

    return rows.mapInArrow(run, _BEST)


def _first(best: DataFrame, most: int) -> DataFrame:
    """The best rows of each list over all tasks, numbered from 1."""
    order = Window.partitionBy("at").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def is_anchor(vec_id: Column) -> Column:
    return vec_id % 100 == 0


def noisy_label(vec_id: Column, label: Column) -> Column:
    """The label as the search sees it: moved on by one for every seventh id."""
    return F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)


SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    vectors: DataFrame,
    vec_col: str = "embedding",
    id_col: str = "vec_id",
    label_col: str = "label",
    relabel: Callable[[Column, Column], Column] = noisy_label,
    anchor_of: Callable[[Column], Column] = is_anchor,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    block: int = BLOCK,
    tree: int = TREE,
) -> DataFrame:
    """One row per anchor, positive and negative: ``SCHEMA``."""
    spark = vectors.sparkSession
    ship(spark)
    vec_id, label = F.col(id_col).cast("long"), F.col(label_col).cast("long")
    whole = vectors.where(label.isNotNull() & is_whole(F.col(vec_col)))
    length = common_length(whole, vec_col)
    if not length:
        return _nothing(spark)
    of_length = whole.where(F.size(vec_col) == length)
    rows = of_length.select(vec_id.alias("id"), relabel(vec_id, label).alias("label"), units(F.col(vec_col)).alias("x"))
    root = scratch_path(spark, "hard-negatives")
    anchors = rows.where(anchor_of(F.col("id"))).groupBy(F.col("id").alias("anchor_id"), "label", "x").agg(F.count("*").alias("copies"))
    anchors.write.parquet(f"{root}/anchors")
    anchors = spark.read.parquet(f"{root}/anchors")
    n = anchors.count()
    if not n:
        remove(spark, root)
        return _nothing(spark)
    salts, blocks = -(-n // tree), -(-n // block)
    salt = F.pmod(F.xxhash64("anchor_id", "x"), F.lit(salts))
    dealt = anchors.withColumn("tree", salt * 2**32 + F.col("label").cast("long") + 2**31).withColumn("block", F.pmod(salt, F.lit(blocks)))
    dealt = dealt.select("block", "tree", "anchor_id", "label", "copies", "x")
    grown = dealt.groupBy("block", "tree").applyInArrow(lambda key, t: _with_block(key, _tree(t)), f"block long, {TREE_SCHEMA}")
    grown.write.partitionBy("block").parquet(f"{root}/trees")
    trees = spark.read.schema(f"{TREE_SCHEMA}, block long").parquet(f"{root}/trees")
    for at in range(blocks):
        _mine_block(spark, rows, trees.where(F.col("block") == at), f"{root}/{at}", length, n_positives, n_negatives).write.mode(
            "append"
        ).parquet(f"{root}/found")
        remove(spark, f"{root}/{at}")
    remove(spark, f"{root}/anchors")
    remove(spark, f"{root}/trees")
    return spark.read.schema(SCHEMA).parquet(f"{root}/found")


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in SCHEMA.split(", ")])


def _with_block(key: tuple, table: pa.Table) -> pa.Table:
    return table.add_column(0, "block", pa.array(np.full(len(table), key[0].as_py(), np.int64)))


def _mine_block(spark: SparkSession, rows: DataFrame, trees: DataFrame, root: str, length: int, n_positives: int, n_negatives: int) -> DataFrame:
    held = trees.orderBy("tree", "place").collect()
    anchors = Anchors.of(held, length)
    # The anchor itself is one of its label: it is among one more than asked for, or not among them at all.
    _first(_positives(rows, anchors, n_positives + 1), n_positives + 1).write.parquet(f"{root}/positives")
    names = spark.createDataFrame([(i, r["anchor_id"], int((anchors.x[i] ** 2).sum()), r["copies"]) for i, r in enumerate(held)],
                                  "at long, anchor_id long, own long, copies long")
    names.write.parquet(f"{root}/names")
    names = spark.read.parquet(f"{root}/names")
    listed = spark.read.parquet(f"{root}/positives").join(names, "at")
    same = (F.col("id") == F.col("anchor_id")) & (F.col("score") == F.col("own"))
    own = Window.partitionBy("at").orderBy(same.desc(), "rank")
    others = listed.withColumn("self", same & (F.row_number().over(own) == 1)).where(~F.col("self"))
    place = F.row_number().over(Window.partitionBy("at").orderBy("rank"))
    others = others.withColumn("column", place - 1).where(F.col("column") < n_positives)
    others.select("at", "column", "anchor_id", "copies", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")).write.parquet(
        f"{root}/others"
    )
    others = spark.read.parquet(f"{root}/others")
    scores = np.full((len(held), n_positives), -1, np.int64)
    for r in others.select("at", "column", "positive_score").collect():
        scores[r["at"], r["column"]] = r["positive_score"]
    best = _first(_negatives(rows, anchors, scores, n_negatives), n_negatives)
    found = best.select(
        F.floor(F.col("at") / n_positives).alias("at"), (F.col("at") % n_positives).cast("int").alias("column"), "rank",
        F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
    ).join(others, ["at", "column"])
    copies = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return copies.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
