"""MinHash near-dedup: chosen-path set similarity join.

A document is the set of its 5-word shingles (words ``[^\\x20\\x09-\\x0D]+``, A-Z in
lower case; fewer words: the whole sequence is the one shingle). Two documents
are linked if 100 * |A and B| >= PERCENT * |A or B|; the result names, for each
document, the smallest doc_id that links lead to.

1. Documents of equal sets are one *representative* from here on (its id is the
   least), so a group of copies is one row however large it is.
2. Each representative has a sketch: the least token of its set under each of
   ``COORDINATES`` hash functions. In each of ``TREES`` independent trees a node
   chooses coordinates by its own hash (1 / similarity of them on average), and a
   document goes on to the child named by its token there; from the second level
   on several such steps are taken at once (``TOKENS``). The path of a document
   depends on its own sketch alone, so branching needs no grouping; only node
   sizes are counted. Nodes of one document end, nodes of up to ``LEAF`` are
   compared exhaustively by their sketches, larger ones branch on. Before they do,
   all members of a large node are compared with ``LEADERS`` of it: members near
   enough to one (``ABSORB``) end there, because whatever they are linked to must,
   by the triangle inequality of the Jaccard distance, be so near to the same
   leader that it is connected with it as well. So a large group of near copies
   does not branch on and on. A node still larger after the last level is dealt to
   leaves with its first member in each; other trees deal it differently.
3. Pairs whose sketches agree well enough (six standard errors below the
   threshold, so that no true link is lost here) connect candidates. A leaf sends
   a star per connected group, never all pairs. Connected components of these are
   *clusters*: every true link that a tree caught lies within one.
4. A cluster's full sets meet once, and the exact links are found by search from
   document to document, each against the rest of the cluster not yet reached. A
   cluster beyond ``CLUSTER_SETS`` or ``CLUSTER_SHINGLES`` does not fit a task:
   the search is spread out (``_confirm_spread``) and stays exact. Sets that share
   one of their rarest shingles meet by a join on it; those whose rarest shingles
   are common to more than ``HOT`` sets form families, cut into blocks that fit a
   task, and every two blocks of a family meet once.

Defined results
  * null or empty text, or white space only: empty set, linked with nothing (a
    component of its own, kept); null ``doc_id``: after all ids; a component of
    such rows alone has a null component_id, and all of them are kept;
  * equal ids (repeated rows): equal results each;
  * ties: the smallest id stays; an empty table: no rows;
  * extra columns, whatever their names, are not read; ``keep_one`` returns them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlake.llm import _kernel as k
from playlake.llm._ship import lean, lean_group, ship, small_batches
from playlake.session import scratch_path
from playlake.sources.layers import remove

SHINGLE = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
TREES, LEAF = 12, 512
#: Tokens that a child is named by, level by level: larger nodes part faster further down.
TOKENS = (1, 2, 4, 8)
#: Members of a large node that all others are compared with.
LEADERS = 16
#: Sketch: coordinates that trees branch on, coordinates that leaves compare.
COORDINATES, COMPARED = 64, 128
#: Largest cluster whose full sets meet in one task.
CLUSTER_SETS, CLUSTER_SHINGLES = 65_536, 4_000_000
#: Component search: edges beyond which a vertex is hot, most hot vertices (their keys are broadcast).
HOT_EDGES, HOT_VERTICES = 512, 100_000
#: Ids that may be broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000
#: A cluster beyond a task: most sets that a shingle joins pair by pair, shingles of a block of sets.
HOT, BLOCK_SHINGLES = 64, 500_000
#: There: leaders of a shingle's sets that the others are confirmed against, pairs for each copy of a leader's set.
FIRST_LEADERS, PAIRS = 4, 1024
_PASS = 256 << 10
_GROUP_BYTES = 16 << 20

_MULTIPLIERS = np.random.Generator(np.random.PCG64(85)).integers(1, 2**63, COMPARED, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sets(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, last text, distinct shingles, bounds) for runs of texts."""
    raw, bounds = k.text_bytes(column)
    for a, b in k.slices(bounds, _PASS):
        low = bounds[a]
        tokens, _, _, of_text = k.words(raw[low : bounds[b]], bounds[a : b + 1] - low, lower=True)
        yield a, b, *k.distinct(*k.shingles(tokens, of_text, SHINGLE))


def _keys(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits that name a set: two sums of independently mixed shingles, with its size."""
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        out[some, 0] = np.add.reduceat(k.mix(values ^ np.uint64(0x5851F42D4C957F2D)), bounds[some])
        out[some, 1] = np.add.reduceat(k.mix(values * np.uint64(0xDA942042E4DD58B5)), bounds[some])
    return out


def _binary(rows: np.ndarray, valid: np.ndarray) -> pa.Array:
    """An (n, width) array as n binary values, null where not valid."""
    return pa.array([x.tobytes() if v else None for x, v in zip(rows, valid, strict=True)], pa.binary())


def _key_column(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    keys, sizes = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)]
    for _, _, values, bounds in _sets(column):
        keys.append(_keys(values, bounds))
        sizes.append(np.diff(bounds))
    size = np.concatenate(sizes)
    return _binary(np.concatenate(keys), size > 0), size


def sketches(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """doc_id, n_shingles, key of the set, sketch for branching, sketch for comparing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for a, b, values, bounds in _sets(batch.column(1)):
                size = np.diff(bounds)
                some = size > 0
                least = np.zeros((b - a, COMPARED), np.uint32)
                if some.any():
                    at = bounds[:-1][some]
                    for j, m in enumerate(_MULTIPLIERS):
                        least[some, j] = np.minimum.reduceat((values * m) >> np.uint64(32), at)
                branch = pa.ListArray.from_arrays(
                    pa.array(np.arange(b - a + 1, dtype=np.int32) * COORDINATES),
                    pa.array(np.ascontiguousarray(least[:, :COORDINATES]).view(np.int32).ravel()),
                )
                yield pa.record_batch(
                    [
                        ids.slice(a, b - a),
                        pa.array(size.astype(np.int64)),
                        _binary(_keys(values, bounds), some),
                        branch,
                        _binary((least & np.uint32(0xFF)).astype(np.uint8), some),
                    ],
                    names=["doc_id", "n_shingles", "key", "branch", "compact"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        lean(run), "doc_id long, n_shingles long, key binary, branch array<int>, compact binary"
    )


class _Scratch:
    """Intermediate tables, written to the shared folder and read again: short
    lineage, and a lost executor costs the tasks of one step at most."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.tables = spark, scratch_path(spark, "near-dup"), 0

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{self.root}/{self.tables}-{label}"
        self.tables += 1
        df.write.parquet(path)
        return self.spark.read.parquet(path)

    def result(self, df: DataFrame) -> DataFrame:
        """``df`` kept, all other tables removed."""
        path = scratch_path(self.spark, "near-dup-result")
        df.write.parquet(path)
        remove(self.spark, self.root)
        return self.spark.read.parquet(path)


def _children(node: Column, branch: Column, percent: int, tokens: int = 1) -> Column:
    """A node's children for one document, each named by ``tokens`` tokens.

    (100 / percent) ** tokens of them on average, at coordinates that the node's
    hash chooses, the same for all its documents.
    """
    expected = (100 / percent) ** tokens

    def child(number: int) -> Column:
        at = [F.pmod(F.xxhash64(node, F.lit(number), F.lit(i)), F.lit(COORDINATES)).cast("int") for i in range(tokens)]
        return F.xxhash64(node, F.lit(number), *(F.get(branch, x) for x in at))

    whole = int(expected)
    more = F.when(F.pmod(F.xxhash64(node, F.lit("more")), F.lit(1000)) < round(1000 * (expected - whole)), child(whole))
    return F.array_compact(F.array(*(child(i) for i in range(whole)), more))


def _thresholds(percent: int) -> tuple[float, float]:
    """Shares of equal compact coordinates: of a member that a leader absorbs, of one that is connected with it.

    Absorbed: estimated at the link threshold. Four standard errors below that, and
    one link further, is what a partner of an absorbed member may be away at most.
    """

    def error(j: float) -> float:
        return 4 * math.sqrt(j * (1 - j) / COMPARED)

    absorb = percent / 100
    partner = absorb - error(absorb) - (1 - percent / 100)
    reach = max(0.1, partner - error(max(partner, 0.1)))
    return tuple(j + (1 - j) / 256 for j in (absorb, reach))


def _absorb(store: "_Scratch", large: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """(node, key, branch, absorbed, near): each member of a large node against the node's leaders.

    ``near`` is the first leader that the member is connected with; where it is
    connected with several, these are connected by further rows without a node.
    """
    absorb, reach = _thresholds(percent)
    chosen = large.groupBy("node").agg(
        *(F.min(F.struct(F.xxhash64("key", F.lit(i)).alias("h"), "key")).alias(f"l{i}") for i in range(LEADERS))
    )
    leaders = chosen.select("node", F.explode(F.array_distinct(F.array(*(F.col(f"l{i}.key") for i in range(LEADERS))))).alias("key"))
    leaders = leaders.join(reps.select("key", "compact"), "key").groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("key", "compact"))).alias("leaders")
    )
    members = large.select("node", "key").join(reps.select("key", "branch", "compact"), "key").join(leaders, "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            own = np.frombuffer(b"".join(batch.column("compact").to_pylist()), np.uint8).reshape(n, COMPARED)
            near, absorbed, pairs = [], np.zeros(n, bool), set()
            for i, row in enumerate(batch.column("leaders").to_pylist()):
                others = np.frombuffer(b"".join(x["compact"] for x in row), np.uint8).reshape(len(row), COMPARED)
                share = (others == own[i]).sum(axis=1) / COMPARED
                absorbed[i] = bool((share >= absorb).any())
                reached = [x["key"] for x, s in zip(row, share, strict=True) if s >= reach]
                near.append(reached[0] if reached else None)
                pairs.update(zip(reached, reached[1:], strict=False))
            extra = sorted(pairs)
            yield pa.record_batch(
                [
                    pa.concat_arrays([batch.column("node"), pa.nulls(len(extra), pa.int64())]),
                    pa.array(batch.column("key").to_pylist() + [x for x, _ in extra], pa.binary()),
                    pa.concat_arrays([batch.column("branch"), pa.nulls(len(extra), batch.column("branch").type)]),
                    pa.array([*absorbed.tolist(), *[True] * len(extra)], pa.bool_()),
                    pa.array(near + [y for _, y in extra], pa.binary()),
                ],
                names=["node", "key", "branch", "absorbed", "near"],
            )

    schema = "node long, key binary, branch array<int>, absorbed boolean, near binary"
    return store.keep(members.select("node", "key", "branch", "compact", "leaders").mapInArrow(lean(run), schema), "leaders")


def _leaves(
    store: "_Scratch", reps: DataFrame, percent: int, trees: int, leaf: int, tokens: tuple[int, ...]
) -> tuple[DataFrame, DataFrame | None]:
    """(node, key): the members of all nodes of 2 to ``leaf`` documents; and links (a, b) with leaders of larger ones."""
    roots = F.transform(F.sequence(F.lit(1), F.lit(trees)), lambda t: F.xxhash64(F.lit("tree"), t))
    rows = reps.select(
        "key", F.explode(F.array_distinct(F.flatten(F.transform(roots, lambda n: _children(n, F.col("branch"), percent, tokens[0]))))).alias("node")
    )
    found, stars = [], []
    for level in range(1, len(tokens) + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        members = store.keep(rows.join(sizes, "node"), f"level{level}")
        found.append(members.where(F.col("size") <= leaf).select("node", "key"))
        large = members.where(F.col("size") > leaf)
        if large.isEmpty():
            break
        compared = _absorb(store, large, reps, percent)
        near = compared.where("key != near")
        stars.append(near.select(F.least("key", "near").alias("a"), F.greatest("key", "near").alias("b")))
        rest = compared.where("not absorbed")
        if level == len(tokens):
            # to leaves, each with the first member
            sizes = rest.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("key").alias("first"))
            part = F.pmod(F.xxhash64("node", "key"), F.ceil(2 * F.col("size") / leaf))
            dealt = rest.join(sizes, "node").select(F.xxhash64("node", part).alias("node"), "key", "first")
            found.append(dealt.select("node", "key").unionByName(dealt.select("node", F.col("first").alias("key"))).distinct())
            break
        below = _children(F.col("node"), F.col("branch"), percent, tokens[level])
        rows = rest.select("key", F.explode(below).alias("node")).distinct()
    links = reduce(DataFrame.unionByName, stars).distinct() if stars else None
    return reduce(DataFrame.unionByName, found), links


def _agreement(percent: int) -> float:
    """Least share of equal compact coordinates of a candidate: six standard errors below the threshold."""
    j = percent / 100
    share = j + (1 - j) / 256
    return share - 6 * math.sqrt(share * (1 - share) / COMPARED)


def _compare_leaves(node: np.ndarray, compact: np.ndarray, least: float, stars: bool) -> tuple[np.ndarray, np.ndarray]:
    """Candidate pairs (row numbers) among the rows of each node; as stars of connected groups, or all."""
    order = np.argsort(node, kind="stable")
    _, first, size = np.unique(node[order], return_index=True, return_counts=True)
    need = math.ceil(least * COMPARED)
    lefts, rights = [], []
    two = first[size == 2]
    if len(two):
        a, b = order[two], order[two + 1]
        ok = (compact[a] == compact[b]).sum(axis=1) >= need
        lefts.append(a[ok])
        rights.append(b[ok])
    for f, n in zip(first[size > 2], size[size > 2], strict=True):
        rows = order[f : f + n]
        own = compact[rows]
        reached = np.zeros(n, bool)
        for i in range(n):
            if not stars:
                near = np.flatnonzero((own[i + 1 :] == own[i]).sum(axis=1) >= need) + i + 1
                lefts.append(np.full(len(near), rows[i]))
                rights.append(rows[near])
                continue
            if reached[i]:
                continue
            # search from i; all reached are linked to i
            reached[i], todo = True, [i]
            while todo:
                at = todo.pop()
                left = np.flatnonzero(~reached)
                near = left[(own[left] == own[at]).sum(axis=1) >= need]
                reached[near] = True
                todo += near.tolist()
                lefts.append(np.full(len(near), rows[i]))
                rights.append(rows[near])
    none = np.zeros(0, np.int64)
    return (np.concatenate(lefts), np.concatenate(rights)) if lefts else (none, none)


def _candidates(leaves: DataFrame, reps: DataFrame, percent: int, rows: int) -> DataFrame:
    """(a, b): candidate links, a < b."""
    groups = max(1, math.ceil(rows * (COMPARED + 32) / _GROUP_BYTES))
    full = leaves.join(reps.select("key", "compact"), "key").withColumn("group", F.pmod(F.col("node"), F.lit(groups)).cast("int"))
    least = _agreement(percent)

    def run(table: pa.Table) -> pa.Table:
        node = table.column("node").to_numpy()
        keys = np.array(table.column("key").to_pylist(), object)
        compact = np.frombuffer(b"".join(table.column("compact").to_pylist()), np.uint8).reshape(len(node), COMPARED)
        a, b = _compare_leaves(node, compact, least, True)
        x, y = keys[a], keys[b]
        swap = x > y
        x, y = np.where(swap, y, x), np.where(swap, x, y)
        return pa.table({"a": pa.array(x.tolist(), pa.binary()), "b": pa.array(y.tolist(), pa.binary())})

    return full.groupBy("group").applyInArrow(lean_group(run), "a binary, b binary").where("a != b").distinct()


def _with_least(edges: DataFrame, at: str, other: str, most: int) -> DataFrame:
    """``edges`` with m, the least ``other`` of their ``at`` (or ``at`` itself, if smaller).

    Vertices of more than ``most`` edges are few: their m is broadcast, so that the
    edges of a hot one stay in the tasks that read them; the others meet by a join.
    """
    least = edges.groupBy(at).agg(F.min(other).alias("m"), F.count(F.lit(1)).alias("edges"))
    least = least.select(at, F.least(at, "m").alias("m"), "edges")
    hot = F.broadcast(least.where(F.col("edges") > most).drop("edges"))
    rest = edges.join(hot.select(at), at, "left_anti").join(least.where(F.col("edges") <= most).drop("edges"), at)
    return edges.join(hot, at).unionByName(rest)


def components(store: _Scratch, edges: DataFrame, hot: int = HOT_EDGES) -> DataFrame:
    """(key, root): the least key of each vertex's connected component, by alternating stars.

    ``edges`` has a < b. Each round hangs every vertex's larger neighbours, then
    its smaller ones, on its least neighbour; rounds grow with the logarithm.
    A vertex of more than ``hot`` edges (more, where over ``HOT_VERTICES`` vertices
    could have that many) is not gathered.
    """
    edges, seen = store.keep(edges, "edges"), None
    count = edges.count()
    while True:
        most = max(hot, 2 * count // HOT_VERTICES)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _with_least(both, "a", "b", most).where("b > a and b != m").select(F.col("m").alias("a"), "b")
        large = store.keep(large, "large-stars")
        # small star: b's neighbours a < b
        joined = _with_least(large, "b", "a", most)
        small = joined.select(F.col("m").alias("a"), F.col("a").alias("b")).unionByName(joined.select(F.col("m").alias("a"), "b"))
        edges = store.keep(small.where("a != b").distinct(), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen, count = state, state[0]
    roots = edges.select(F.col("a").alias("key"), F.col("a").alias("root")).distinct()
    return edges.select(F.col("b").alias("key"), F.col("a").alias("root")).unionByName(roots)


def exact_components(values: np.ndarray, bounds: np.ndarray, percent: int) -> np.ndarray:
    """Component number of each set, by links confirmed on the full sets.

    Search from set to set: each one reached is compared with those not reached
    that can be linked to it at all. With shingles numbered from rare to common,
    two linked sets of sizes m and n have one in common among their first
    m - ceil(m * PERCENT / 100) + 1 and n - ... + 1 shingles, so an index of these
    finds all; the full sets then decide.
    """
    n, size = len(bounds) - 1, np.diff(bounds)
    _, ids, count = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    ids = rank[ids]
    owner = np.repeat(np.arange(n), size)
    order = np.lexsort((ids, owner))
    ids = ids[order]  # each set from rare to common
    first = size + (-percent * size) // 100 + 1
    in_first = np.arange(len(ids)) - np.repeat(bounds[:-1], size) < np.repeat(first, size)
    by_shingle = np.flatnonzero(in_first)[np.argsort(ids[in_first], kind="stable")]
    holders, starts = owner[by_shingle], np.searchsorted(ids[by_shingle], np.arange(len(count) + 1))
    label = np.full(n, -1, np.int64)
    flag = np.zeros(len(count) + 1, bool)
    left = n
    for seed in range(n):
        if label[seed] >= 0:
            continue
        label[seed], todo = seed, [seed]
        left -= 1
        while todo and left:
            at = todo.pop()
            mine = ids[bounds[at] : bounds[at + 1]]
            near = np.unique(holders[_ranges(starts[mine[: first[at]]], starts[mine[: first[at]] + 1])])
            near = near[label[near] < 0]
            near = near[(100 * np.minimum(size[near], size[at]) >= percent * np.maximum(size[near], size[at]))]
            if not len(near):
                continue
            flag[mine] = True
            edges = np.concatenate([[0], np.cumsum(size[near])])
            common = np.add.reduceat(flag[ids[_ranges(bounds[near], bounds[near + 1])]], edges[:-1], dtype=np.int64)
            flag[mine] = False
            near = near[100 * common >= percent * (size[at] + size[near] - common)]
            label[near] = seed
            left -= len(near)
            todo += near.tolist()
    return label


def _ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All numbers of several ranges, one after another."""
    sizes = ends - starts
    return np.arange(sizes.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)


def _full_sets(docs: DataFrame, members: DataFrame, text_col: str, id_col: str, rows: int) -> DataFrame:
    """(key, shingles) of the representatives ``members`` (key, min_doc): one row each."""
    ids = members.select(F.col("min_doc").alias("_id")).distinct()
    if rows <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    some = some.join(ids, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, values, bounds in _sets(batch.column(0)):
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64)))
                yield pa.record_batch([_binary(_keys(values, bounds), np.diff(bounds) > 0), lists], names=["key", "shingles"])

    sets = some.mapInArrow(lean(run), "key binary, shingles array<long>")
    return members.select("key", "min_doc").join(sets, "key").dropDuplicates(["key"])


def _confirm_clusters(sets: DataFrame, percent: int, shingles: int) -> DataFrame:
    """(key, component_id) of clusters whose full sets fit a task; ``sets`` also has cluster and min_doc."""
    groups = max(1, math.ceil(shingles * 8 / _GROUP_BYTES))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        cluster = np.array(table.column("cluster").to_pylist(), object)
        order = np.argsort(cluster, kind="stable") if len(cluster) else np.zeros(0, np.int64)
        keys, lowest = [], []
        _, first, size = np.unique(cluster[order], return_index=True, return_counts=True)
        for f, n in zip(first, size, strict=True):
            part = table.take(pa.array(order[f : f + n])).combine_chunks()
            lists = part.column("shingles").chunk(0)
            bounds = np.asarray(lists.offsets).astype(np.int64)
            values = np.asarray(lists.values)[bounds[0] : bounds[-1]]
            label = exact_components(values, bounds - bounds[0], percent)
            ids = np.asarray(part.column("min_doc").fill_null(np.iinfo(np.int64).max)).astype(np.int64)
            least = np.full(n, np.iinfo(np.int64).max, np.int64)
            np.minimum.at(least, label, ids)
            keys += part.column("key").to_pylist()
            lowest += least[label].tolist()
        ids = np.array(lowest, np.int64)
        return pa.table(
            {"key": pa.array(keys, pa.binary()), "component_id": pa.array(ids, pa.int64(), mask=ids == np.iinfo(np.int64).max)}
        )

    grouped = sets.withColumn("group", F.pmod(F.xxhash64("cluster"), F.lit(groups)).cast("int"))
    return grouped.groupBy("group").applyInArrow(lean_group(run), "key binary, component_id long")


def links_between(values: np.ndarray, bounds: np.ndarray, label: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (set numbers) that connect sets of different ``label``: enough to join all labels that any link joins."""
    n, size, label, found = len(bounds) - 1, np.diff(bounds), label.copy(), []
    _, ids, count = np.unique(values, return_inverse=True, return_counts=True)
    holders = np.repeat(np.arange(n), size)[np.argsort(ids, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(count)])
    for at in range(n):
        mine = ids[bounds[at] : bounds[at + 1]]
        common = np.bincount(holders[_ranges(starts[mine], starts[mine + 1])], minlength=n)
        linked = (label != label[at]) & (100 * common >= percent * (size + size[at] - common))
        for other in np.flatnonzero(linked):
            if label[other] != label[at]:
                found.append((at, int(other)))
                label[label == label[other]] = label[at]
    return found


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int, copies: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) that are links on the full sets; ``copies`` (b, copies): over how many copies of b its pairs are dealt."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    on = ["b"]
    if copies is not None:
        right = right.join(copies, "b").select("b", "y", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        on = ["b", "copy"]
    common = F.size(F.array_intersect("x", "y"))
    linked = 100 * common >= percent * (F.size("x") + F.size("y") - common)
    return pairs.join(left, "a").join(right, on).where(linked).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _labelled(store: _Scratch, sets: DataFrame, links: DataFrame, label: str) -> DataFrame:
    """(key, n, min_doc, root): each set with its component by ``links``; without any it is its own."""
    roots = components(store, links)
    own = sets.select("key", "min_doc", F.size("shingles").alias("n")).join(roots, "key", "left")
    return store.keep(own.withColumn("root", F.coalesce("root", "key")), label)


def _rarest(store: _Scratch, sets: DataFrame, percent: int) -> DataFrame:
    """(s, key, holders): the rarest shingles of each set, of which any two linked sets share one.

    As in ``exact_components``; ``holders`` sets have s among their rarest.
    """
    each = sets.select("key", F.size("shingles").alias("n"), F.explode("shingles").alias("s"))
    count = each.groupBy("s").agg(F.count(F.lit(1)).alias("c"))
    ranked = each.join(count, "s").groupBy("key", "n").agg(F.sort_array(F.collect_list(F.struct("c", "s"))).alias("r"))
    first = F.expr(f"int(n + 1 - (n * {percent} + 99) div 100)")
    rows = store.keep(ranked.select("key", F.explode(F.slice("r", F.lit(1), first)).alias("r")).select("r.s", "key"), "rarest")
    holders = rows.groupBy("s").agg(F.count(F.lit(1)).alias("holders")).where("holders > 1")
    return store.keep(rows.join(holders, "s"), "held")


def _links_to_leaders(store: _Scratch, sets: DataFrame, many: DataFrame, percent: int, hot: int) -> DataFrame:
    """(a, b): links of sets with a few leaders of each shingle that more than ``hot`` of them hold.

    The sets not linked to a leader choose new ones, as long as a tenth of them is
    linked in a round; each set has one row per leader and round.
    """
    links, rest, n = None, store.keep(many.select("s", "key"), "rest0"), 0
    while True:
        least = (F.min(F.struct(F.xxhash64("key", F.lit(n), F.lit(i)).alias("h"), "key")).alias(f"l{i}") for i in range(FIRST_LEADERS))
        chosen = rest.groupBy("s").agg(F.count(F.lit(1)).alias("holders"), *least).where(F.col("holders") > hot)
        keys = F.array_distinct(F.array(*(F.col(f"l{i}.key") for i in range(FIRST_LEADERS))))
        chosen = store.keep(chosen.select("s", "holders", F.explode(keys).alias("b")), "first-leaders")
        copies = chosen.groupBy("b").agg(F.ceil(F.max("holders") / PAIRS).cast("int").alias("copies"))
        led = rest.join(chosen.join(copies, "b").select("s", "b", "copies"), "s").where("key != b")
        pairs = led.select(F.col("key").alias("a"), "b", F.pmod(F.xxhash64("key"), "copies").cast("int").alias("copy")).distinct()
        found = store.keep(_confirmed(store.keep(pairs, "leader-pairs"), sets, percent, copies), "leader-links")
        links = found if links is None else links.unionByName(found)
        done = found.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        before = rest.select("key").distinct().count()
        n += 1
        rest = store.keep(rest.join(done, "key", "left_anti").select("s", "key"), f"rest{n}")
        after = rest.select("key").distinct().count()
        if not after or 10 * (before - after) < before:
            return links


def _links_of_families(store: _Scratch, sets: DataFrame, held: DataFrame, labels: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): links between different components among sets that shingles of many holders connect.

    A family is cut into blocks of about ``block`` shingles; a component of that
    size has blocks of its own, which need not meet each other.
    """
    first = held.groupBy("s").agg(F.min("key").alias("a"))
    edges = held.join(first, "s").where("a != key").select("a", F.col("key").alias("b")).distinct()
    family = components(store, edges).withColumnRenamed("root", "family").join(labels.select("key", "n", "root"), "key")
    family = store.keep(family, "families")
    several = family.groupBy("family").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y").select("family")
    size = family.groupBy("family", "root").agg(F.sum("n").alias("size")).join(several, "family")
    size = size.withColumn("own", F.when(F.col("size") >= block, F.col("root")).otherwise(F.lit(b"")))
    blocks = size.groupBy("family", "own").agg(F.ceil(F.sum("size") / block).alias("blocks"))
    number = F.pmod(F.xxhash64("key"), F.col("blocks"))
    dealt = family.join(size.select("family", "root", "own"), ["family", "root"]).join(blocks, ["family", "own"])
    dealt = store.keep(dealt.select("key", "root", "family", "own", F.xxhash64("family", "own", number).alias("block")), "blocks")
    each = dealt.select("family", "own", "block").distinct()
    meet = each.select("family", F.col("own").alias("o"), F.col("block").alias("i")).join(
        each.select("family", F.col("own").alias("p"), F.col("block").alias("j")), "family"
    ).where("i <= j and (o != p or o = X'')").select("i", "j")
    ways = meet.select(F.explode(F.array_distinct(F.array("i", "j"))).alias("block"), "i", "j")
    rows = dealt.select("key", "root", "block").join(sets.select("key", "shingles"), "key").join(ways, "block")

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lists = table.column("shingles").chunk(0)
        bounds = np.asarray(lists.offsets).astype(np.int64)
        values = np.asarray(lists.values)[bounds[0] : bounds[-1]]
        keys = table.column("key").to_pylist()
        _, label = np.unique(np.array(table.column("root").to_pylist(), object), return_inverse=True)
        found = [sorted((keys[x], keys[y])) for x, y in links_between(values, bounds - bounds[0], label, percent)]
        return pa.table({"a": pa.array([x for x, _ in found], pa.binary()), "b": pa.array([y for _, y in found], pa.binary())})

    return rows.select("i", "j", "key", "root", "shingles").groupBy("i", "j").applyInArrow(lean_group(run), "a binary, b binary")


def _confirm_spread(store: _Scratch, sets: DataFrame, percent: int, hot: int, block: int) -> DataFrame:
    """(key, component_id) for clusters beyond a task: an exact join on the rarest shingles.

    Large groups are first connected by leaders; pairs that are connected already
    are not compared again.
    """
    held = _rarest(store, sets, percent)
    many = held.where(F.col("holders") > hot).select("s", "key")
    near_leaders = _links_to_leaders(store, sets, many, percent, hot).distinct()
    labels = _labelled(store, sets, near_leaders, "led")
    sides = held.where(F.col("holders") <= hot).join(labels, "key")
    left = sides.select("s", F.col("key").alias("a"), F.col("n").alias("m"), F.col("root").alias("q"))
    right = sides.select("s", F.col("key").alias("b"), "n", "root")
    near = F.expr(f"a < b and q != root and 100 * least(m, n) >= {percent} * greatest(m, n)")
    pairs = store.keep(left.join(right, "s").where(near).select("a", "b").distinct(), "pairs")
    links = store.keep(_confirmed(pairs, sets, percent).unionByName(near_leaders), "links")
    labels = _labelled(store, sets, links, "labels")
    links = links.unionByName(_links_of_families(store, sets, many, labels, percent, block)).distinct()
    labels = _labelled(store, sets, links, "all-labels")
    least = labels.groupBy("root").agg(F.min("min_doc").alias("component_id"))
    return labels.join(least, "root").select("key", "component_id")


def classes(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    percent: int = PERCENT,
    trees: int = TREES,
    leaf: int = LEAF,
    tokens: tuple[int, ...] = TOKENS,
    cluster_sets: int = CLUSTER_SETS,
    cluster_shingles: int = CLUSTER_SHINGLES,
    hot: int = HOT,
    block: int = BLOCK_SHINGLES,
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, and the key of its set (null: empty)."""
    spark = docs.sparkSession
    ship(spark)
    small_batches(spark)
    store = _Scratch(spark)
    all_ = store.keep(sketches(docs, text_col, id_col), "sketches")
    reps = all_.where("key is not null").groupBy("key").agg(
        F.min("doc_id").alias("min_doc"), F.min("n_shingles").alias("n"), F.first("branch").alias("branch"), F.first("compact").alias("compact")
    )
    reps = store.keep(reps, "sets")
    leaves, links = _leaves(store, reps, percent, trees, leaf, tokens)
    rows = leaves.count()
    labels = reps.select("key", F.col("min_doc").alias("component_id"))
    if rows or links is not None:
        edges = _candidates(leaves, reps, percent, rows)
        if links is not None:
            edges = edges.unionByName(links).distinct()
        clusters = store.keep(components(store, edges), "clusters")
        members = clusters.join(reps.select("key", "min_doc", "n"), "key").withColumnRenamed("root", "cluster")
        sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("shingles"))
        members = store.keep(members.join(sizes, "cluster"), "members")
        whole = (F.col("sets") <= cluster_sets) & (F.col("shingles") <= cluster_shingles)
        figures = members.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.when(whole, 0).otherwise(1))).first()
        sets = _full_sets(docs, members, text_col, id_col, figures[0])
        found = _confirm_clusters(
            sets.join(members.where(whole).select(F.col("key"), "cluster"), "key"), percent, figures[1] or 1
        )
        if figures[2]:
            large = members.where(~whole)
            large_sets = store.keep(sets.join(large.select("key"), "key", "left_semi"), "large-sets")
            found = found.unionByName(_confirm_spread(store, large_sets, percent, hot, block))
        found = store.keep(found, "found")
        labels = labels.join(found.withColumnRenamed("component_id", "c"), "key", "left").select(
            "key", F.when(F.col("c").isNull(), F.col("component_id")).otherwise(F.col("c")).alias("component_id")
        )
    joined = all_.select("doc_id", "n_shingles", F.col("key").alias("set_key")).join(
        labels, F.col("set_key") == F.col("key"), "left"
    )
    component = F.when(F.col("set_key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return store.result(
        joined.select(
            "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "set_key"
        )
    )


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", percent: int = PERCENT, **limits) -> DataFrame:
    """One document of each component, with the columns it came with; documents without words all stay."""
    mark = "_near_dup"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    # Keys without nulls: the join and the removal of repeated rows share one exchange.
    keys = [f"{mark}_{x}" for x in ("no_id", "id", "key")]

    def named(doc_id: Column, key: Column) -> list[Column]:
        values = (doc_id.isNull(), F.coalesce(doc_id.cast("long"), F.lit(0)), key)
        return [value.alias(name) for value, name in zip(values, keys, strict=True)]

    found = classes(docs, text_col, id_col, percent, **limits).where("kept and set_key is not null")
    kept = found.select(*named(F.col("doc_id"), F.col("set_key"))).distinct()
    own = f"{mark}_set"
    schema = T.StructType([*docs.schema.fields, T.StructField(own, T.BinaryType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, _key_column(batch.column(at))[0]], names=[*batch.schema.names, own])

    rows = docs.mapInArrow(lean(run), schema).select(*docs.columns, *named(F.col(id_col), F.col(own)))
    one = rows.where(F.col(keys[2]).isNotNull()).join(kept, keys, "left_semi").dropDuplicates(keys)
    return one.unionByName(rows.where(F.col(keys[2]).isNull())).drop(*keys)
