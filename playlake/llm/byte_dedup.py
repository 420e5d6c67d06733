"""Suffix-array dedup: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every whole text is its UTF-8 bytes. A byte goes if a string of ``MIN_BYTES``
bytes that covers it also starts in a document with a smaller id; strings never
cross documents and are judged on the input. ``_repeats`` brings together the
places that can be equal; here each such group of strings becomes one generalised
suffix array with its Burrows-Wheeler transform, in which the anchor that a
group shares is one symbol. Intervals of suffixes that share a prefix are extended
backward, breadth first, one symbol a round: round n finds exactly the neighbours
whose common prefix has n symbols, so common prefixes come out by increasing
length, and the rounds stop at the threshold. The neighbours that no round has
parted share ``MIN_BYTES`` bytes or more; each such run gives its strings the least
id in it.

Defined results
  * null or empty text: 0 bytes, nothing removed; shorter than ``MIN_BYTES``:
    nothing removed;
  * equal ids (repeated rows): neither is smaller, so they remove nothing from
    each other; null id: after all others;
  * overlapping strings: their union is removed; an empty table: no rows;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playlake.llm import _repeats

#: Fixed value: the shortest string that counts.
MIN_BYTES = 50
#: Anchors are the least of the grams of this many bytes.
GRAM = 20


def suffix_array(strings: np.ndarray, group: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes of the rows of a matrix of symbols below 511, by group, then by their first ``depth`` symbols.

    A suffix ends with its row, and the row's number breaks ties. Prefixes of 4
    symbols are ranked, then doubled until they reach the depth.
    """
    n, width = strings.shape
    key = np.zeros((n, width + 1), np.uint64)
    for i in range(4):  # 9 bits each: 0 is past the end
        key[:, : width - i] |= (strings[:, i:].astype(np.uint64) + np.uint64(1)) << np.uint64(9 * (3 - i))
    key |= group.astype(np.uint64)[:, None] << np.uint64(36)
    step = 4
    while step < depth:
        rank = np.unique(key.ravel(), return_inverse=True)[1].reshape(n, width + 1).astype(np.uint64)
        key = rank << np.uint64(32)
        key[:, : width + 1 - step] |= rank[:, step:]
        # past the end: the group's own empty suffix, least of its ranks
        key[:, width + 1 - step :] |= rank[:, width:]
        step *= 2
    return np.argsort(key[:, :width].ravel(), kind="stable").astype(np.int32)


def expand_intervals(strings: np.ndarray, group: np.ndarray, order: np.ndarray, threshold: int) -> np.ndarray:
    """For each neighbour pair in suffix order: do they share ``threshold`` symbols or more?

    Breadth-first backward extension. After round n the suffixes that share n
    symbols form intervals; ``label`` names each suffix's interval by its first
    place. Backward extension by a symbol maps the interval of w to that of cw:
    two neighbours that start with the same symbol share n + 1 symbols exactly if
    their remainders, one symbol shorter, lie in one interval of n. Only pairs
    that no round has parted yet are looked at.
    """
    n, width = strings.shape
    size = n * width
    place = np.empty(size, np.int32)
    place[order] = np.arange(size, dtype=np.int32)
    # The transform as a map: where a suffix's remainder stands; past the row's end nothing equals anything.
    remainder = place[np.minimum(order + 1, size - 1)]
    last = order % width == width - 1
    first = strings.ravel()[order].astype(np.int64) + (group[order // width].astype(np.int64) << 9)
    alike = np.zeros(size, bool)
    alike[1:] = first[1:] == first[:-1]
    label = np.arange(size, dtype=np.int32)
    active = np.flatnonzero(alike).astype(np.int32)
    _first_places(label, active)
    # where a row ends, a pair shares one symbol and no more
    ends = last[active] | last[active - 1]
    gone, active = active[ends], active[~ends]
    one, two = remainder[active - 1], remainder[active]
    for _ in range(threshold - 1):
        if not len(active):
            break
        same = label[one] == label[two]
        label[gone] = gone
        gone = active[~same]
        active, one, two = active[same], one[same], two[same]
        label[gone] = gone
        _first_places(label, active)
    together = np.zeros(size, bool)
    together[active] = True
    return together


def _first_places(label: np.ndarray, active: np.ndarray) -> None:
    """Name each suffix's interval by its first place; ``active`` are the places that share one with the place before."""
    if len(active):
        begins = np.ones(len(active), bool)
        begins[1:] = active[1:] != active[:-1] + 1
        label[active] = np.maximum.accumulate(np.where(begins, active - 1, 0))


def resolve(contexts: np.ndarray, least: np.ndarray, group: np.ndarray, window: int = MIN_BYTES) -> np.ndarray:
    """Least id over all occurrences of each window of each context.

    All contexts of a group have the same anchor in the same place, and every
    window covers it: the anchor counts as one symbol, and a window of ``window``
    bytes as so many symbols less.
    """
    n, width = contexts.shape
    offsets = width - window + 1
    gram = window - offsets + 1
    strings = np.empty((n, width - gram + 1), np.uint16)
    strings[:, : offsets - 1] = contexts[:, : offsets - 1]
    strings[:, offsets - 1] = 256
    strings[:, offsets:] = contexts[:, offsets - 1 + gram :]
    symbols = window - gram + 1
    order = suffix_array(strings, group, symbols)
    together = expand_intervals(strings, group, order, symbols)
    run = np.cumsum(~together) - 1
    ids = least[order // strings.shape[1]]
    smallest = np.full(run[-1] + 1, _repeats.NO_ID, np.int64)
    np.minimum.at(smallest, run, ids)
    of_suffix = np.empty(strings.size, np.int64)
    of_suffix[order] = smallest[run]
    return of_suffix.reshape(strings.shape)[:, :offsets]


SCHEMA = "doc_id long, n_bytes long, removed_starts array<long>, removed_ends array<long>, kept binary"


def _finish(block: _repeats.Block, covered: np.ndarray) -> pa.Table:
    bounds, n = block.bounds, len(block.ids)
    sizes = np.diff(bounds)
    # removed runs do not cross texts
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    inner = bounds[1:-1]
    inner = inner[inner < len(covered)]
    opens[inner] = covered[inner]
    closes = covered.copy()
    closes[:-1] &= ~covered[1:]
    last = bounds[1:][sizes > 0] - 1
    closes[last] = covered[last]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    of_run = np.searchsorted(starts, bounds).astype(np.int32)
    owner = np.repeat(np.arange(n), np.diff(of_run))
    kept = block.raw[~covered]
    kept_bounds = np.zeros(n + 1, np.int64)
    gone = np.zeros(len(covered) + 1, np.int64)
    np.cumsum(covered, out=gone[1:])
    kept_bounds[:] = bounds - gone[bounds]
    lists = [pa.ListArray.from_arrays(pa.array(of_run), pa.array(x - bounds[owner])) for x in (starts, ends)]
    binary = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(kept_bounds.tobytes()), pa.py_buffer(kept.tobytes())])
    return pa.table(
        {
            "doc_id": pa.array(block.ids, pa.int64(), mask=block.null_id),
            "n_bytes": pa.array(sizes.astype(np.int64)),
            "removed_starts": lists[0],
            "removed_ends": lists[1],
            "kept": binary.cast(pa.binary()),
        }
    )


def dedup(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_bytes: int = MIN_BYTES, **limits) -> DataFrame:
    """One row per document: n_bytes, the removed runs (byte positions in the text) and the bytes kept."""
    hot = {x: limits.pop(x) for x in ("hot_blocks", "hot_crowded", "crowd") if x in limits}
    gram = min(GRAM, min_bytes)
    # a context's windows must fit the 32 bits of an answer
    gram = max(gram, min_bytes - 31)
    plan = _repeats.Plan(min_bytes, gram, False, functools.partial(resolve, window=min_bytes), **hot)
    return _repeats.dedup(docs, plan, _finish, SCHEMA, text_col, id_col, **limits)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (
  SELECT r, doc_id, p, substr(h, CAST(2 * p + 1 AS BIGINT), 100) AS s
  FROM (SELECT r, doc_id, h, unnest(range(0, CAST(length(h) / 2 - 49 AS BIGINT))) AS p FROM d WHERE length(h) >= 100)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT DISTINCT w.r, w.p FROM w JOIN m USING (s) WHERE m.least < w.doc_id OR (w.doc_id IS NULL AND m.least IS NOT NULL)),
runs AS (
  SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 50 THEN 0 ELSE 1 END AS new FROM hit),
grouped AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM runs),
spans AS (SELECT r, g, min(p) AS a, max(p) + 50 AS b FROM grouped GROUP BY r, g),
gaps AS (
  SELECT r, g, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
kept AS (
  SELECT d.r, string_agg(substr(d.h, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS head,
         max(b) AS last, sum(b - a) AS removed, count(*) AS n
  FROM gaps JOIN d USING (r) GROUP BY d.r)
SELECT d.doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN k.r IS NULL THEN h ELSE coalesce(head, '') || substr(h, CAST(2 * last + 1 AS BIGINT)) END)) AS kept_sha256
FROM d LEFT JOIN kept k USING (r)
"""
