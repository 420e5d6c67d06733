"""Substring dedup: prefix-partitioned suffix trees over words.

A document is its words ``[^\\x20\\x09-\\x0D]+``, unchanged. A word goes if a
window of ``WINDOW`` words that covers it also starts, as the same words, in a
document with a smaller id; windows never cross documents and are judged on the
input. ``_repeats`` brings together the places that can be equal. Here the
suffixes of each such group of strings are split by prefix: adjacent first words
share a part while it fits the limit, and a prefix with more suffixes than that
is lengthened word by word until its parts fit (at ``WINDOW`` words it is a
single node and needs no tree). Each part becomes one subtree, held as its sorted
suffixes and the common prefixes of neighbours; the internal nodes at least
``WINDOW`` words deep are the repeats, and give each window in them the least id
below the node.

Defined results
  * null or empty text, or white space only: 0 words, the empty string is kept;
    fewer than ``WINDOW`` words: nothing removed;
  * equal ids (repeated rows) remove nothing from each other; null id: after all
    others; overlapping windows: their union is removed; empty table: no rows;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from playlake.llm import _repeats

#: Fixed value: the shortest repeat, in words.
WINDOW = 13
#: Anchors are the least of the grams of this many words.
GRAM = 5
#: Most suffixes of one subtree.
SUBTREE = 1 << 16


def prefix_parts(tokens: np.ndarray, limit: int) -> list[tuple[np.ndarray, int]]:
    """Split suffixes (rows of token numbers) by variable-length prefixes.

    Parts of at most ``limit`` suffixes, or of one prefix of full length, each
    with the length of the prefix that all of its suffixes share. Two suffixes of
    one prefix are never in two parts.
    """
    parts, open_ = [], [(np.arange(len(tokens)), 0)]
    while open_:
        rows, depth = open_.pop()
        if len(rows) <= limit or depth == tokens.shape[1]:
            parts.append((rows, depth))
            continue
        first = tokens[rows, depth]
        order = np.argsort(first, kind="stable")
        _, at, count = np.unique(first[order], return_index=True, return_counts=True)
        begin = 0
        for i in range(len(at)):
            size = at[i] + count[i] - at[begin]
            if size > limit and i > begin:
                open_.append((rows[order[at[begin] : at[i]]], depth))
                begin = i
            if count[i] > limit:  # one prefix too many: lengthen it
                open_.append((rows[order[at[i] : at[i] + count[i]]], depth + 1))
                begin = i + 1
        if begin < len(at):
            open_.append((rows[order[at[begin] :]], depth))
    return parts


def subtree(tokens: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """A part's suffixes in order, and the common prefix of each with the one before."""
    width = tokens.shape[1]
    order = np.lexsort(tokens[:, depth:].T[::-1]) if depth < width else np.arange(len(tokens))
    common = np.zeros(len(tokens), np.int64)
    if len(tokens) > 1:
        same = tokens[order[1:]] == tokens[order[:-1]]
        common[1:] = np.where(same.all(axis=1), width, np.argmin(same, axis=1))
    return order, common


def resolve(contexts: np.ndarray, least: np.ndarray, _group: np.ndarray, window: int = WINDOW, limit: int = SUBTREE) -> np.ndarray:
    """Least id over all occurrences of each window of each context."""
    n, width = contexts.shape
    offsets = width - window + 1
    numbers = np.unique(contexts.ravel(), return_inverse=True)[1].reshape(n, width).astype(np.int32)
    suffixes = np.lib.stride_tricks.sliding_window_view(numbers, window, axis=1).reshape(n * offsets, window)
    ids = np.repeat(least, offsets)
    out = np.empty(n * offsets, np.int64)
    for rows, depth in prefix_parts(suffixes, limit):
        order, common = subtree(suffixes[rows], depth)
        node = np.cumsum(common < window) - 1  # deep nodes: runs of neighbours that share the window
        smallest = np.full(node[-1] + 1, _repeats.NO_ID, np.int64)
        np.minimum.at(smallest, node, ids[rows[order]])
        out[rows[order]] = smallest[node]
    return out.reshape(n, offsets)


SCHEMA = "doc_id long, n_words long, n_removed long, kept string"


def _finish(block: _repeats.Block, covered: np.ndarray) -> pa.Table:
    of_text, n = block.of_text, len(block.ids)
    kept = np.flatnonzero(~covered)
    sizes = (block.ends - block.starts)[kept]
    of_kept = np.searchsorted(kept, of_text)
    # every kept word with a space after it; the last space of a text is cut off below
    out_at = np.zeros(len(kept) + 1, np.int64)
    np.cumsum(sizes + 1, out=out_at[1:])
    joined = np.full(out_at[-1], 0x20, np.uint8)
    shift = np.repeat(block.starts[kept] - out_at[:-1], sizes)
    where = np.arange(sizes.sum()) + np.repeat(out_at[:-1] - np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64), sizes)
    joined[where] = block.raw[where + shift]
    bounds = out_at[of_kept]
    some = np.diff(of_kept) > 0
    drop = bounds[1:][some] - 1
    mask = np.ones(len(joined), bool)
    mask[drop] = False
    bounds = bounds - np.concatenate([[0], np.cumsum(some)])
    text = pa.Array.from_buffers(
        pa.large_string(), n, [None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(joined[mask].tobytes())]
    )
    words = np.diff(of_text)
    return pa.table(
        {
            "doc_id": pa.array(block.ids, pa.int64(), mask=block.null_id),
            "n_words": pa.array(words.astype(np.int64)),
            "n_removed": pa.array((words - np.diff(of_kept)).astype(np.int64)),
            "kept": text.cast(pa.string()),
        }
    )


def dedup(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", window: int = WINDOW, subtree_limit: int = SUBTREE, **limits
) -> DataFrame:
    """One row per document: n_words, n_removed and the kept words joined by one space."""
    hot = {x: limits.pop(x) for x in ("hot_blocks", "hot_crowded", "crowd") if x in limits}
    plan = _repeats.Plan(window, max(min(GRAM, window), window - 31), True, functools.partial(resolve, window=window, limit=subtree_limit), **hot)
    return _repeats.dedup(docs, plan, _finish, SCHEMA, text_col, id_col, **limits)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
v AS (
  SELECT r, doc_id, p, list_slice(w, p, p + 12) AS s
  FROM (SELECT r, doc_id, w, unnest(range(1, CAST(len(w) - 11 AS BIGINT))) AS p FROM d WHERE len(w) >= 13)),
m AS (SELECT s, min(doc_id) AS least FROM v GROUP BY s HAVING count(*) > 1),
hit AS (SELECT v.r, v.p FROM v JOIN m USING (s) WHERE m.least < v.doc_id OR (v.doc_id IS NULL AND m.least IS NOT NULL)),
gone AS (SELECT DISTINCT r, p + unnest(range(0, 13)) AS p FROM hit),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT words.r, string_agg(word, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words ANTI JOIN gone ON words.r = gone.r AND words.p = gone.p GROUP BY words.r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k USING (r)
"""
