"""Document fingerprints: one-permutation MinHash.

A text's shingles (5 words, unchanged; fewer words: the whole sequence) are
hashed once. The high bits of a hash choose one of ``BINS`` bins, the rest is its
value there; a bin keeps its least value. Empty bins are filled by optimal
densification: each bin has its own random order of all bins, and takes the value
of the first in it that is not empty. Of every bin the low ``BITS`` bits are
stored, packed as hex (one character a bin). Two fingerprints' share of equal
characters exceeds the texts' similarity by chance agreements; ``likeness`` takes
those out: (share - 2**-BITS) / (1 - 2**-BITS), within 0 and 1.

Defined results
  * null or empty text, or white space only: no shingles, the empty fingerprint;
    likeness of two empty ones 1, of one to another 0;
  * equal texts have equal fingerprints, at any length;
  * null ``doc_id``: last in descending order; equal ids: ordered by text (and
    dealt to one group, so ids are expected to repeat only now and then);
  * one document: it is its own next; empty table: no rows;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm import _kernel as k
from playlake.llm._ship import ship

BINS, BITS = 512, 4
SHINGLE = 5
#: Text bytes of one group, of one pass; most exact boundaries of the id ranges.
GROUP_BYTES, PASS_BYTES, BOUNDARIES = 4 << 20, 512 << 10, 4096
#: Rows of ids that may be broadcast (16 bytes each).
BROADCAST_ROWS = 1_000_000
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


@functools.cache
def _orders(bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """For each bin (column) its order of the bins, and the inverse: rank[donor, bin]."""
    rng = np.random.Generator(np.random.PCG64(512))
    order = np.argsort(rng.random((bins, bins)), axis=0)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(bins)[:, None], axis=0)
    return order, rank


def signatures(h: np.ndarray, bounds: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Densified least values of each text's hashes by bin; 0 for a text without any."""
    n, none = len(bounds) - 1, np.uint64(2**64 - 1)
    shift = np.uint64(64 - (bins.bit_length() - 1))
    owner = np.repeat(np.arange(n, dtype=np.int64), np.diff(bounds))
    values = np.full(n * bins, none, np.uint64)
    np.minimum.at(values, owner * bins + (h >> shift).astype(np.int64), h & ((np.uint64(1) << shift) - np.uint64(1)))
    values = values.reshape(n, bins)
    empty = values == none
    order, rank = _orders(bins)
    out = values.copy()
    some = np.diff(bounds) > 0
    rows, at = np.nonzero(empty & some[:, None])
    for attempt in range(8):
        if not len(rows):
            break
        found = values[rows, order[attempt, at]]
        ok = found != none
        out[rows[ok], at[ok]] = found[ok]
        rows, at = rows[~ok], at[~ok]
    # few bins have values: the first of them in the empty bin's order
    cut = np.flatnonzero(np.diff(rows)) + 1
    for part in np.split(np.arange(len(rows)), cut) if len(rows) else []:
        i = rows[part[0]]
        full = np.flatnonzero(~empty[i])
        out[i, at[part]] = values[i, full[np.argmin(rank[full][:, at[part]], axis=0)]]
    out[~some] = 0
    return out


def fingerprints(texts: pa.Array) -> list[str]:
    """The fingerprint of each text of a string array."""
    raw, bounds = k.text_bytes(texts)
    out: list[str] = []
    for a, b in k.slices(bounds, PASS_BYTES):
        low = bounds[a]
        tokens, _, _, of_text = k.words(raw[low : bounds[b]], bounds[a : b + 1] - low)
        h, of_shingle = k.shingles(tokens, of_text, SHINGLE)
        values = signatures(h, of_shingle)
        digits = _HEX[(k.mix(values) & np.uint64(2**BITS - 1)).astype(np.int64)]
        joined = digits.tobytes().decode()
        some = np.diff(of_shingle) > 0
        out += [joined[i * BINS : (i + 1) * BINS] if some[i] else "" for i in range(b - a)]
    return out


def likeness(a: str, b: str) -> float:
    """Estimated Jaccard similarity of two fingerprints, chance agreement taken out."""
    if not a or not b:
        return float(a == b)
    same = np.count_nonzero(np.frombuffer(a.encode(), np.uint8) == np.frombuffer(b.encode(), np.uint8)) / len(a)
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, (same - chance) / (1.0 - chance))))


def edited(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the beginning of the next."""
    part = len(text) // 3
    return text[: len(text) - part] + following[:part]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _group(table: pa.Table) -> pa.Table:
    """Fingerprints of one range of ids; the row marked as edge is the next range's first document."""
    ids, texts = table.column("doc_id").to_pylist(), table.column("text").to_pylist()
    edges = table.column("edge").to_pylist()
    low = -(2**63) - 1
    order = sorted(range(len(ids)), key=lambda i: (edges[i], -(low if ids[i] is None else ids[i]), texts[i] or ""))
    own = [i for i in order if not edges[i]]
    text = [texts[i] or "" for i in order]
    changed = [edited(text[i], text[i + 1] if i + 1 < len(text) else text[0]) for i in range(len(own))]
    prints = fingerprints(pa.array(text, pa.large_string()))
    changed_prints = fingerprints(pa.array(changed, pa.large_string()))
    following = [prints[i + 1] if i + 1 < len(prints) else prints[0] for i in range(len(own))]
    return pa.table(
        {
            "doc_id": pa.array([ids[i] for i in own], pa.int64()),
            "n_chars": pa.array([len(t) for t in text[: len(own)]], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
            "fingerprint": pa.array(prints[: len(own)], pa.string()),
            "edited_fingerprint": pa.array(changed_prints, pa.string()),
            "near_edited": pa.array(map(likeness, prints, changed_prints), pa.float64()) if own else pa.array([], pa.float64()),
            "near_next": pa.array(map(likeness, prints, following), pa.float64()) if own else pa.array([], pa.float64()),
        }
    )


def compare_with_next(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Fingerprints of every document and of its edited text, with their likenesses.

    Documents are dealt to ranges of ids of about ``group_bytes`` each (quantiles,
    divided evenly between them), so that a document's next is in its range; only
    a range's last document needs the first one of the next range, which joins it
    as an extra row. Texts are exchanged once.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, math.ceil(total / group_bytes))
    coarse = min(ranges, BOUNDARIES)
    cuts = sorted(set(texts.approxQuantile("doc_id", [i / coarse for i in range(coarse + 1)], 0.2 / coarse))) if coarse > 1 else []
    # range number: the quantile range, and an even part of it; null ids are last in descending order, so lowest
    fine = math.ceil(ranges / coarse)
    number = F.lit(0).cast("long")
    if len(cuts) > 1:
        bounds = F.split(F.lit(",".join(str(int(c)) for c in cuts)), ",").cast("array<bigint>")
        step = _bisect(bounds, len(cuts))
        low, high = F.get(bounds, step), F.get(bounds, F.least(step + 1, F.lit(len(cuts) - 1)))
        inside = F.floor((F.col("doc_id") - low) * fine / F.greatest(high - low, F.lit(1)))
        number = (step * fine + F.greatest(F.lit(0), F.least(inside, F.lit(fine - 1)))).cast("long")
    dealt = texts.withColumn("range", F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(number))

    # The first document of each range, by id alone; one row per range.
    heads = dealt.groupBy("range").agg(F.max("doc_id").alias("head"))
    around = Window.orderBy(F.col("range").desc())
    whole = Window.partitionBy(F.lit(0)).orderBy(F.col("range").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = heads.select(
        F.col("range").alias("to_range"),
        F.coalesce(F.lead("range").over(around), F.first("range").over(whole)).alias("_range"),
        F.lead("range").over(around).isNull().alias("wraps"),
        F.lead("head").over(around).alias("next_head"),
        F.first("head").over(whole).alias("first_head"),
    ).select("to_range", "_range", F.when(F.col("wraps"), F.col("first_head")).otherwise(F.col("next_head")).alias("_head"))
    if ranges <= BROADCAST_ROWS:
        edges = F.broadcast(edges)
    first_rows = (
        dealt.join(edges, (F.col("range") == F.col("_range")) & F.col("doc_id").eqNullSafe(F.col("_head")))
        .groupBy(F.col("to_range").alias("range"))
        # of equal ids the first by text
        .agg(F.min_by(F.struct("doc_id", "text"), F.coalesce("text", F.lit(""))).alias("r"))
        .select("r.doc_id", "r.text", "range", F.lit(True).alias("edge"))
    )
    rows = dealt.withColumn("edge", F.lit(False)).unionByName(first_rows)
    return rows.groupBy("range").applyInArrow(_group, SCHEMA)


def _bisect(bounds: Column, n: int) -> Column:
    """Index of the last boundary not above the id (0 for ids below all), by halving."""
    steps = [1 << i for i in reversed(range(max(1, (n - 1).bit_length())))]

    def move(at: Column, step: Column) -> Column:
        return F.when((at + step < n) & (F.get(bounds, at + step) <= F.col("doc_id")), at + step).otherwise(at)

    return F.aggregate(F.array(*(F.lit(x) for x in steps)), F.lit(0), move)
