"""Numpy kernels shared by the operators of this subpackage.

Everything here works on one Arrow batch inside a task: a batch of texts is
one byte array, and words, hashes, shingles and window minima come from array
operations over it. Nothing here knows about Spark.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# The white space of the word pattern [^\x20\x09-\x0D]+.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RNG = np.random.Generator(np.random.PCG64(20240607))
#: A random 64-bit value for each byte, so that the polynomial hash below does
#: not see the structure of the alphabet.
BYTE_CODE = _RNG.integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: An odd multiplier (invertible modulo 2**64).
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = 1 << max(12, int(n - 1).bit_length())
        _powers = np.full(size, BASE, dtype=np.uint64)
        _powers[0] = 1
        _powers = np.multiply.accumulate(_powers)
        _inverses = np.full(size, BASE_INV, dtype=np.uint64)
        _inverses[0] = 1
        _inverses = np.multiply.accumulate(_inverses)
    return _powers, _inverses


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a string column as one byte array, and the bounds of each (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        column = pa.array([], pa.large_string())
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def slices(bounds: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of whole texts of about ``most`` bytes each, one longer text alone."""
    out, first, n = [], 0, len(bounds) - 1
    while first < n:
        last = int(np.searchsorted(bounds, bounds[first] + most, side="right")) - 1
        last = min(n, max(first + 1, last))
        out.append((first, last))
        first = last
    return out


def words(raw: np.ndarray, bounds: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, and the bounds of each text's words.

    A word never crosses two texts, even if no white space stands between them.
    """
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64)
    inside = ~WHITE[raw]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = bounds[1:-1]
    cut = cut[cut < n]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    edge = cut[cut > 0] - 1
    after[edge] = False
    ends = np.flatnonzero(inside & ~after) + 1
    of_text = np.searchsorted(starts, bounds)
    powers, inverses = _grow(n + 1)
    coded = BYTE_CODE[LOWER[raw] if lower else raw]
    coded *= powers[:n]
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(coded, out=total[1:])
    h = (total[ends] - total[starts]) * inverses[starts]
    # the length keeps apart words that differ by nothing else in the polynomial
    return mix(h + (ends - starts).astype(np.uint64)), starts, ends, of_text


def grams(tokens: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k tokens, by its first token (length n - k + 1, or none)."""
    n = len(tokens) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = tokens[:n] * np.uint64(1)
    for i in range(1, k):
        h *= BASE
        h += tokens[i : i + n]
    return mix(h)


def shingles(tokens: np.ndarray, of_text: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Every text's shingles of k words (repeats included) and their bounds.

    A text of fewer words has its whole sequence as one shingle; one without
    words has none.
    """
    count = np.diff(of_text)
    h = grams(tokens, k)
    if len(h):
        owner = np.repeat(np.arange(len(count)), count)
        ok = owner[: len(h)] == owner[k - 1 :]
        h = h[ok]
    per = np.maximum(count - k + 1, 0)
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short) == 0:
        out = np.zeros(len(per) + 1, np.int64)
        np.cumsum(per, out=out[1:])
        return h, out
    whole = np.empty(len(short), np.uint64)
    for at, i in enumerate(short):
        x = np.uint64(count[i])
        with np.errstate(over="ignore"):
            for t in tokens[of_text[i] : of_text[i + 1]]:
                x = x * BASE + t
        whole[at] = x
    whole = mix(whole)
    first = np.zeros(len(per) + 1, np.int64)
    np.cumsum(per, out=first[1:])
    h = np.insert(h, first[short], whole)
    per[short] = 1
    np.cumsum(per, out=first[1:])
    return h, first


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of each text, sorted, and their bounds."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    keep = np.ones(len(v), bool)
    keep[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    out = np.zeros(len(bounds), np.int64)
    np.cumsum(np.bincount(o[keep], minlength=len(bounds) - 1), out=out[1:])
    return v[keep], out


def reduce_min(values: np.ndarray, bounds: np.ndarray, empty: int) -> np.ndarray:
    """Least value of each text; ``empty`` where it has none."""
    n = len(bounds) - 1
    out = np.full(n, empty, values.dtype)
    some = np.flatnonzero(np.diff(bounds) > 0)
    if len(some):
        out[some] = np.minimum.reduceat(values, bounds[some])
    return out


def window_min(x: np.ndarray, w: int, least: bool = True) -> np.ndarray:
    """Minimum (or maximum) of every run of w values, by doubling: length n - w + 1."""
    pick = np.minimum if least else np.maximum
    have, m = 1, x
    while have * 2 <= w:
        m = pick(m[:-have], m[have:])
        have *= 2
    return m if have == w else pick(m[: len(x) - w + 1], m[w - have : w - have + len(x) - w + 1])
