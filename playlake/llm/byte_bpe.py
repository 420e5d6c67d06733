"""Byte-level BPE: length-bucketed padded matrices of token ids.

A text is split by the public pattern; each match is encoded by itself, as its
whole if the vocabulary has it, else by merges. Matches of similar byte length
lie in one padded matrix, a row each, beside a matrix of the ranks of their
adjacent pairs. In a round every row merges its leftmost pair of minimum rank: the
matrices lose one column (one cell of every row, found by its mask), and only the
two pairs beside the merge are looked up again. Rows that have nothing left to
merge leave the matrix. A pair's rank comes from an open-addressed hash table
over all ways to cut a token into two tokens. A match of more than ``LONG``
bytes is a matrix of one row, in which a round merges all places of the minimum
pair up to the first that gives a pair of still lower rank, which is the same
order of merges in fewer rounds.

Distribution: every document is encoded in the task that reads it, without a
shuffle. A task holds the vocabulary, the matches of about ``TOGETHER`` characters of
text, and a cache of matches seen (``CACHE_BYTES``; it is only a saving).

Defined results
  * null or empty text: no token; null ``doc_id``: kept as null; repeated rows:
    each encoded for itself; empty table: no rows;
  * a very long text is split slice by slice, a very long match in linear space;
  * bytes that are not UTF-8 are read as the replacement character;
  * characters newer than Python's Unicode tables are split as ``tiktoken`` does;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from playlake.llm._ship import ship

VOCABULARY = "byte_bpe_multi_50k"
#: Characters of text split at a time, matches beyond which a row is worked on alone, cells of a matrix.
SLICE, LONG, CELLS = 1 << 18, 512, 1 << 20
#: Characters whose matches are encoded together.
TOGETHER = 1 << 20
#: Text bytes of the cached matches of a task, and Arrow rows' bytes sent on at a time.
CACHE_BYTES, SEND_BYTES = 32 << 20, 4 << 20

#: No such pair; an empty slot; the padding's id (no token has it).
NONE, EMPTY, PAD = np.int32(2**31 - 1), np.int64(-1), np.int32(2**30)
#: A character that is neither a letter nor a digit.
PRIVATE = "\ue000"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class PairTable:
    """Ranks of pairs of token ids in an open-addressed hash table (linear probing)."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        bits = max(4, int(4 * len(rank)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, EMPTY)
        self.ranks = np.full(1 << bits, NONE)
        keys = self._key(left, right)
        home, left_over, self.probes = self._home(keys), np.arange(len(keys)), 0
        while len(left_over):
            at = (home[left_over] + self.probes) & self.mask
            free = np.flatnonzero(self.keys[at] == EMPTY)
            _, first = np.unique(at[free], return_index=True)
            placed = free[first]
            self.keys[at[placed]] = keys[left_over[placed]]
            self.ranks[at[placed]] = rank[left_over[placed]]
            left_over = np.delete(left_over, placed)
            self.probes += 1

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 31) | right.astype(np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MULTIPLIER) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of the pairs (left, right), ``NONE`` where the two do not merge."""
        keys = self._key(left, right).ravel()
        at = self._home(keys)
        slot = self.keys[at]
        found = np.where(slot == keys, self.ranks[at], NONE)
        open_ = np.flatnonzero((slot != keys) & (slot != EMPTY))
        for probe in range(1, self.probes):
            if not len(open_):
                break
            step = (at[open_] + probe) & self.mask
            slot = self.keys[step]
            hit = slot == keys[open_]
            found[open_[hit]] = self.ranks[step[hit]]
            open_ = open_[~hit & (slot != EMPTY)]
        return found.reshape(left.shape)


class Merger:
    """The merges of one vocabulary (token bytes -> rank; a token's id is its rank)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        pairs = []
        for token, rank in ranks.items():
            self.tokens[rank] = token
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs.append((a, b, rank))
        self.pair = PairTable(*np.array(pairs, np.int32).reshape(-1, 3).T)

    def rows(self, ids: np.ndarray) -> list[bytes]:
        """The tokens of each row of byte ids (padded with ``PAD`` at its end), as little-endian 32-bit ids."""
        out: list[bytes] = [b""] * len(ids)
        rows, pair = np.arange(len(ids)), self.pair(ids[:, :-1], ids[:, 1:])

        def finish(which: np.ndarray, cells: np.ndarray) -> None:
            real = cells != PAD
            ends = np.cumsum(real.sum(1)) * 4
            joined = cells[real].astype("<u4").tobytes()
            for row, start, end in zip(which.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                out[row] = joined[start:end]

        while len(rows) and pair.shape[1]:
            at = pair.argmin(1)
            best = pair[np.arange(len(rows)), at]
            if (done := best == NONE).any():
                finish(rows[done], ids[done])
                rows, ids, pair, at, best = (x[~done] for x in (rows, ids, pair, at, best))
                if not len(rows):
                    return out
            n, line = len(rows), np.arange(len(rows))
            ids[line, at] = best
            stay = np.ones(ids.shape, bool)
            stay[line, at + 1] = False
            ids = ids[stay].reshape(n, -1)
            stay = np.ones(pair.shape, bool)
            stay[line, at] = False
            pair = pair[stay].reshape(n, -1)
            for beside in (at - 1, at):
                some = (beside >= 0) & (beside < pair.shape[1])
                i, j = line[some], beside[some]
                pair[i, j] = self.pair(ids[i, j], ids[i, j + 1])
        finish(rows, ids)
        return out

    def long_row(self, ids: np.ndarray) -> bytes:
        """One row, all places of the minimum pair in a round where that keeps the order of merges."""
        pair = self.pair(ids[:-1], ids[1:])
        while len(pair) and (best := pair.min()) != NONE:
            at = np.flatnonzero(pair == best)
            # of places that overlap, every other one from the left
            line = np.arange(len(at))
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) > 1, line, 0))
            at = at[(line - run) % 2 == 0]
            # the first merge that gives a pair of lower rank is the last of this round
            merged = np.full(len(at), best)
            before, after = at > 0, at + 2 < len(ids)
            lower = np.zeros(len(at), bool)
            lower[before] |= self.pair(ids[at[before] - 1], merged[before]) < best
            lower[after] |= self.pair(merged[after], ids[at[after] + 2]) < best
            if len(at) > 1 and self.pair(merged[:1], merged[:1])[0] < best:
                lower[1:] |= np.diff(at) == 2
            if lower.any():
                at = at[: int(lower.argmax()) + 1]
            ids[at] = best
            ids, pair = np.delete(ids, at + 1), np.delete(pair, at)
            here = at - np.arange(len(at))
            for beside in (here - 1, here):
                j = beside[(beside >= 0) & (beside < len(pair))]
                pair[j] = self.pair(ids[j], ids[j + 1])
        return ids.astype("<u4").tobytes()

    def encode(self, matches: Iterable[bytes]) -> list[bytes]:
        """The ids of each match."""
        matches = list(matches)
        out = [b""] * len(matches)
        buckets: dict[int, list[int]] = {}
        for i, match in enumerate(matches):
            if (rank := self.ranks.get(match)) is not None:
                out[i] = rank.to_bytes(4, "little")
            elif len(match) > LONG:
                out[i] = self.long_row(self.of_byte[np.frombuffer(match, np.uint8)])
            else:
                buckets.setdefault((len(match) - 1).bit_length(), []).append(i)
        for bits, all_members in buckets.items():
            most = max(1, CELLS >> bits)
            for start in range(0, len(all_members), most):
                members = all_members[start : start + most]
                size = np.array([len(matches[i]) for i in members])
                cells = np.full((len(members), int(size.max())), PAD, np.int32)
                cells[np.arange(cells.shape[1]) < size[:, None]] = self.of_byte[
                    np.frombuffer(b"".join(matches[i] for i in members), np.uint8)
                ]
                for i, ids in zip(members, self.rows(cells), strict=True):
                    out[i] = ids
        return out


class Splitter:
    """The matches of the public pattern, which cover a text without gaps."""

    def __init__(self) -> None:
        import public_tokenizers
        import regex

        self.find = regex.compile(public_tokenizers.PATTERN).findall
        # Letters and digits that Python does not know yet may be too new for tiktoken's tables also.
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        new = "".join(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")
        self.unknown = self._not_known(new)
        codes = np.array([ord(c) for c in self.unknown], np.int64)
        runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1) if len(codes) else []
        ranges = "".join(f"{re.escape(chr(run[0]))}-{re.escape(chr(run[-1]))}" for run in runs)
        self.has_unknown = re.compile(f"[{ranges}]").search if ranges else None
        self.plain = dict.fromkeys(codes.tolist(), PRIVATE)

    @staticmethod
    def _not_known(chars: str) -> str:
        import tiktoken

        ranks = {bytes([b]): b for b in range(256)}
        asked = tiktoken.Encoding("class", pat_str=r"[\p{L}\p{N}]", mergeable_ranks=ranks, special_tokens={})
        known = set(asked.decode(asked.encode_ordinary(chars)))
        return "".join(c for c in chars if c not in known)

    def _matches(self, text: str) -> list[str]:
        if self.has_unknown is None or text.isascii() or not self.has_unknown(text):
            return self.find(text)
        ends = np.cumsum([len(m) for m in self.find(text.translate(self.plain))]).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends)]

    def __call__(self, text: str) -> Iterator[list[str]]:
        """Lists of matches, in order. What ends a slice may go on behind it: its last matches wait for the next."""
        at, size = 0, SLICE
        while len(text) - at > size:
            found = self._matches(text[at : at + size])
            if len(found) <= 3:  # one match fills the slice
                size *= 2
                continue
            at += sum(map(len, found[:-3]))
            yield found[:-3]
            size = SLICE
        yield self._matches(text[at:] if at else text)


class Codec:
    """Texts to ids and back, with a cache of matches."""

    def __init__(self, vocabulary: str):
        import public_tokenizers

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as lines:
            self.merger = Merger({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})
        self.split = Splitter()
        self.cache: dict[str, bytes] = {}
        self.cached = 0

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text; matches of about ``TOGETHER`` characters share matrices."""
        waiting: list[list[list[str]]] = []  # per text its lists of matches, encoded when there are enough
        done: list[bytes] = []  # parts of the first waiting text
        held = 0

        def flush(last_is_whole: bool) -> Iterator[bytes]:
            nonlocal held, waiting, done
            self._learn({m for lists in waiting for found in lists for m in found})
            for i, lists in enumerate(waiting):
                done += [b"".join(map(self.cache.__getitem__, found)) for found in lists]
                if i + 1 < len(waiting) or last_is_whole:
                    yield b"".join(done)
                    done = []
            waiting, held = ([] if last_is_whole else [[]]), 0

        for text in texts:
            waiting.append([])
            for matches in self.split(text):
                waiting[-1].append(matches)
                held += min(SLICE, len(text))
                if held >= TOGETHER:
                    yield from flush(last_is_whole=False)
            if held >= TOGETHER:
                yield from flush(last_is_whole=True)
        if waiting:
            yield from flush(last_is_whole=True)

    def _learn(self, matches: set[str]) -> None:
        """Have all of the matches in the cache."""
        new = matches.difference(self.cache)
        if new and self.cached > CACHE_BYTES:
            self.cache, self.cached, new = {}, 0, matches
        ordered = list(new)
        coded = [m.encode() for m in ordered]
        self.cache.update(zip(ordered, self.merger.encode(coded), strict=True))
        self.cached += sum(map(len, coded)) + 100 * len(coded)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids' tokens; an id that the vocabulary lacks gives none."""
        tokens, n = self.merger.tokens, len(self.merger.tokens)
        numbers = np.frombuffer(ids, "<u4", count=len(ids) // 4)
        if len(numbers) and int(numbers.max()) >= n:
            numbers = numbers[numbers < n]
        return b"".join(map(tokens.__getitem__, numbers.tolist()))


@lru_cache(maxsize=2)
def _codec(vocabulary: str) -> Codec:
    """One for all tasks of a Python worker."""
    return Codec(vocabulary)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: ``doc_id``, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit numbers)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            raw = (text.as_buffer() for text in batch.column(1))
            ids, first, held = [], 0, 0
            for coded in codec.encode("" if text is None else str(text, "utf-8", "replace") for text in raw):
                ids.append(coded)
                held += len(coded)
                if held > SEND_BYTES:
                    yield _encoded(batch.column(0).slice(first, len(ids)), ids)
                    ids, first, held = [], first + len(ids), 0
            if ids:
                yield _encoded(batch.column(0).slice(first), ids)

    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return found.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def _encoded(doc_id: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
    sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
    return pa.record_batch([doc_id, sizes, pa.array(ids, pa.binary())], names=["doc_id", "n_tokens", "ids"])


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """The rows with one more column: the bytes that the ids stand for (null ids: none)."""
    ship(encoded.sparkSession)
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            first, held, texts = 0, 0, []
            for i, ids in enumerate(batch.column(at)):
                raw = ids.as_buffer()
                texts.append(codec.decode(raw) if raw is not None else b"")
                held += len(texts[-1])
                if held > SEND_BYTES or i + 1 == batch.num_rows:
                    part = batch.slice(first, i + 1 - first)
                    yield pa.record_batch([*part.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, out_col])
                    first, held, texts = i + 1, 0, []

    return encoded.mapInArrow(run, StructType([*encoded.schema.fields, StructField(out_col, BinaryType())]))
