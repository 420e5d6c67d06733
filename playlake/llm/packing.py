"""Packing: sum-of-squares online packing into sequences of ``LENGTH`` tokens.

A document is its tokens and an end mark. Whole windows of it are sequences of
their own; what is left over is placed into an open sequence by the sum-of-squares
rule: of all fill levels that have room, take the one that leaves the smallest
sum of squares of the counts of open sequences per level, kept in an array of
counts by level. A sequence that is exactly full is closed. What is still open at
the end of a task (or beyond ``MOST_OPEN`` sequences, which bounds the memory) is
cut anew: its pieces are laid end to end and cut at ``LENGTH``; the last rest is
cut into powers of two, the lengths that need no padding. So no token is padding.

Each task packs its own partition of the input, in input order: no shuffle, a
bounded state, and a task that is run again packs the same sequences. Token ids
are those of the ``tokenizers`` library; texts of common characters go through
``tiktoken`` with the same vocabulary, several times faster, which the tests hold
against the former.

Defined results
  * null or empty text: the end mark alone; null ``doc_id``: kept as null;
  * a document longer than a sequence is cut; every token is in exactly one piece;
  * repeated rows: each packed for itself; empty table: no rows;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm._ship import lean, ship, small_batches

#: Tokens in a sequence, and the mark at a document's end.
LENGTH, END = 2048, 1
#: Open sequences of one task at most.
MOST_OPEN = 1024
#: Sequence numbers of one task.
_TASK_BITS = 36

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_COLUMNS = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

#: Characters for which both libraries split a text alike: ASCII without control
#: characters other than tab and line ends, and Latin letters. "<|" may begin a
#: special token, which one of them finds in the text.
_COMMON = re.compile("[\t\n\r -~\xa1-\xac\xae-ſ]*")
#: A longer word, or a text with that much white space beyond one between words, is left to the reference library.
_LONG_WORD, _MUCH_SPACE = 2000, 2000


class Encoder:
    """Token ids by the named public vocabulary."""

    def __init__(self, name: str = "byte_bpe_50k"):
        import base64

        import public_tokenizers
        import tiktoken

        self.name = name
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @functools.cached_property
    def reference(self):
        """The ``tokenizers`` library's own encoder, read when the first text needs it."""
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        return Tokenizer.from_file(public_tokenizers.path(f"{self.name}.json"))

    @staticmethod
    def common(text: str) -> bool:
        """A text that both libraries encode alike, in linear time."""
        if not _COMMON.fullmatch(text) or "<|" in text:
            return False
        sizes = [*map(len, text.split())]
        return max(sizes, default=0) <= _LONG_WORD and len(text) - sum(sizes) - len(sizes) <= _MUCH_SPACE

    def __call__(self, text: str) -> np.ndarray:
        if self.common(text):
            ids = self.fast.encode_to_numpy(text, disallowed_special=())
        else:
            ids = self.reference.encode(text, add_special_tokens=False).ids
        out = np.empty(len(ids) + 1, np.uint32)
        out[:-1] = ids
        out[-1] = END
        return out


class Packer:
    """Open sequences of one task; ``rows`` collects the pieces of closed ones."""

    def __init__(self, length: int, first_id: int, most_open: int = MOST_OPEN):
        self.length, self.next_id, self.most_open = length, first_id, most_open
        self.count = np.zeros(length + 1, np.int64)  # the level array
        self.levels: list[list[list]] = [[] for _ in range(length)]
        self.open = 0
        self.rows: list[tuple] = []

    def _close(self, pieces: list[tuple]) -> None:
        """pieces: (doc_id, start, ids, doc_tokens)"""
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            self.rows.append((doc_id, start, len(ids), doc_tokens, self.next_id, offset, ids.astype("<u4").tobytes()))
            offset += len(ids)
        self.next_id += 1

    def level_for(self, size: int) -> int:
        """The fill level (0: a new sequence) that leaves the least sum of squared counts."""
        n = self.count
        # moving one sequence from level h to h + size: 2 * (n[h+size] - n[h] + 1); a full one leaves the array
        change = 2 * (n[size : self.length] - n[: self.length - size]) + 2
        change[0] = 2 * n[size] + 1 if size < self.length else 0
        usable = n[: len(change)] > 0
        usable[:1] = True
        best = int(np.argmin(np.where(usable, change, np.iinfo(np.int64).max))) if len(change) else 0
        exact = self.length - size
        if exact and n[exact] and 1 - 2 * n[exact] <= change[best]:
            return exact
        return best

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.length:
            self._close([(doc_id, at, ids[at : at + self.length], total)])
            at += self.length
        if at == total:
            return
        size = total - at
        level = self.level_for(size)
        if level:
            pieces = self.levels[level].pop()
            self.count[level] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append((doc_id, at, ids[at:].copy(), total))
        if level + size == self.length:
            self._close(pieces)
            return
        self.levels[level + size].append(pieces)
        self.count[level + size] += 1
        self.open += 1
        if self.open > self.most_open:
            self.recut(last=False)

    def recut(self, last: bool) -> None:
        """Cut all open sequences anew; what does not fill one stays open, or is cut into powers of two."""
        pieces = [p for level in self.levels for one in level for p in one]
        self.levels = [[] for _ in range(self.length)]
        self.count[:] = 0
        self.open = 0
        left = sum(len(p[2]) for p in pieces)
        room, now = min(self.length, left), []
        if left < self.length and last:
            room = 1 << (left.bit_length() - 1) if left else 0
        for doc_id, start, ids, doc_tokens in pieces:
            while len(ids):
                part = ids[:room]
                now.append((doc_id, start, part, doc_tokens))
                start, ids, room, left = start + len(part), ids[len(part) :], room - len(part), left - len(part)
                if room:
                    continue
                size = sum(len(p[2]) for p in now)
                if size == self.length or last:
                    self._close(now)
                else:
                    self.levels[size].append(now)
                    self.count[size] += 1
                    self.open += 1
                now = []
                room = min(self.length, left)
                if left < self.length and last and left:
                    room = 1 << (left.bit_length() - 1)

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) if self.rows else [[] for _ in _COLUMNS]
        self.rows = []
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=list(_COLUMNS))


def pack(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_50k",
    length: int = LENGTH,
    text_col: str = "text",
    id_col: str = "doc_id",
    most_open: int = MOST_OPEN,
) -> DataFrame:
    """One row per piece: its document, place in it, sequence and offset there, and its token ids.

    ``ids`` are little-endian unsigned 32-bit numbers; ``doc_tokens`` counts the
    document's tokens with the end mark.
    """
    ship(docs.sparkSession)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(vocabulary)
        packer = Packer(length, TaskContext.get().partitionId() << _TASK_BITS, most_open)
        written = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, ids := encode(text.as_py() or ""))
                written += len(ids)
                if written > 1 << 20:
                    yield packer.taken()
                    written = 0
        packer.recut(last=True)
        yield packer.taken()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(lean(run), SCHEMA)
