"""Windows of tokens that also start in a document with a smaller id: the Spark side.

Used by ``byte_dedup`` (windows of 50 bytes) and ``word_dedup`` (13 words), which
differ in their tokens and in how a group of similar strings is searched.

Every window of W tokens holds W-K+1 grams of K tokens; the least by hash is the
window's *anchor*. Equal windows have equal anchors, so it is enough to bring
together the places that share an anchor. Only about 2 in W-K+2 grams are
anchors. Documents are dealt to *blocks* of a bounded number of bytes by a hash;
a block is the unit of every step, and what leaves it is aggregated first (rows of
one id and text that would fill a block alone are one row until the end):

1. each block sends the hashes of its distinct anchors to buckets (by hash), and
   learns which of them occur in two documents or more;
2. for those it sends digests of their distinct *contexts* (all tokens that any
   window around the anchor can cover) with the least document id in the block.
   It learns which contexts occur with a smaller id elsewhere: all their windows
   go. Of each other context one block is the owner; where the same anchor has
   further contexts that agree with it for half a window on one side (else no
   window can be common), it is asked for the tokens;
3. it sends those contexts, and gets one bit per window: it also occurs with a
   smaller id, in another context. Finding these is the operator's own method;
4. the block marks the windows and removes what they cover.

The texts are exchanged once (Spark reuses the exchange for all steps), the rest
is hashes, digests, contexts that differ at one end, and bits. A *hot* anchor, of
which there are contexts in very many blocks, would make one group grow with the
corpus: its windows are sent by their own 128-bit digests instead (the longest
prefix a window has), each once per block with its least id, so a group of those
is one number per block however often the passage occurs.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playlake.llm import _kernel as k
from playlake.llm._ship import ship

#: Bytes of text in a block, and in a bucket's share of the corpus.
BLOCK_BYTES = 8 << 20
BUCKET_BYTES = 16 << 20
#: Bytes that a row counts for besides its text, and copies of a folded row that one array lists.
ROW_BYTES, LISTED = 64, 4096
#: Keys of repeated rows that may be broadcast (8 bytes each).
BROADCAST_KEYS = 1_000_000
#: Bytes of text that one pass of array operations covers.
PASS_BYTES = 96 << 10
#: An anchor is hot if it occurs in this many blocks, or in at least
#: HOT_CROWDED blocks each of which has it in CROWD documents or more.
HOT_BLOCKS, HOT_CROWDED, CROWD = 1024, 24, 64

NO_ID = np.iinfo(np.int64).max
#: Kinds of messages: bits of shared anchors, of contexts, of contexts' windows, of hot windows.
SHARED, DIGESTS, CONTEXTS, WINDOWS = 0, 1, 2, 3


@dataclass(frozen=True)
class Plan:
    """What is searched: window and anchor length, tokens, and how a group is resolved."""

    window: int
    gram: int
    words: bool
    #: (contexts, least ids, number of the anchor) -> least id of each window of each context
    resolve: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]
    hot_blocks: int = HOT_BLOCKS
    hot_crowded: int = HOT_CROWDED
    crowd: int = CROWD
    #: Tokens of contexts that one search covers (whole anchors, at least one).
    search_tokens: int = 256 << 10

    @property
    def offsets(self) -> int:
        return self.window - self.gram + 1

    @property
    def context(self) -> int:
        return 2 * self.window - self.gram

    @property
    def half(self) -> int:
        """A window covers this many tokens on one side of its anchor at least."""
        return -(-(self.window - self.gram) // 2)


class Block:
    """One block's texts as tokens, with its anchors."""

    def __init__(self, table: pa.Table, plan: Plan):
        self.plan = plan
        self.raw, self.bounds = k.text_bytes(table.column("text"))
        ids = table.column("doc_id").combine_chunks()
        self.null_id = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(NO_ID)).astype(np.int64)
        if plan.words:
            parts = [self._words(a, b) for a, b in k.slices(self.bounds, PASS_BYTES)]
            self.tokens = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.uint64)
            self.starts = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
            self.ends = np.concatenate([p[2] for p in parts]) if parts else np.zeros(0, np.int64)
            self.of_text = np.concatenate([[0], np.cumsum(np.concatenate([p[3] for p in parts]))]) if parts else np.zeros(1, np.int64)
        else:
            self.tokens, self.of_text = self.raw, self.bounds
        self._anchors()

    def _words(self, a: int, b: int):
        low = self.bounds[a]
        h, s, e, of = k.words(self.raw[low : self.bounds[b]], self.bounds[a : b + 1] - low)
        # zero stands for "outside the text"
        return np.maximum(h, np.uint64(1)), s + low, e + low, np.diff(of)

    def _anchors(self) -> None:
        p, parts = self.plan, []
        per_pass = PASS_BYTES // (6 if p.words else 1)
        for a, b in k.slices(self.of_text, per_pass):
            if found := self._anchors_of(a, b):
                parts.append(found)
        none = np.zeros(0, np.uint64)
        empty = (none, np.zeros(0, np.int64), np.zeros(0, np.int64), none, np.zeros((0, 2), np.uint32))
        self.hash, self.doc, self.at, self.context_hash, self.sides = (
            [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else empty
        )

    def _anchors_of(self, a: int, b: int):
        """Anchors of texts a..b: hash, text, place in the block's tokens, hashes of the context and of its halves."""
        p = self.plan
        low, high = self.of_text[a], self.of_text[b]
        bounds = self.of_text[a : b + 1] - low
        sizes = np.diff(bounds)
        n = int(high - low)
        if not len(sizes) or sizes.max() < p.window:
            return None
        source = self.tokens[low:high]
        powers, inverses = k._grow(n + 1)
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((source if p.words else k.BYTE_CODE[source]) * powers[:n], out=total[1:])
        # Grams by a hash of 32 bits; equal ones within a window are all anchors, in each of its copies.
        g = total[p.gram :] - total[: n + 1 - p.gram]
        g *= inverses[: n + 1 - p.gram]
        g *= np.uint64(0x9E3779B97F4A7C15)
        order = (g >> np.uint64(32)).astype(np.uint32)
        order |= np.uint32(1)  # never zero
        # windows that lie inside one text
        valid = np.zeros(n - p.window + 2, np.int8)
        long = sizes >= p.window
        valid[bounds[:-1][long]] += 1
        valid[bounds[1:][long] - p.window + 1] -= 1
        least = k.window_min(order, p.offsets)
        least *= np.cumsum(valid[:-1], dtype=np.uint32)
        around = np.zeros(len(least) + 2 * (p.offsets - 1), np.uint32)
        around[p.offsets - 1 : len(around) - p.offsets + 1] = least
        places = np.flatnonzero(k.window_min(around, p.offsets, least=False) == order)
        if not len(places):
            return None
        doc = np.searchsorted(bounds, places, side="right") - 1

        def digest(before: int, after: int) -> np.ndarray:
            """Tokens from ``before`` ahead of the anchor to ``after`` behind its start, as far as the text goes."""
            left, right = np.maximum(places - before, bounds[doc]), np.minimum(places + after, bounds[doc + 1])
            return k.mix((total[right] - total[left]) * inverses[places])

        anchor = k.mix(g[places] ^ np.uint64(0xA0761D6478BD642F))
        sides = np.stack([digest(p.half, p.gram), digest(0, p.gram + p.half)], axis=1) >> np.uint64(32)
        return anchor, doc + a, places + low, digest(p.offsets - 1, p.window), sides.astype(np.uint32)

    def shared_first(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors (sorted, the low two bits kept free for flags) and, for each occurrence, which it is."""
        hashes = self.hash & ~np.uint64(3)
        return np.unique(hashes, return_inverse=True)

    def contexts(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct contexts among the occurrences ``which``: an example, the least id, and which context each has."""
        _, example, group = np.unique(self.context_hash[which], return_index=True, return_inverse=True)
        least = np.full(len(example), NO_ID, np.int64)
        np.minimum.at(least, group, self.ids[self.doc[which]])
        return which[example], least, group

    def content(self, occurrences: np.ndarray) -> np.ndarray:
        """The contexts' tokens (0 outside the text)."""
        p = self.plan
        where = self.at[occurrences][:, None] + np.arange(-(p.offsets - 1), p.window)
        low = self.of_text[self.doc[occurrences]][:, None]
        high = self.of_text[self.doc[occurrences] + 1][:, None]
        out = self.tokens[np.clip(where, 0, max(0, len(self.tokens) - 1))]
        out[(where < low) | (where >= high)] = 0 if p.words else 0xFF
        return out

    def window_digests(self, occurrences: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and 128-bit digest of every valid window around the occurrences, each start once."""
        p = self.plan
        starts = (self.at[occurrences][:, None] - np.arange(p.offsets)[None, :]).ravel()
        doc = np.repeat(self.doc[occurrences], p.offsets)
        ok = (starts >= self.of_text[doc]) & (starts + p.window <= self.of_text[doc + 1])
        starts = np.unique(starts[ok])
        digests = np.zeros((len(starts), 2), np.uint64)
        for a in range(0, len(starts), 1 << 16):
            part = self.tokens[starts[a : a + (1 << 16)][:, None] + np.arange(p.window)]
            coded = part if p.words else k.BYTE_CODE[part]
            powers, inverses = k._grow(p.window + 1)
            digests[a : a + (1 << 16), 0] = k.mix((coded * powers[: p.window]).sum(axis=1))
            digests[a : a + (1 << 16), 1] = k.mix((k.mix(coded) * inverses[: p.window]).sum(axis=1))
        return starts, digests


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the high bits: sorted hashes have sorted buckets."""
    return (((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _runs(buckets: np.ndarray) -> list[tuple[int, int, int]]:
    """(bucket, first, last) of a sorted array of buckets."""
    if not len(buckets):
        return []
    cut = np.flatnonzero(np.diff(buckets)) + 1
    firsts, lasts = np.concatenate([[0], cut]), np.concatenate([cut, [len(buckets)]])
    return [(int(buckets[a]), int(a), int(b)) for a, b in zip(firsts, lasts, strict=True)]


def _distinct_pairs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of an (n, 2) array: an example of each distinct pair, in order, and which pair each row is."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.ones(len(order), bool)
    new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


_MESSAGE = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
MESSAGE_DDL = "bucket int, kind int, block int, payload binary"


def _messages(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    return pa.table([pa.array(c, t) for c, t in zip(columns, _MESSAGE.types, strict=True)], schema=_MESSAGE)


def _anchor_messages(block: Block, number: int, buckets: int) -> list:
    """Step 1: a block's distinct anchors; the low bits say: in several documents, in a crowd of them."""
    anchors, which = block.shared_first()
    pairs = np.unique(which.astype(np.int64) * len(block.ids) + block.doc) // max(1, len(block.ids))
    documents = np.bincount(pairs, minlength=len(anchors))
    several = documents > 1
    flagged = anchors | several.astype(np.uint64) | ((documents >= block.plan.crowd).astype(np.uint64) << np.uint64(1))
    return [(bucket, SHARED, number, flagged[a:b].tobytes()) for bucket, a, b in _runs(_bucket(anchors, buckets))]


def _answer_shared(table: pa.Table, plan: Plan) -> pa.Table:
    """For each block, bits of which anchors are shared, and of which are hot."""
    payloads = table.column("payload").to_pylist()
    arrays = [np.frombuffer(x, np.uint64) for x in payloads]
    flagged = np.concatenate(arrays)
    anchors, which, blocks = np.unique(flagged & ~np.uint64(3), return_inverse=True, return_counts=True)
    several = np.zeros(len(anchors), bool)
    several[which[(flagged & np.uint64(1)) != 0]] = True
    crowded = np.bincount(which[(flagged & np.uint64(2)) != 0], minlength=len(anchors))
    shared = (several | (blocks > 1))[which]
    hot = ((blocks >= plan.hot_blocks) | (crowded >= plan.hot_crowded))[which]
    out, at = [], 0
    for x, bucket, block in zip(arrays, table.column("bucket").to_pylist(), table.column("block").to_pylist(), strict=True):
        bits = np.packbits(np.concatenate([shared[at : at + len(x)], hot[at : at + len(x)]]))
        out.append((bucket, SHARED, block, bits.tobytes()))
        at += len(x)
    return _messages(out)


def _read_shared(block: Block, answers: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences of shared anchors, and which of those are hot."""
    anchors, which = block.shared_first()
    shared, hot = np.zeros(len(anchors), bool), np.zeros(len(anchors), bool)
    for bucket, a, b in _runs(_bucket(anchors, buckets)):
        bits = np.unpackbits(np.frombuffer(answers[SHARED, bucket], np.uint8), count=2 * (b - a)).astype(bool)
        shared[a:b], hot[a:b] = bits[: b - a], bits[b - a :]
    occurrences = np.flatnonzero(shared[which])
    return occurrences, hot[which][occurrences]


def _plan_messages(block: Block, answers: dict, buckets: int):
    """What step 2 sends and later steps read, in the same order each time."""
    occurrences, hot = _read_shared(block, answers, buckets)
    example, least, group = block.contexts(occurrences[~hot])
    order = np.argsort(block.hash[example] & ~np.uint64(3), kind="stable")
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    example, least, group = example[order], least[order], back[group] if len(group) else group
    starts, digests = block.window_digests(occurrences[hot])
    first, of_window = _distinct_pairs(digests)
    doc = np.searchsorted(block.of_text, starts, side="right") - 1
    window_least = np.full(len(first), NO_ID, np.int64)
    np.minimum.at(window_least, of_window, block.ids[doc])
    keys = digests[first]
    return (occurrences[~hot], example, least, group), (starts, doc, keys, window_least, of_window)


def _forward(number: int, answers: dict) -> list:
    """Answers that later steps need again go along, in a bucket of the block's own."""
    return [(-1 - number, kind, bucket, payload) for (kind, bucket), payload in answers.items()]


def _echo(table: pa.Table) -> pa.Table:
    rows = zip(*(table.column(c).to_pylist() for c in ("bucket", "kind", "block", "payload")), strict=True)
    return _messages([(bucket, kind, -1 - own, payload) for own, kind, bucket, payload in rows])


def _digest_messages(block: Block, number: int, answers: dict, buckets: int) -> list:
    """Step 2: digests of the shared anchors' contexts and of hot windows, with their least ids."""
    (_, example, least, _), (_, _, keys, window_least, _) = _plan_messages(block, answers, buckets)
    anchors = block.hash[example] & ~np.uint64(3)
    out = _forward(number, answers)
    for bucket, a, b in _runs(_bucket(anchors, buckets)):
        parts = (anchors[a:b], block.context_hash[example[a:b]], least[a:b], block.sides[example[a:b]])
        out.append((bucket, DIGESTS, number, b"".join(x.tobytes() for x in parts)))
    for bucket, a, b in _runs(_bucket(keys[:, 0], buckets)):
        out.append((bucket, WINDOWS, number, keys[a:b].tobytes() + window_least[a:b].tobytes()))
    return out


def _answer_digests(table: pa.Table, plan: Plan) -> pa.Table:
    """Two bits for each context: a smaller id has the same one; its owner is to send it. One bit for each hot window."""
    kinds = table.column("kind").to_pylist()
    blocks = table.column("block").to_pylist()
    payloads = table.column("payload").to_pylist()
    bucket = table.column("bucket")[0].as_py()
    out = []
    if at := [i for i, kind in enumerate(kinds) if kind == DIGESTS]:
        sizes = [len(payloads[i]) // 32 for i in at]

        def gather(kind, start: int, width: int = 1) -> np.ndarray:
            return np.concatenate(
                [np.frombuffer(payloads[i], kind, width * n, start * n) for i, n in zip(at, sizes, strict=True)]
            )

        anchors, digests, least = gather(np.uint64, 0), gather(np.uint64, 8), gather(np.int64, 16)
        sides = gather(np.uint32, 24, 2).reshape(-1, 2)
        # equal contexts of several blocks are one, with its least id
        _, example, which = np.unique(digests, return_index=True, return_inverse=True)
        overall = np.full(len(example), NO_ID, np.int64)
        np.minimum.at(overall, which, least)
        smaller = overall[which] < least
        # contexts that another one of the same anchor agrees with on a side
        similar = np.zeros(len(example), bool)
        for side in (0, 1):
            one = k.mix(anchors[example] + sides[example, side].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            _, group, count = np.unique(one, return_inverse=True, return_counts=True)
            similar |= count[group] > 1
        wanted = similar[which] & ~smaller
        done = 0
        for i, n in zip(at, sizes, strict=True):
            bits = np.packbits(np.concatenate([smaller[done : done + n], wanted[done : done + n]]))
            out.append((bucket, DIGESTS, blocks[i], bits.tobytes()))
            done += n
    if at := [i for i, kind in enumerate(kinds) if kind == WINDOWS]:
        sizes = [len(payloads[i]) // 24 for i in at]
        keys = np.concatenate([np.frombuffer(payloads[i], np.uint64, 2 * n).reshape(n, 2) for i, n in zip(at, sizes, strict=True)])
        least = np.concatenate([np.frombuffer(payloads[i], np.int64, n, 16 * n) for i, n in zip(at, sizes, strict=True)])
        first, which = _distinct_pairs(keys)
        overall = np.full(len(first), NO_ID, np.int64)
        np.minimum.at(overall, which, least)
        smaller = overall[which] < least
        done = 0
        for i, n in zip(at, sizes, strict=True):
            out.append((bucket, WINDOWS, blocks[i], np.packbits(smaller[done : done + n]).tobytes()))
            done += n
    return _messages(out)


def _digest_bits(anchors: np.ndarray, answers: dict, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For contexts sorted by anchor: a smaller id has it; it was asked for."""
    smaller, wanted = np.zeros(len(anchors), bool), np.zeros(len(anchors), bool)
    for bucket, a, b in _runs(_bucket(anchors, buckets)):
        bits = np.unpackbits(np.frombuffer(answers[DIGESTS, bucket], np.uint8), count=2 * (b - a)).astype(bool)
        smaller[a:b], wanted[a:b] = bits[: b - a], bits[b - a :]
    return smaller, wanted


def _context_messages(block: Block, number: int, answers: dict, buckets: int) -> list:
    """Step 3: the contexts asked for: anchor, least id, tokens."""
    (_, example, least, _), _ = _plan_messages(block, answers, buckets)
    anchors = block.hash[example] & ~np.uint64(3)
    _, wanted = _digest_bits(anchors, answers, buckets)
    example, least, anchors = example[wanted], least[wanted], anchors[wanted]
    out = _forward(number, answers)
    for bucket, a, b in _runs(_bucket(anchors, buckets)):
        out.append((bucket, CONTEXTS, number, least[a:b].tobytes() + block.content(example[a:b]).tobytes()))
    return out


def _answer_contexts(table: pa.Table, plan: Plan) -> pa.Table:
    """One bit for each window of each context: it also occurs with a smaller id."""
    blocks = table.column("block").to_pylist()
    payloads = table.column("payload").to_pylist()
    bucket = table.column("bucket")[0].as_py()
    width = plan.context * (8 if plan.words else 1)
    kind = np.uint64 if plan.words else np.uint8
    sizes = [len(x) // (8 + width) for x in payloads]
    least = np.concatenate([np.frombuffer(x, np.int64, n) for x, n in zip(payloads, sizes, strict=True)])
    tokens = np.concatenate(
        [np.frombuffer(x, kind, n * plan.context, 8 * n).reshape(n, plan.context) for x, n in zip(payloads, sizes, strict=True)]
    )
    del payloads
    anchors = tokens[:, plan.offsets - 1 : plan.offsets - 1 + plan.gram]
    powers, _ = k._grow(plan.gram + 1)
    group = np.empty(len(tokens), np.uint64)
    for a in range(0, len(tokens), 1 << 14):
        part = anchors[a : a + (1 << 14)]
        group[a : a + (1 << 14)] = ((part if plan.words else k.BYTE_CODE[part]) * powers[: plan.gram]).sum(axis=1)
    order = np.argsort(group, kind="stable")
    edges = np.concatenate([[0], np.flatnonzero(np.diff(group[order])) + 1, [len(order)]])
    masks = np.zeros(len(tokens), np.uint32)
    bit = np.arange(plan.offsets, dtype=np.uint32)
    for a, b in k.slices(edges * plan.context, plan.search_tokens):
        rows = order[edges[a] : edges[b]]
        lowest = plan.resolve(tokens[rows], least[rows], np.repeat(np.arange(b - a), np.diff(edges[a : b + 1])))
        masks[rows] = ((lowest < least[rows][:, None]).astype(np.uint32) << bit).sum(axis=1, dtype=np.uint32)
    done, out = 0, []
    for block, n in zip(blocks, sizes, strict=True):
        out.append((bucket, CONTEXTS, block, masks[done : done + n].tobytes()))
        done += n
    return _messages(out)


def covered_tokens(block: Block, answers: dict, buckets: int) -> np.ndarray:
    """Step 4: which of the block's tokens lie in a window that starts in a smaller id."""
    p = block.plan
    (occurrences, _, least, group), (starts, doc, keys, window_least, of_window) = _plan_messages(block, answers, buckets)
    anchors = block.hash[occurrences] & ~np.uint64(3)
    every = np.uint32((1 << p.offsets) - 1)
    # contexts are sorted by anchor: each bucket's answer covers one run of them
    of_context = np.zeros(len(least), np.uint64)
    of_context[group] = anchors
    smaller_has, wanted = _digest_bits(of_context, answers, buckets)
    masks = np.where(smaller_has, every, np.uint32(0))
    sent = np.zeros(int(wanted.sum()), np.uint32)
    for bucket, a, b in _runs(_bucket(of_context[wanted], buckets)):
        sent[a:b] = np.frombuffer(answers[CONTEXTS, bucket], np.uint32)
    masks[wanted] = sent
    mark = np.zeros(len(block.tokens) + 1, bool)
    if len(occurrences):
        ids = block.ids[block.doc[occurrences]]
        mask = np.where(ids > least[group], every, masks[group])
        low, high = block.of_text[block.doc[occurrences]], block.of_text[block.doc[occurrences] + 1]
        some = np.flatnonzero(mask)
        mask, low, high, at = mask[some], low[some], high[some], block.at[occurrences][some]
        for o in range(p.offsets):
            s = at - (p.offsets - 1) + o
            ok = ((mask >> np.uint32(o)) & np.uint32(1)).astype(bool) & (s >= low) & (s + p.window <= high)
            mark[s[ok]] = True
    if len(starts):
        smaller = np.zeros(len(window_least), bool)
        for bucket, a, b in _runs(_bucket(keys[:, 0], buckets)):
            smaller[a:b] = np.unpackbits(np.frombuffer(answers[WINDOWS, bucket], np.uint8), count=b - a).astype(bool)
        hit = (block.ids[doc] > window_least[of_window]) | smaller[of_window]
        mark[starts[hit]] = True
    counts = np.cumsum(mark[:-1], dtype=np.int64)
    before = np.zeros_like(counts)
    before[p.window :] = counts[: -p.window] if len(counts) > p.window else 0
    return counts > before


def _answers(table: pa.Table) -> dict:
    rows = zip(table.column("kind").to_pylist(), table.column("bucket").to_pylist(), table.column("payload").to_pylist(), strict=True)
    return {(kind, bucket): payload for kind, bucket, payload in rows}


def _folded(texts: DataFrame, block_bytes: int) -> DataFrame | None:
    """Rows of one id and text that would fill a block alone, as one row with their ``copies``; None if there are none.

    They get equal results, and a hash of id and text cannot part them. What repeats
    is found by counts of such hashes; rows are folded on the map side, by id and text.
    """
    keyed = texts.withColumn("_key", F.xxhash64("doc_id", "text"))
    size = F.max(F.coalesce(F.octet_length("text"), F.lit(0))) + ROW_BYTES
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), size.alias("_size"))
    hot = counts.where((F.col("_n") > 1) & (F.col("_n") * F.col("_size") > block_bytes)).select("_key", F.lit(True).alias("_hot"))
    found = hot.count()  # each stands for a block's bytes
    if not found:
        return None
    marked = keyed.join(F.broadcast(hot) if found <= BROADCAST_KEYS else hot, "_key", "left")
    single = marked.where("_hot IS NULL").select("doc_id", "text", F.lit(1).cast("long").alias("copies"))
    return single.unionByName(marked.where("_hot").groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies")))


def _unfolded(results: DataFrame) -> DataFrame:
    """Each result as often as its row was there."""
    runs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / LISTED))
    listed = results.select("*", F.explode(runs).alias("_run"))
    here = F.least(F.lit(LISTED).cast("long"), F.col("copies") - F.col("_run") * LISTED)
    each = listed.select("*", F.explode(F.sequence(F.lit(1).cast("long"), here)).alias("_copy"))
    return each.drop("copies", "_run", "_copy")


def dedup(
    docs: DataFrame,
    plan: Plan,
    finish: Callable[[Block, np.ndarray], pa.Table],
    schema: str,
    text_col: str = "text",
    id_col: str = "doc_id",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All steps; ``finish`` turns a block and its covered tokens into result rows."""
    ship(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(1, math.ceil(total / block_bytes)), max(1, math.ceil(total / bucket_bytes))
    folded = _folded(texts, block_bytes)
    if folded is not None:
        texts, schema = folded, f"{schema}, copies long"
    dealt = texts.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    by_block, folds = dealt.groupBy("block"), folded is not None

    def send_anchors(key: tuple, table: pa.Table) -> pa.Table:
        return _messages(_anchor_messages(Block(table, plan), key[0].as_py(), buckets))

    def answer_shared(table: pa.Table) -> pa.Table:
        return _answer_shared(table, plan)

    def send_digests(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return _messages([])
        return _messages(_digest_messages(Block(table, plan), key[0].as_py(), _answers(answers), buckets))

    def answer_digests(key: tuple, table: pa.Table) -> pa.Table:
        return _echo(table) if key[0].as_py() < 0 else _answer_digests(table, plan)

    def send_contexts(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return _messages([])
        return _messages(_context_messages(Block(table, plan), key[0].as_py(), _answers(answers), buckets))

    def answer_contexts(key: tuple, table: pa.Table) -> pa.Table:
        return _echo(table) if key[0].as_py() < 0 else _answer_contexts(table, plan)

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(table, plan)
        rows = finish(block, covered_tokens(block, _answers(answers), buckets))
        return rows.append_column("copies", table.column("copies")) if folds else rows

    def ask(answers: DataFrame, send, answer) -> DataFrame:
        """Blocks send to buckets by what they know; the answers, by block."""
        sent = by_block.cogroup(answers.groupBy("block")).applyInArrow(send, MESSAGE_DDL)
        return sent.groupBy("bucket").applyInArrow(answer, MESSAGE_DDL)

    shared = by_block.applyInArrow(send_anchors, MESSAGE_DDL).groupBy("bucket").applyInArrow(answer_shared, MESSAGE_DDL)
    answers = ask(ask(shared, send_digests, answer_digests), send_contexts, answer_contexts)
    results = by_block.cogroup(answers.groupBy("block")).applyInArrow(remove, schema)
    return _unfolded(results) if folds else results
