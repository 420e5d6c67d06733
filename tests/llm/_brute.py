"""Plain versions of the operators' definitions, for small fixtures."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
AZ = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def runs(covered):
    out, start = [], None
    for i, c in enumerate([*covered, False]):
        if c and start is None:
            start = i
        if not c and start is not None:
            out.append((start, i))
            start = None
    return out


def covered_by_smaller(rows, tokens, window):
    """For each (id, text): its tokens, and which lie in a window that starts in a smaller id."""
    first = {}
    for doc_id, text in rows:
        x = tokens(text)
        for s in range(len(x) - window + 1):
            key = bytes(x[s : s + window]) if isinstance(x, bytes) else tuple(x[s : s + window])
            if doc_id is not None and (key not in first or doc_id < first[key]):
                first[key] = doc_id
    out = []
    for doc_id, text in rows:
        x = tokens(text)
        covered = [False] * len(x)
        for s in range(len(x) - window + 1):
            key = bytes(x[s : s + window]) if isinstance(x, bytes) else tuple(x[s : s + window])
            if key in first and (doc_id is None or first[key] < doc_id):
                covered[s : s + window] = [True] * window
        out.append((doc_id, x, covered))
    return out


def shingle_set(text, n=5):
    w = words((text or "").translate(AZ))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def near_dup_classes(rows, percent):
    """(id, set size, smallest id reachable) by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            root = find(i)
            least[root] = min(least.get(root, doc_id), doc_id)
    return [(doc_id, len(s), least.get(find(i)) if s else doc_id) for i, ((doc_id, _), s) in enumerate(zip(rows, sets))]


def mixed_corpus(seed, n=80):
    """Short texts with shared passages, copies, edges of many kinds, nulls and repeated rows."""
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé😀") for _ in range(r.randint(1, 6))) for _ in range(60)]
    passages = [" ".join(r.choice(vocab) for _ in range(r.randint(10, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [
            r.choice(passages) if r.random() < 0.5 else " ".join(r.choice(vocab) for _ in range(r.randint(1, 60)))
            for _ in range(r.randint(0, 6))
        ]
        rows.append((i if r.random() < 0.95 else None, r.choice([" ", "\n", "  "]).join(parts)))
    rows += [
        (200, rows[3][1]), (201, None), (202, ""), (203, "a" * 400), (204, "a" * 300), (205, "ab" * 200),
        (5, rows[5][1]), (5, rows[5][1]), (206, "x " * 100), (207, " x" * 90), (208, " \n "), (None, rows[3][1]),
    ]
    r.shuffle(rows)
    return rows
