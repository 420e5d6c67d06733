"""Near-dedup against all pairs compared on the full sets."""

import random

import numpy as np
import pytest
from _brute import mixed_corpus, near_dup_classes

from playlake.llm import near_dup


def _families(seed):
    """Families of edited copies (similarities around the threshold), exact copies, unrelated texts."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5)))
    rows, n = [], 0
    for _ in range(12):
        base = [word() for _ in range(r.randint(20, 120))]
        for _ in range(r.randint(1, 14)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 4])):
                copy[r.randrange(len(copy))] = word()
            if r.random() < 0.3:
                base = copy  # drift: chains of links
            rows.append((n, (" " if r.random() < 0.9 else "\n").join(copy)))
            n += 1
    rows += [(n + 1, None), (n + 2, ""), (n + 3, " \t\n"), (n + 4, "one two"), (n + 5, "ONE two"), (n + 6, "one"), (3, rows[3][1])]
    rows += [(None, rows[0][1]), (None, "only here and nowhere else at all"), (None, None), (2, rows[2][1].upper())]
    rows += [(n + 7, " ".join(str(i) for i in range(30_000))), (n + 8, " ".join(str(i) for i in range(29_000)))]
    r.shuffle(rows)
    return rows


def _check(got, rows, percent):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)
    assert got == sorted(near_dup_classes(rows, percent), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_components(make_docs, seed):
    rows = _families(seed)
    found = near_dup.classes(make_docs(rows), percent=85).collect()
    _check(found, rows, 85)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_branching_and_large_clusters(make_docs):
    """Tiny leaves (every tree branches to its depth), and clusters that do not fit a task."""
    rows = _families(3)
    _check(near_dup.classes(make_docs(rows), leaf=3, trees=24).collect(), rows, 85)
    _check(near_dup.classes(make_docs(rows), cluster_sets=4).collect(), rows, 85)
    _check(near_dup.classes(make_docs(rows), leaf=6, trees=24, tokens=(1, 1, 2, 2, 4), cluster_sets=4).collect(), rows, 85)


def test_other_texts_and_empty_table(make_docs):
    rows = mixed_corpus(5)
    _check(near_dup.classes(make_docs(rows), percent=80).collect(), rows, 80)
    assert near_dup.classes(make_docs(rows).limit(0)).collect() == []
    assert near_dup.keep_one(make_docs(rows).limit(0)).collect() == []


def test_keep_one(make_docs):
    rows = _families(4)
    docs = make_docs(rows)
    kept = near_dup.keep_one(docs, percent=85)
    assert kept.columns == docs.columns
    classes = near_dup_classes(rows, 85)
    want = {i for i, size, c in classes if size and i is not None and i == c}
    got = [r.doc_id for r in kept.collect() if r.text and r.text.split()]
    assert sorted(i for i in got if i is not None) == sorted(want)
    empty = sum(1 for _, size, _ in classes if not size)
    assert sum(1 for r in kept.collect() if not (r.text and r.text.split())) == empty


def test_star_groups_and_all_pairs_agree():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (6, near_dup.COMPARED), dtype=np.uint8)
    compact = base[rng.integers(0, 6, 60)]
    noise = rng.random(compact.shape) < 0.1
    compact = np.where(noise, rng.integers(0, 256, compact.shape), compact).astype(np.uint8)
    node = rng.integers(0, 3, 60).astype(np.int64)

    def groups(a, b):
        label = list(range(60))
        for x, y in zip(a.tolist(), b.tolist()):
            old, new = label[x], label[y]
            label = [new if v == old else v for v in label]
        return {frozenset(i for i in range(60) if label[i] == v) for v in set(label)}

    stars = near_dup._compare_leaves(node, compact, 0.66, True)
    pairs = near_dup._compare_leaves(node, compact, 0.66, False)
    assert groups(*stars) == groups(*pairs) and len(stars[0]) < 60 < len(pairs[0])


def test_search_finds_all_links():
    rng = np.random.default_rng(5)
    sets = []
    for family in range(12):
        base = rng.integers(0, 5000, rng.integers(1, 60))
        for _ in range(12):
            copy = base.copy()
            some = rng.random(len(copy)) < rng.choice([0.0, 0.03, 0.1])
            copy[some] = rng.integers(0, 5000, some.sum())
            sets.append(np.unique(copy).astype(np.uint64))
            if rng.random() < 0.4:
                base = copy
    for percent in (50, 85, 100):
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
        label = near_dup.exact_components(np.concatenate(sets), bounds, percent)
        want = list(range(len(sets)))
        for i in range(len(sets)):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    old, new = want[i], want[j]
                    want = [new if v == old else v for v in want]
        assert len({*zip(label.tolist(), want)}) == len(set(want)) == len(set(label.tolist()))


def test_threshold_is_exact():
    a, b = np.arange(100, dtype=np.uint64), np.arange(85, dtype=np.uint64)
    values = np.concatenate([a, b])
    bounds = np.array([0, 100, 185])
    assert near_dup.exact_components(values, bounds, 85).tolist() == [0, 0]
    assert near_dup.exact_components(values, bounds, 86).tolist() == [0, 1]


def _pages(seed, n, template, own):
    """Pages of one template whose own parts keep them under the threshold, some with an edited copy."""
    r = random.Random(seed)
    frame = [f"t{i}" for i in range(template)]
    rows = []
    for i in range(n):
        page = frame + [f"p{i}_{j}" for j in range(own)]
        rows.append((i, " ".join(page)))
        if i % 5 == 0:
            page[r.randrange(template)] = "edited"
            rows.append((1000 + i, " ".join(page)))
    return rows


@pytest.mark.parametrize("limits", [{}, {"hot": 4, "block": 2_000}, {"hot": 4, "block": 100_000}])
def test_sparse_links_in_a_large_family(make_docs, limits):
    """Template pages linked to their own copies alone: a cluster beyond a task keeps every link."""
    rows = _pages(7, 150, 90, 12)
    found = near_dup.classes(make_docs(rows), leaf=6, trees=2, tokens=(1,), cluster_sets=4, **limits).collect()
    _check(found, rows, 85)
    assert sum(not r.kept for r in found) == 30


def test_large_dense_cluster_without_all_pairs(make_docs, monkeypatch):
    """Near copies of one text beyond a task: no step has rows in the order of all pairs."""
    r = random.Random(9)
    base, rows = [f"w{i}" for i in range(120)], []
    for i in range(400):
        copy = list(base)
        copy[r.randrange(120)] = f"own{i}"
        rows.append((i, " ".join(copy)))
    kept, steps = near_dup._Scratch.keep, {}

    def counted(store, df, label):
        out = kept(store, df, label)
        steps[label] = max(steps.get(label, 0), out.count())
        return out

    monkeypatch.setattr(near_dup._Scratch, "keep", counted)
    found = near_dup.classes(make_docs(rows), cluster_sets=4, hot=16).collect()
    _check(found, rows, 85)
    assert max(steps.values()) < 400 * 399 / 8, steps


@pytest.mark.parametrize("hot", [1, 3, 10**9])
def test_components_of_hot_centres(spark, hot):
    """Stars, chains and both on one centre: the same components whether a vertex is hot or not."""
    r = random.Random(hot)
    name = lambda i: f"{i:04}".encode()
    edges = {(0, i) for i in range(1, 120)} | {(i, i + 1) for i in range(200, 240)} | {(i, 399) for i in range(300, 399)}
    edges |= {(r.randrange(500, 560), r.randrange(560, 620)) for _ in range(50)} | {(60, 210)}
    label = {v: v for e in edges for v in e}
    for a, b in sorted(edges) * 3:
        low, high = sorted((label[a], label[b]))
        label = {v: low if x == high else x for v, x in label.items()}
    df = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "a binary, b binary")
    got = near_dup.components(near_dup._Scratch(spark), df, hot).collect()
    assert sorted((bytes(x.key), bytes(x.root)) for x in got) == sorted((name(v), name(x)) for v, x in label.items())
    empty = near_dup.components(near_dup._Scratch(spark), df.limit(0), hot)
    assert empty.collect() == []
