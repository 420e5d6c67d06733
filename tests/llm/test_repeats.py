"""Byte and word dedup against all windows compared, on several blocks and buckets."""

import pytest
from _brute import covered_by_smaller, mixed_corpus, runs, words

from playlake.llm import _repeats, byte_dedup, word_dedup

SMALL = {"block_bytes": 6000, "bucket_bytes": 5000}
HOT = [{}, {"hot_blocks": 2}, {"hot_crowded": 1, "crowd": 2}]


def _key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("hot", HOT)
def test_bytes(make_docs, hot):
    rows = mixed_corpus(1)
    got = byte_dedup.dedup(make_docs(rows), **SMALL, **hot).collect()
    got = sorted(((r.doc_id, r.n_bytes, bytes(r.kept), list(zip(r.removed_starts, r.removed_ends))) for r in got), key=_key)
    brute = covered_by_smaller(rows, lambda t: (t or "").encode(), 50)
    want = sorted(((i, len(x), bytes(b for b, c in zip(x, cov) if not c), runs(cov)) for i, x, cov in brute), key=_key)
    assert got == want
    assert any(r[3] for r in got)


@pytest.mark.parametrize("hot", HOT)
def test_words(make_docs, hot):
    rows = mixed_corpus(2)
    got = word_dedup.dedup(make_docs(rows), subtree_limit=9, **SMALL, **hot).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=_key)
    brute = covered_by_smaller(rows, words, 13)
    want = sorted(((i, len(x), sum(cov), " ".join(w for w, c in zip(x, cov) if not c)) for i, x, cov in brute), key=_key)
    assert got == want


def test_rows_of_one_id_and_text(make_docs):
    """A third of all rows equal, with and without id, text and a smaller id: folded into one row, all returned."""
    rows = mixed_corpus(3)
    text = max((t for _, t in rows if t), key=lambda t: len(t) if len(t) < 3000 else 0)
    rows += [(10**6, text)] * 40 + [(-5, "of its own " + text[:400])] * 50 + [(None, text)] * 30 + [(7, None)] * 200 + [(None, " ")] * 150
    folded = _repeats._folded(make_docs(rows), SMALL["block_bytes"])
    assert sorted(r.copies for r in folded.where("copies > 1").collect())[-5:] == [30, 40, 50, 150, 200]
    got = byte_dedup.dedup(make_docs(rows), **SMALL).collect()
    got = sorted(((r.doc_id, r.n_bytes, bytes(r.kept), list(zip(r.removed_starts, r.removed_ends))) for r in got), key=_key)
    brute = covered_by_smaller(rows, lambda t: (t or "").encode(), 50)
    assert got == sorted(((i, len(x), bytes(b for b, c in zip(x, cov) if not c), runs(cov)) for i, x, cov in brute), key=_key)
    got = word_dedup.dedup(make_docs(rows), subtree_limit=9, **SMALL).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=_key)
    brute = covered_by_smaller(rows, words, 13)
    assert got == sorted(((i, len(x), sum(cov), " ".join(w for w, c in zip(x, cov) if not c)) for i, x, cov in brute), key=_key)


def test_copies_beyond_one_list(spark):
    """More copies than one array lists come back in full."""
    results = spark.createDataFrame([(1, 1), (2, 4096), (3, 4097), (4, 10_000)], "doc_id long, copies long")
    assert {r.doc_id: r["count"] for r in _repeats._unfolded(results).groupBy("doc_id").count().collect()} == {1: 1, 2: 4096, 3: 4097, 4: 10_000}


def test_long_text_and_empty_table(spark, make_docs):
    long = " ".join(str(i * i) for i in range(60_000))
    rows = [(1, long), (2, "before " + long[1000:5000] + " after"), (3, "z" * 300_000)]
    got = {r.doc_id: r for r in byte_dedup.dedup(make_docs(rows), **SMALL).collect()}
    assert bytes(got[2].kept) == b"before  after" or len(got[2].kept) < 20
    assert got[1].removed_starts == [] and got[3].removed_starts == []
    assert byte_dedup.dedup(make_docs(rows).limit(0)).collect() == []
    assert word_dedup.dedup(make_docs(rows).limit(0)).collect() == []


def test_subtrees_hold_whole_prefixes():
    import numpy as np

    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 3, (500, 6)).astype(np.int32)
    parts = word_dedup.prefix_parts(tokens, 20)
    assert sorted(np.concatenate([r for r, _ in parts]).tolist()) == list(range(500))
    assert all(len(r) <= 20 or d == 6 for r, d in parts)
    owner = {}
    for at, (rows, _) in enumerate(parts):
        for row in rows:
            assert owner.setdefault(tuple(tokens[row]), at) == at


def test_interval_expansion_is_the_common_prefix():
    import numpy as np

    rng = np.random.default_rng(4)
    strings = rng.integers(97, 99, (40, 20)).astype(np.uint16)
    strings[7] = strings[3]
    group = np.repeat([0, 1], [25, 15])
    order = byte_dedup.suffix_array(strings, group, 9)
    together = byte_dedup.expand_intervals(strings, group, order, 9)
    suffix = [(int(group[i // 20]), bytes(strings[i // 20, i % 20 :].astype(np.uint8))) for i in order]
    assert [(g, s[:9]) for g, s in suffix] == sorted((g, s[:9]) for g, s in suffix)
    want = [False] + [g == h and len(a) >= 9 and a[:9] == b[:9] for (g, a), (h, b) in zip(suffix, suffix[1:])]
    assert together.tolist() == want
