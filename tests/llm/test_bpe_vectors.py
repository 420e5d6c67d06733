"""Byte-level BPE (against tiktoken), whitening (against an eigendecomposition), hard negatives (against all pairs)."""

import hashlib
import math
import random

import numpy as np
import pytest
from _brute import mixed_corpus

from playlake.llm import byte_bpe, hard_negatives, queries, whitening

# --- byte-level BPE ---------------------------------------------------------

POOLS = (
    "abcdefghijklmnopqrstuvwxyz", "  \n\t'sdmrlvte1aA.!\r", "日本語中文字漢字がなカナ한국어", "абвгдежзийклмн ",
    "éèüßñ😀👍🏽́‍", "0123456789٣四", "".join(map(chr, (0x558, 0x11DE0, 0x88F, 0x85, 0x1C, 0x180E, 0x2028, 0xA0, 0xE000, 0x10FFFF))),
)


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(byte_bpe.VOCABULARY)


@pytest.fixture(scope="module")
def reference(codec):
    import public_tokenizers
    import tiktoken

    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.merger.ranks, special_tokens={})
    return lambda t: np.array(library.encode_ordinary(t), "<u4").tobytes()


def _texts(seed, n):
    r = random.Random(seed)
    for _ in range(n):
        pools = r.sample(POOLS, r.randint(1, 4))
        t = "".join(r.choice(r.choice(pools)) for _ in range(r.choice([1, 3, 10, 60, 300])))
        yield t + r.choice(t) * r.randint(0, 700) if r.random() < 0.2 else t


def test_ids_are_those_of_the_library(codec, reference):
    texts = list(_texts(1, 600))
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids == reference(text)
        assert codec.decode(ids) == text.encode()


@pytest.mark.parametrize("name, value", [("LONG", 6), ("SLICE", 16), ("TOGETHER", 40), ("CELLS", 64), ("CACHE_BYTES", 100)])
def test_any_cut_of_the_work_gives_the_same_ids(codec, reference, monkeypatch, name, value):
    monkeypatch.setattr(byte_bpe, name, value)
    monkeypatch.setattr(codec, "cache", {})
    texts = list(_texts(2, 250))
    assert list(codec.encode(texts)) == [reference(t) for t in texts]


def test_merges_whose_new_pair_comes_first():
    """Ranks that no training would give: a merge may open a pair of lower rank, which is then merged next."""
    r = random.Random(3)
    for _ in range(60):
        made = {bytes([b]) for b in b"ab"}
        while len(made) < 14:
            made.add(r.choice(sorted(made)) + r.choice(sorted(made)))
        extra = r.sample(sorted(t for t in made if len(t) > 1), 12)
        ranks = {bytes([b]): 1000 + b for b in range(256)} | {t: i for i, t in enumerate(extra)}
        merger = byte_bpe.Merger(ranks)
        for _ in range(20):
            text = bytes(r.choice(b"ab") for _ in range(r.randint(2, 40)))
            parts = [bytes([b]) for b in text]
            while True:
                found = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]
                if not found:
                    break
                _, i = min(found)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            want = np.array([ranks[p] for p in parts], "<u4").tobytes()
            ids = merger.of_byte[np.frombuffer(text, np.uint8)]
            assert merger.rows(ids[None].copy())[0] == want
            assert merger.long_row(ids.copy()) == want


def test_long_matches_end_soon(codec, reference):
    for text in ("a" * 300_000, "=-" * 100_000, "".join(random.Random(4).choice("acgt") for _ in range(50_000)), "ab " * 200_000):
        assert list(codec.encode([text])) == [reference(text)]


def test_documents_round_trip(make_docs, reference):
    rows = mixed_corpus(7, 40) + [(300, "<|endoftext|> 's 'll"), (301, "x " * 30_000), (302, "  \x85\x00 日本語")]
    encoded = byte_bpe.encode(make_docs(rows))
    got = byte_bpe.decode(encoded).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(((i, reference(t or ""), (t or "").encode()) for i, t in rows), key=key)
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got), key=key) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in got)
    assert byte_bpe.encode(make_docs(rows).limit(0)).collect() == []
    nulls = encoded.selectExpr("doc_id", "cast(null as binary) as ids").limit(1)
    assert [bytes(r.decoded) for r in byte_bpe.decode(nulls).collect()] == [b""]


def test_op11_query(spark, reference):
    got = {r.doc_id: r for r in queries.op11_byte_bpe(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for i, text in docs:
        ids = reference(text or "")
        assert tuple(got[i]) == (i, len(ids) // 4, sha(ids), sha((text or "").encode()))


# --- vectors ----------------------------------------------------------------

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n int, score int"


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


def _usable(v, length):
    return v is not None and len(v) == length and all(c is not None and math.isfinite(c) for c in v)


def _plain_whitening(rows, length):
    x = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, _ in rows if _usable(v, length)]
    fit = np.array(sorted({tuple(v) for _, v in x}), np.int64)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, e[::-1], axes[:, ::-1]


def _check_whitening(spark, rows, length, components):
    frame = _frame(spark, rows)
    model = whitening.fit(frame)
    got = whitening.whiten(frame, model).collect()
    x, n, sums, e, axes = _plain_whitening(rows, length)
    assert len(got) == components * len(x)
    by_id = {}
    for r in got:
        by_id.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert sorted(by_id, key=lambda i: (i is None, i)) == sorted({i for i, _ in x}, key=lambda i: (i is None, i))
    sign = np.sign((model.axes * axes[:, :components]).sum(0))
    for i in by_id:
        own = [v for j, v in x if j == i]
        for c in range(components):
            found = by_id[i][c + 1]
            want = sorted(float((np.array(v) - sums / n) @ axes[:, c] / math.sqrt(e[c]) * sign[c]) for v in own)
            assert np.allclose(sorted(r.whitened for r in found), want, atol=1e-7)
            assert all(r.n == n and abs(r.explained - e[c] / e.sum()) <= 1e-4 * e[c] / e.sum() and r.identity_error < 1e-9 for r in found)
            devs = [sum((n * int(k) - int(s)) ** 2 for k, s in zip(v, sums)) for v in own]
            assert sorted(r.deviation for r in found) == sorted(devs)


def test_whitening_against_an_eigendecomposition(spark):
    r = np.random.default_rng(5)
    mixing = r.normal(size=(20, 20)) * np.logspace(0, 1.5, 20)
    rows = [(i, [float(c) for c in r.normal(size=20) @ mixing], 1) for i in range(300)]
    rows += [(400 + i, rows[7][1], 1) for i in range(90)]  # copies count once in the fit
    rows += [(7, rows[8][1], 2), (None, rows[9][1], 1), (500, None, 1), (501, [None] + [0.0] * 19, 1), (502, [float("nan")] * 20, 1)]
    rows += [(503, [float("-inf")] * 20, 1), (504, [1.0] * 19, 1), (505, [], 1)]
    _check_whitening(spark, rows, 20, 16)


def test_whitening_of_dependent_dimensions(spark):
    """Rank 3 of 6: only axes with a spread come back, and the rest does not disturb them."""
    r = np.random.default_rng(6)
    rows = []
    for i in range(120):
        a, b, c = (float(v) for v in r.integers(-50, 50, 3))
        rows.append((i, [a, b, c, a, a + b, 1.0], 0))
    _check_whitening(spark, rows, 6, 3)


def test_whitening_edges(spark):
    for rows in ([], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0)] * 3, [(1, [], 0)], [(1, None, 0)]):
        frame = _frame(spark, rows) if rows else _frame(spark, [(1, None, 0)]).limit(0)
        assert whitening.whiten(frame, whitening.fit(frame)).collect() == []
    far = _frame(spark, [(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [0.0, -1.0], 0)])
    got = whitening.whiten(far, whitening.fit(far)).collect()
    assert {r.deviation for r in got if r.vec_id != 3} == {None}  # beyond a long


def test_whitening_sums_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    r = np.random.default_rng(8)
    rows = [(i, [float(c) for c in r.normal(size=5)], 0) for i in range(200)]
    model = whitening.fit(_frame(spark, rows).repartition(9))
    _, n, _, e, axes = _plain_whitening(rows, 5)
    assert model.centre.n == n and np.allclose(model.variances, e, rtol=1e-12)


def _plain_negatives(rows, length):
    use = [
        (i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, np.array([math.floor(256 * float(np.float32(c))) for c in v]))
        for i, v, label in rows
        if label is not None and _usable(v, length)
    ]
    out = []
    for a, (i, label, x) in enumerate(use):
        if i is None or i % 100:
            continue
        score = [int(x @ y) for _, _, y in use]
        order = sorted(range(len(use)), key=lambda j: (-score[j], use[j][0] is None, use[j][0] or 0))
        for p in [j for j in order if j != a and use[j][1] == label][:5]:
            window = [j for j in order if use[j][1] != label and 30 * score[p] <= 100 * score[j] <= 90 * score[p]]
            out += [(i, use[p][0], k, use[j][0], score[p], score[j]) for k, j in enumerate(window[:10], 1)]
    return sorted(out, key=str)


def _vector_rows(seed, n=700, d=6):
    """Clusters of rows, ties, a hot label, repeated rows and ids, and rows that take no part."""
    r = random.Random(seed)
    centres = [[r.uniform(-1, 1) for _ in range(d)] for _ in range(8)]
    rows = []
    for i in range(n):
        v = [round(c + r.uniform(-0.2, 0.2), r.choice([1, 3])) for c in r.choice(centres)]
        rows.append((i * r.choice([1, 1, 25]), v, r.choice([3, 3, 3, *range(10)])))
    rows += [(100, rows[0][1], 3)] * 3 + [(200, [0.0] * d, 1), (300, [-c for c in rows[1][1]], 2), (-700, rows[2][1], 9)]
    rows += [(None, rows[3][1], 3), (None, rows[4][1], 4), (400, None, 3), (500, rows[5][1], None), (600, [None] * d, 1)]
    return rows + [(800, [float("inf")] * d, 2), (900, [1.0] * (d + 1), 2), (1000, [], 2)]


@pytest.mark.parametrize("cut", [{}, {"block": 20, "tree": 4}])
def test_hard_negatives_against_all_pairs(spark, cut):
    rows = _vector_rows(9)
    got = hard_negatives.mine(_frame(spark, rows), **cut).collect()
    assert sorted(map(tuple, got), key=str) == _plain_negatives(rows, 6)


def test_hard_negative_edges(spark):
    for rows in ([], [(100, [1.0], None)], [(100, [], 1)], [(100, [1.0], 1)], [(1, [1.0], 1), (2, [1.0], 1)]):
        frame = _frame(spark, rows) if rows else _frame(spark, [(1, None, 0)]).limit(0)
        assert hard_negatives.mine(frame).collect() == []
    few = [(100, [1.0], 1), (1, [2.0], 1), (2, [1.0], 2), (3, [1.5], 3), (5, [-9.0], 1)]
    assert [tuple(r) for r in hard_negatives.mine(_frame(spark, few)).collect()] == _plain_negatives(few, 1)


def test_bounds_hold_and_spare_scores():
    """Every candidate in a window is found, and near anchors of a tree spare most exact scores."""
    r = np.random.default_rng(10)
    points = np.concatenate([c + r.integers(-3, 4, (40, 16)) for c in r.integers(-300, 300, (5, 16))])
    order, parent, edge = hard_negatives._spanning_tree(points)
    assert sorted(order.tolist()) == list(range(len(points))) and all(p < i for i, p in enumerate(parent.tolist()) if i)
    placed = points[order]
    assert np.allclose(edge[1:], np.sqrt(((placed[1:] - placed[parent[1:]]) ** 2).sum(1)))
    last = np.arange(len(points))
    last[parent[1:]] = np.arange(1, len(points))
    up = np.where(np.arange(len(points)) == 0, -1, parent)
    anchors = hard_negatives.Anchors(placed, up, edge, np.zeros(len(points), np.int64), last)
    x = r.integers(-300, 300, (2000, 16))
    found = {}
    window = (200_000, 400_000)
    scored = hard_negatives._walk(
        anchors, x, lambda a: window, lambda a, i, s: found.update({(a, j): v for j, v in zip(i.tolist(), s.tolist())}),
        lambda a: np.ones(len(x), bool),
    )
    score = placed @ x.T
    want = {(a, j): int(score[a, j]) for a, j in zip(*np.nonzero((score >= window[0]) & (score <= window[1])))}
    assert found == want
    assert scored < score.size / 3


def test_columns_of_the_queries(spark):
    sf = "/root/testdata/sf0.001"
    assert queries.op12_whitening(spark, sf).schema.simpleString() == (
        "struct<vec_id:bigint,component:int,n:bigint,deviation:bigint,whitened:double,explained:double,identity_error:double>"
    )
    assert queries.op13_hard_negatives(spark, sf).schema.simpleString() == (
        "struct<anchor_id:bigint,positive_id:bigint,rank:int,negative_id:bigint,positive_score:bigint,negative_score:bigint>"
    )
