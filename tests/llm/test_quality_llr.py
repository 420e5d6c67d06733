"""Counts, scores and verdicts against a plain version with the same hashes."""

import math

import xxhash
from _brute import words

from playlake.llm import quality_llr as q

BUCKETS = 64


def _hash(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode(), seed)
    return seed - (1 << 64) if seed >= 1 << 63 else seed


def _buckets(text):
    w = [x.lower() for x in words(text)]
    return [_hash(x) % BUCKETS for x in w] + [_hash(a, b) % BUCKETS for a, b in zip(w, w[1:])]


def _base(text):
    t = text or ""
    w = words(t)
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    count = {}
    for i in range(len(w) - 2):
        count[tuple(w[i : i + 3])] = count.get(tuple(w[i : i + 3]), 0) + 1
    inside = {p for i in range(len(w) - 2) if count[tuple(w[i : i + 3])] > 1 for p in range(i, i + 3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(inside), failed)


def _texts():
    good = " ".join(f"word{i % 37} and thing{i % 11}" for i in range(60))
    bad = " ".join(f"WIN{i % 5} $$$ cash{i}" for i in range(40))
    return [
        (1, good), (2, good.replace("and", "or")), (3, bad), (4, None), (5, ""), (6, " \n\t "), (7, "a b c a b c a b"),
        (8, "one line\n\none line\n \none line x"), (9, "x " * 5000), (10, "é😀 ß\x0b|<>\x0c#"), (None, good), (3, bad),
        (11, " ".join(f"u{i}" for i in range(30_000))),
    ]


def test_against_plain_version(spark, make_docs):
    rows = _texts()
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 1, 0), (3, 0, 1), (None, 1, 0), (8, None, 0)], "doc_id long, quality int, toxic int")
    docs = make_docs(rows)
    model = q.fit(docs, labels, buckets=BUCKETS)
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for i, t in rows:
        for b in _buckets(t):
            raw[b] += 1
            target[b] += i in (1, 2)
    ratio = [
        math.log((t + 1) / (sum(target) + BUCKETS)) - math.log((r + 1) / (sum(raw) + BUCKETS)) for r, t in zip(raw, target)
    ]
    assert max(abs(a - b) for a, b in zip(ratio, model.log_ratio)) < 1e-12
    got = {}
    for r in q.assess(docs, model).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        for r in got[i]:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == _base(t), i
            hashed = _buckets(t)
            score = sum(ratio[b] for b in hashed) / len(hashed) if hashed else 0.0
            assert abs(r.score - score) < 1e-9
            assert r.kept == (not r.base_failed and r.score >= model.threshold)
    kept = q.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(i) for i, rs in got.items() for r in rs if r.kept
    )


def test_no_labels_and_empty_table(spark, make_docs):
    docs = make_docs(_texts())
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = q.fit(docs, none, buckets=BUCKETS)
    assert set(model.log_ratio) == {0.0}
    assert q.assess(docs.limit(0), q.fit(docs.limit(0), none, buckets=BUCKETS)).collect() == []


def test_no_python_on_the_main_path(spark, make_docs):
    docs = spark.range(3).selectExpr("id as doc_id", "cast(id as string) as text")
    plan = q.assess(docs, q.Model((0.0,) * BUCKETS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_separates_labelled_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    r = q.assess(docs, q.fit(docs, labels)).join(labels, "doc_id").where("not base_failed").toPandas()
    assert r[r.quality == 1].kept.mean() > 0.98
    assert r[r.quality == 0].kept.mean() < 0.1
