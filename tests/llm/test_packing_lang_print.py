"""Packing (exact round trip), languages (held-out accuracy), fingerprints (against plain versions)."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from _brute import mixed_corpus, shingle_set, words

from playlake.llm import fingerprint, lang_filter, packing


def _check_packed(rows, docs, encode, length=2048):
    by_sequence, by_doc = {}, {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4")
        assert len(ids) == r.length > 0
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= length
        assert at == length or at & (at - 1) == 0  # full, or a power of two: no padding
    texts = {}
    for i, t in docs:
        texts.setdefault(i, []).append(t)
    assert set(by_doc) == set(texts)
    for i, pieces in by_doc.items():
        want = sorted([*encode(t or ""), 1] for t in texts[i])
        if len(want) == 1:
            pieces.sort(key=lambda p: p[0])
            assert np.concatenate([p[1] for p in pieces]).tolist() == want[0]
            at = 0
            for start, ids, total in pieces:
                assert start == at and total == len(want[0])
                at += len(ids)
        else:
            assert sum(len(p[1]) for p in pieces) == sum(map(len, want))


def test_packing_round_trip(make_docs):
    from tokenizers import Tokenizer

    import public_tokenizers

    reference = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = lambda t: reference.encode(t, add_special_tokens=False).ids
    docs = mixed_corpus(6) + [(300, "word " * 9000), (301, "<|endoftext|> in a text"), (302, "  \x85\x00 日本語"), (303, "x" * 20_000)]
    for most_open in (packing.MOST_OPEN, 3):
        rows = packing.pack(make_docs(docs), most_open=most_open).collect()
        _check_packed(rows, docs, encode)
    assert packing.pack(make_docs(docs).limit(0)).collect() == []


def test_same_ids_as_the_reference_library():
    encode = packing.Encoder()
    r = random.Random(1)
    common = [chr(c) for c in range(9, 0x180) if packing._COMMON.fullmatch(chr(c))]
    for _ in range(4000):
        t = "".join(r.choice(common) if r.random() < 0.6 else r.choice(" \n\t'sdmrlvte1aA.!\r") for _ in range(r.randint(1, 40)))
        assert encode(t)[:-1].tolist() == encode.reference.encode(t, add_special_tokens=False).ids


def test_sum_of_squares_rule():
    """The chosen level leaves the least sum of squared counts of all that have room."""
    rng = np.random.default_rng(2)
    packer = packing.Packer(16, 0)
    for _ in range(500):
        size = int(rng.integers(1, 16))
        n = packer.count.copy()

        def after(level):
            m = n.copy()
            if level:
                m[level] -= 1
            if level + size < 16:
                m[level + size] += 1
            return int((m[1:16] ** 2).sum())

        options = [0, *(h for h in range(1, 17 - size) if n[h])]
        assert after(packer.level_for(size)) == min(map(after, options))
        packer.add(0, np.arange(size, dtype=np.uint32))


def test_languages_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_filter.fit(docs)
    got = lang_filter.predict(docs, model).join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    import zlib

    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 3 == 1)).all()
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_edges(spark, make_docs):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(i, t, lang, "x") for i in range(40) for t, lang in (("the cat and the dog", "en"), ("le chat et le chien", "fr"))]
    rows += [(100, None, None, "x"), (101, "", "en", "x"), (102, "123 !?", "fr", "x"), (103, "жжжж", None, "x"), (None, "the cat", "de", "x")]
    docs = spark.createDataFrame(rows, schema)
    model = lang_filter.fit(docs)
    assert model.languages == ("en", "fr")  # a null id is not learned from
    got = {(r.doc_id, i): r for i, r in enumerate(lang_filter.predict(docs, model).collect())}
    pred = {k[0]: r for k, r in got.items()}
    assert {pred[i].lang_pred for i in (100, 101, 102)} == {"und"} and pred[100].score == 0
    assert pred[103].lang_pred in ("en", "fr") and pred[None].lang_pred == "en" and pred[None].held_out is False
    empty = lang_filter.fit(docs.where("lang is null"))
    assert {r.lang_pred for r in lang_filter.predict(docs, empty).collect()} == {"und"}
    assert lang_filter.predict(docs.limit(0), model).collect() == []


def test_more_languages_than_a_word_has_bits(spark):
    """70 languages, each of its own letters: all are learned and predicted."""
    words = [f"{chr(97 + i // 9) * 3}{chr(106 + i % 9) * 4}" for i in range(70)]
    rows = [(100 * i + n, f"{w} {w[::-1]} {w}", f"l{i:02}") for i, w in enumerate(words) for n in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lang_filter.fit(docs)
    assert len(model.languages) == 70
    want = {i: lang for i, _, lang in rows}
    assert all(r.lang_pred == want[r.doc_id] for r in lang_filter.predict(docs, model).collect())


def test_filter_returns_all_languages_of_an_ngram(spark):
    """Every n-gram entered for a language is found for it: a Bloom filter has no false negatives."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = lang_filter.fit(docs)
    raw = np.frombuffer("the and of ".encode() * 50, np.uint8)
    found, total = lang_filter.hits(raw, np.array([0, len(raw)]), model)
    assert total[0] == 2 * len(raw) - 5
    assert found[0, model.languages.index("en")] > 0.8 * total[0]
    assert (model.false_positive < 0.05).all()


def _plain_languages(learned, asked, slots, hashes):
    """The filter by dicts and sets of Python: hits, corrected verdict and score of each text."""

    def grams(text):
        folded = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in text.encode())
        return [(order, folded[i : i + order]) for order in lang_filter.ORDERS for i in range(len(folded) - order + 1)]

    def places(gram):
        code = int.from_bytes(bytes([gram[0]]) + gram[1], "big") & (2**64 - 1)
        shift = 64 - (slots.bit_length() - 1)
        return [(code * int(m) & (2**64 - 1)) >> shift for m in lang_filter._MULTIPLIERS[:hashes]]

    counts = {}
    for text, lang in learned:
        own = counts.setdefault(lang, {})
        for g in grams(text):
            own[g] = own.get(g, 0) + 1
    total = {lang: max(1, sum(own.values())) for lang, own in counts.items()}
    most, filled = {}, {}
    for lang, own in counts.items():
        for g, n in own.items():
            most[g] = max(most.get(g, 0.0), n / total[lang])
    for lang, own in counts.items():
        for g, n in own.items():
            if n / total[lang] >= lang_filter.MIN_SHARE and n / total[lang] * lang_filter.RATIO >= most[g]:
                for at in places(g):
                    filled.setdefault(at, set()).add(lang)
    languages = sorted(counts)
    chance = {lang: (sum(lang in own for own in filled.values()) / slots) ** hashes for lang in languages}
    out = []
    for text in asked:
        own = grams(text)
        found = dict.fromkeys(languages, 0)
        for g in own:
            for lang in set.intersection(*(filled.get(at, set()) for at in places(g))):
                found[lang] += 1
        part = [min(1.0, max(0.0, (found[x] / max(1, len(own)) - chance[x]) / max(1 - chance[x], 1e-9))) for x in languages]
        best = max(languages, key=lambda x: (total[x], -languages.index(x))) if sum(part) == 0 else languages[part.index(max(part))]
        if not any(c.isalpha() for c in text):
            best, part = "und", [0.0]
        out.append(([found[x] for x in languages], best, max(part) / max(sum(part), 1e-12)))
    return languages, out


@pytest.mark.parametrize("many", [5, 16, 17, 64, 130])
def test_filter_equals_plain_sets(spark, many):
    """Hits, correction and verdict against dicts and sets, in a filter small enough for false positives."""
    import zlib

    r = random.Random(many)
    stems = ["".join(r.choice("abcdefgij éßжλ漢") for _ in range(r.randint(2, 6))) for _ in range(60)]
    rows = []
    for i in range(3 * many):
        own = random.Random(i % many).sample(stems, 12)
        rows.append((7 * i, " ".join(r.choice(own) for _ in range(r.randint(1, 40))), f"l{i % many:03}"))
    rows += rows[:5] + [(9001, "", "l000"), (9002, "1 2!", "l001"), (9003, "XYZ", None), (9004, "qqqqqq", None)]
    rows += [(9005, "".join(stems) * 100, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    slots, hashes = 1 << 13, 2
    model = lang_filter.fit(docs, slots=slots, hashes=hashes)
    learned = [(t, lang) for i, t, lang in rows if lang is not None and zlib.crc32(str(i).encode()) % 3 != 1]
    languages, want = _plain_languages(learned, [t for _, t, _ in rows], slots, hashes)
    assert list(model.languages) == languages
    raw = np.frombuffer("".join(t for _, t, _ in rows).encode(), np.uint8)
    bounds = np.cumsum([0, *(len(t.encode()) for _, t, _ in rows)])
    found, _ = lang_filter.hits(raw, bounds, model, hashes)
    assert found.tolist() == [w[0] for w in want]
    # the query's own number of hashes: verdict and score
    model = lang_filter.fit(docs, slots=slots)
    _, want = _plain_languages(learned, [t for _, t, _ in rows], slots, lang_filter.HASHES)
    got = sorted((x.doc_id, x.lang_pred, round(x.score, 9)) for x in lang_filter.predict(docs, model).collect())
    assert got == sorted((i, w[1], round(w[2], 9)) for (i, _, _), w in zip(rows, want, strict=True))


def test_a_thousand_languages(spark):
    """1,000 values of lang on 10,000 documents: fitted and predicted within a minute, each found."""
    import time

    from pyspark.sql import functions as F

    number = (F.col("id") % 1000).cast("string")
    word = lambda salt: F.translate(F.substring(F.sha2(F.concat(number, F.lit(salt)), 256), 1, 12), "0123456789", "ghijklmnop")
    docs = spark.range(10_000).select(
        F.col("id").alias("doc_id"),
        F.concat_ws(" ", *(word(str(i)) for i in range(20))).alias("text"),
        F.concat(F.lit("l"), number).alias("lang"),
    )
    began = time.monotonic()
    model = lang_filter.fit(docs)
    got = lang_filter.predict(docs, model).join(docs, "doc_id")
    assert len(model.languages) == 1000
    assert got.where("lang_pred = lang").count() == 10_000
    assert time.monotonic() - began < 60


def _signature(text, bins=fingerprint.BINS):
    """One text's bins by plain loops over the same hashes."""
    from playlake.llm import _kernel as k

    raw, bounds = k.text_bytes(pa.array([text], pa.large_string()))
    h, _ = k.shingles(*[k.words(raw, bounds)[i] for i in (0, 3)])
    values = {}
    for x in h.tolist():
        at = x >> (64 - 9)
        values[at] = min(values.get(at, 1 << 64), x & ((1 << 55) - 1))
    if not values:
        return ""
    order, _ = fingerprint._orders()
    out = []
    for i in range(bins):
        v = values[i] if i in values else next(values[int(j)] for j in order[:, i] if int(j) in values)
        out.append("0123456789abcdef"[int(k.mix(np.array([v], np.uint64))[0]) & 15])
    return "".join(out)


def test_fingerprints_are_the_definition():
    texts = [t for _, t in mixed_corpus(7)][:25] + [" ".join(str(i) for i in range(4000)), "one", None]
    got = fingerprint.fingerprints(pa.array(texts, pa.large_string()))
    assert got == [_signature(t or "") for t in texts]


def test_likeness_estimates_similarity():
    r = random.Random(9)
    base = [str(r.random()) for _ in range(600)]
    errors = []
    for part in (0, 30, 120, 300, 450, 600):
        other = [str(r.random()) for _ in range(part)] + base[part:]
        a, b = shingle_set(" ".join(base)), shingle_set(" ".join(other))
        fa, fb = fingerprint.fingerprints(pa.array([" ".join(base), " ".join(other)], pa.large_string()))
        errors.append(abs(fingerprint.likeness(fa, fb) - len(a & b) / len(a | b)))
    assert max(errors) < 0.1
    assert fingerprint.likeness("", "") == 1.0 and fingerprint.likeness("", fa) == 0.0


@pytest.mark.parametrize("group_bytes", [2000, 1 << 22])
def test_compare_with_next(make_docs, group_bytes):
    rows = [(i, t) for i, t in mixed_corpus(8)]
    got = fingerprint.compare_with_next(make_docs(rows), group_bytes=group_bytes).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for at, (i, t) in enumerate(order):
        t, following = t or "", order[(at + 1) % len(order)][1] or ""
        part = len(t) // 3
        changed = t[: len(t) - part] + following[:part]
        a, b, c = fingerprint.fingerprints(pa.array([t, changed, following], pa.large_string()))
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), a, b, fingerprint.likeness(a, b), fingerprint.likeness(a, c)))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert fingerprint.compare_with_next(make_docs(rows).limit(0)).collect() == []


def test_words_of_the_kernel():
    from playlake.llm import _kernel as k

    texts = [t for _, t in mixed_corpus(9)]
    raw, bounds = k.text_bytes(pa.array(texts, pa.string()))
    hashes, starts, ends, of_text = k.words(raw, bounds)
    seen = {}
    for i, t in enumerate(texts):
        mine = [bytes(raw[s:e]).decode() for s, e in zip(starts[of_text[i] : of_text[i + 1]], ends[of_text[i] : of_text[i + 1]])]
        assert mine == words(t)
        for w, h in zip(mine, hashes[of_text[i] : of_text[i + 1]].tolist()):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
