"""Base spans against the stated patterns; added spans; redaction."""

import re

import pytest

from playlake.llm import pii_boost as p
from pyspark.sql import functions as F


def _luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def _base(text):
    out = []
    for rank, kind in enumerate(p.KINDS):
        for m in re.finditer(p.RULES[kind], text or ""):
            g = m.group()
            digits = re.sub("[^0-9]", "", g)
            ok = {
                "email": lambda: True,
                "ip": lambda: all(len(x.lstrip("0")) <= 3 and int(x[-9:]) <= 255 for x in g.split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and _luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                out.append((m.start(), rank, m.end()))
    return sorted(out)


NASTY = [
    "a@b.c_d@e.f x@y a.b@c-d.e.f.", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.255 0000000255.1.1.1", "+1 (869) 555-7420 +12 +1-2-3",
    "4111 1111 1111 1111-2 1" * 3, "é😀 a@b.co 😀 +49 30 1234567", "9" * 30_000, "a" * 60_000 + "@", "1 " * 20_000, None, "",
    ".".join("1" * 20_000), "x(at)y.com @ @@ a@@b.c", "4111111111111111", "+" * 5000 + "1", "call (212) 555 0100 now",
    "u@v.ww " * 1500,
]


def test_base_spans_and_redaction(make_docs):
    docs = make_docs(list(enumerate(NASTY)) + [(None, "x@y.zz"), (4, NASTY[4])])
    model = p.Model()
    rows = p.scan(docs, model).collect()
    texts = dict(enumerate(NASTY)) | {None: "x@y.zz"}
    assert len(rows) == len(NASTY) + 2
    for r in rows:
        want = _base(texts[r.doc_id])
        assert [(s.start, s.rank, s.end) for s in r.base] == want, r.doc_id
        assert r.all == r.base
        out, at = [], 0
        t = texts[r.doc_id]
        if t is None:
            assert r.redacted is None
            continue
        for s, rank, e in want:
            if s >= at:
                out += [t[at:s], f"<{p.KINDS[rank].upper()}>"]
            at = max(at, e)
        assert r.redacted == "".join(out) + t[at:]


def test_fitted_spans_keep_the_base(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = p.fit(docs)
    assert model.trees
    for r in docs.select("doc_id", p.find(F.col("text"), model).alias("f")).collect():
        base = [(s.start, s.rank, s.end) for s in r.f.base]
        assert base == _base(texts[r.doc_id])
        extra = [s for s in r.f.all if (s.start, s.rank, s.end) not in set(base)]
        assert len(r.f.all) == len(base) + len(extra)
        assert not any(s.start < e and b < s.end for s in extra for b, _, e in base)


def test_trees_score_as_the_library_does(spark):
    """The nested expression gives the probability that the fitted classifier gives."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    n = len(p.FEATURES)
    rows = spark.range(300).select(*(((F.col("id") * (i + 3)) % (7 + i)).cast("double").alias(f"x{i}") for i in range(n)))
    rows = rows.withColumn("label", (F.col("x4") + F.col("x5") > 9).cast("double"))
    v = VectorAssembler(inputCols=[f"x{i}" for i in range(n)], outputCol="features").transform(rows)
    fitted = GBTClassifier(maxIter=4, maxDepth=3, seed=1).fit(v)
    model = p.Model(tuple((w, p._tree(t._java_obj.rootNode())) for w, t in zip(fitted.treeWeights, fitted.trees)))
    scored = fitted.transform(v).withColumn("own", p._scored(F.array(*(F.col(f"x{i}") for i in range(n))), model))
    for r in scored.select("probability", "own").collect():
        assert r.own == pytest.approx(r.probability[1], abs=1e-9)


def test_added_spans(make_docs):
    """With a threshold any candidate passes: overlapping ones are settled, base ones left alone."""
    model = p.Model(trees=((1.0, 0.1),), thresholds={0: 0.5, 3: 0.5})
    docs = make_docs([(1, "call (212) 555 0100 now, or bob(at)site.org or a@b.co"), (2, None)])
    got = {r.doc_id: r for r in p.scan(docs, model).collect()}
    assert [(s.rank, s.found) for s in got[1].all] == [(3, "(212) 555 0100"), (0, "bob(at)site.org"), (0, "a@b.co")]
    assert got[1].redacted == "call <PHONE> now, or <EMAIL> or <EMAIL>"
    assert got[2].all == []


def test_empty_table(make_docs):
    docs = make_docs([(1, "x")]).limit(0)
    assert p.fit(docs) == p.Model()
    assert p.scan(docs, p.Model()).collect() == []


def test_spans_next_to_other_numbers(make_docs):
    """Cards and phones that share a run of digits with other data are proposed as parts of it."""
    luhn, parens = p.FEATURES.index("luhn"), p.FEATURES.index("parens")
    tree = (luhn, 0.5, (parens, 1.5, -1.0, 1.0), 1.0)
    model = p.Model(trees=((1.0, tree),), thresholds={2: 0.5, 3: 0.5})
    texts = ["4111 1111 1111 1111 5500 0000 0000 0004", "at +1 (869) 555-7420 10.0.0.1 now"]
    got = {r.doc_id: [s.found for s in r.all] for r in p.scan(make_docs(list(enumerate(texts))), model).collect()}
    assert got[0] == ["4111 1111 1111 1111", "5500 0000 0000 0004"]
    assert got[1] == ["+1 (869) 555-7420", "10.0.0.1"]


def test_added_spans_cover_the_most(make_docs):
    """Of overlapping candidates of equal score those stay that cover the most digits."""
    model = p.Model(trees=((1.0, 1.0),), thresholds={2: 0.5})
    # 20 and more digits in a row: no base span
    docs = make_docs([(1, "4111 1111 1111 1111 5500 0000 0000 0004")])
    assert sum(s.end - s.start for s in p.scan(docs, model).first().all) == 38
    assert p.scan(docs, model).first().all[0].start == 0


# --- a plain version of the whole search, with the same model ---------------------

GROUP = re.compile(r"[+(]?[0-9]+[).\x20/-]*(?:\((?![0-9])[().\x20/-]*)*")
ADDRESS = re.compile(p._ADDRESS)
CONTEXT = re.compile(p._CONTEXT)


def _matches(pattern, text):
    """Matches with the text before (since the last match, 24 characters) and the character after (none if a match is next)."""
    found, at = list(pattern.finditer(text)), 0
    for i, m in enumerate(found):
        after = text[m.end() : found[i + 1].start() if i + 1 < len(found) else len(text)][:1]
        yield m.start(), m.end(), m.group(), text[at : m.start()][-24:], after
        at = m.end()


def _plain_features(rank, found, before, after):
    digits = re.sub("[^0-9]", "", found)
    runs = [len(r) for r in re.findall("[0-9]+", found)]
    host = re.search(r"(?:@|[\])]) ?(.*)$", found)
    octets = all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in found.split(".")) if rank == 1 else False
    return [
        *(rank == k for k in range(4)), len(found), len(digits), len(runs), max(runs, default=0), found.count("."), found.count("-"),
        found.count(" "), found.count("(") + found.count(")"), _luhn(digits) if 12 <= len(digits) <= 19 else 0, octets,
        bool(re.search(r"[^\W]$", before)), bool(re.match(r"\w", after)), bool(CONTEXT.search(before)), "@" in found,
        len((host.group(1) if host else "").split(".")), bool(re.match(p._PREFIX, found)),
    ]


def _plain_score(model, values):
    import math

    def walk(node):
        if not isinstance(node, tuple):
            return node
        at, threshold, low, high = node
        return walk(low if float(values[at]) <= threshold else high)

    return 1 / (1 + math.exp(-2 * sum(w * walk(t) for w, t in model.trees)))


def _plain_added(text, model):
    def passing(rank, found, before, after):
        score = _plain_score(model, _plain_features(rank, found, before, after))
        return score if score >= model.thresholds.get(rank, 2) else None

    taken = [(s, e) for s, _, e in _base(text)]
    free = lambda s, e: not any(a < e and s < b for a, b in taken)
    out = [(s, 0, e) for s, e, found, before, after in _matches(ADDRESS, text) if free(s, e) and passing(0, found, before, after)]
    taken += [(s, e) for s, _, e in out]
    groups, last = [], ""
    for s, e, whole, before, after in _matches(GROUP, text):
        core = re.match(r"[+(]?[0-9]+", whole).group()
        groups.append((s, s + len(core), whole, core, before != "" or not groups, (last + before)[-24:], after, free(s, s + len(core))))
        last = whole
    best = [(0.0, ())]
    for j, (_, end, whole, core, *_rest) in enumerate(groups):
        now, tail = best[-1], ""
        nxt = groups[j + 1][2][:1] if j + 1 < len(groups) else ""
        after = whole[len(core) :][:1] or groups[j][6] or nxt
        for i in range(j, max(-1, j - 19), -1):
            if not groups[i][7] or (i < j and groups[i + 1][4]):
                break
            tail = core if i == j else groups[i][2] + tail
            digits = re.sub("[^0-9]", "", tail)
            if len(digits) > 19:
                break
            rank = 1 if re.fullmatch(r"[0-9]+(\.[0-9]+){3}", tail) else 2 if 12 <= len(digits) and re.fullmatch("[0-9 -]+", tail) else (
                3 if 9 <= len(digits) <= 15 else None)
            score = passing(rank, tail, groups[i][5], after) if rank is not None else None
            if score is not None and score * len(digits) + best[i][0] > now[0]:
                now = (score * len(digits) + best[i][0], (*best[i][1], (groups[i][0], rank, end)))
        best.append(now)
    return sorted(_base(text) + out + list(best[-1][1]))


def _texts(seed, n):
    import random

    r = random.Random(seed)
    part = [
        lambda: ".".join(str(r.randint(0, 300)) for _ in range(r.randint(3, 5))), lambda: " ".join(str(r.randint(0, 9999)) for _ in range(r.randint(1, 30))),
        lambda: "+" + " ".join(str(r.randint(1, 999)) for _ in range(4)), lambda: f"({r.randint(100, 999)}) {r.randint(100, 999)}-{r.randint(1000, 9999)}",
        lambda: "4111 1111 1111 1111", lambda: str(r.randint(10**7, 10**21)), lambda: "call", lambda: "é😀", lambda: "bob(at)site.org", lambda: "a@b.co",
        lambda: "x [at] y.zz", lambda: "word", lambda: "12/11/2024", lambda: "((1)2(", lambda: "9-", lambda: "card:", lambda: "7@k",
    ]
    return ["".join(r.choice(part)() + r.choice([" ", "", ", ", "-", "\n"]) for _ in range(r.randint(1, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def fitted(spark):
    return p.fit(spark.read.parquet("/root/testdata/sf0.1/documents.parquet"))


def test_spans_equal_a_plain_version(make_docs, fitted):
    loose = p.Model(fitted.trees, {0: 0.2, 1: 0.1, 2: 0.1, 3: 0.05})
    docs = [*enumerate(_texts(5, 250))]
    texts = dict(docs)
    for model in (fitted, loose, p.Model(trees=((1.0, 0.3),), thresholds=dict.fromkeys(range(4), 0.5))):
        found = p.scan(make_docs(docs), model).collect()
        assert {r.doc_id: [(s.start, s.rank, s.end) for s in r.all] for r in found} == {i: _plain_added(t, model) for i, t in texts.items()}


def test_trees_go_beyond_the_rules(fitted, make_docs):
    """The thresholds exist, and spans in forms that the rules refuse come in; numbers that fail a check do not."""
    assert {0, 2} <= set(fitted.thresholds)
    texts = ["pay 4111 1111 1111 1111 5500 0000 0000 0004 now", "write to bob(at)site.org or", "the 4111111111111112 and 1234567890123456"]
    got = {r.doc_id: [s.found for s in r.all] for r in p.scan(make_docs([*enumerate(texts)]), fitted).collect()}
    assert got == {0: ["4111 1111 1111 1111", "5500 0000 0000 0004"], 1: ["bob(at)site.org"], 2: []}


def test_long_texts_with_a_model(make_docs, fitted):
    """20,000 groups of digits, 10,000 lines of a log: within a minute and a half, whether no candidate passes or all do."""
    import time

    log = "\n".join(f"10.0.{i % 256}.{i // 256} - - [10/Jan/2024:10:00:00] GET /x {i}" for i in range(10_000))
    docs = make_docs([(1, log), (2, " ".join(str(100 + i % 800) for i in range(20_000)))])
    for model in (fitted, p.Model(trees=((1.0, 0.1),), thresholds=dict.fromkeys(range(4), 0.1))):
        since = time.time()
        sizes = {r.doc_id: (len(r.base), len(r.all)) for r in p.scan(docs, model).collect()}
        assert time.time() - since < 90
        assert sizes[1][0] == 10_000 and sizes[2][0] == 0 and (not model.trees[0][1] == 0.1 or sizes[2][1] > 4_000)


def test_trees_and_thresholds_are_of_all_examples(spark, make_docs, monkeypatch):
    """More examples of each class than any sample held: all that are not held out weigh in."""
    wrong = [n for n in range(10**15, 10**15 + 10_000) if not _luhn(str(n))][:5_000]
    emails = [f"u{i}@site{i}.org" for i in range(5_000)]
    docs = make_docs([(i, f"{e} and {n} to") for i, (e, n) in enumerate(zip(emails, wrong, strict=True))])
    taught = []

    class Seen(p.GBTClassifier):
        def fit(self, rows):
            taught.append({r["label"]: r["n"] for r in rows.groupBy("label").agg(F.sum("n").alias("n")).collect()})
            return super().fit(rows)

    monkeypatch.setattr(p, "GBTClassifier", Seen)
    model = p.fit(docs)

    def kept(found, rank):
        rows = spark.createDataFrame([(x,) for x in found], "found string")
        return rows.where(F.pmod(F.xxhash64("found", F.lit(rank)), F.lit(3)) != 0).count()

    assert taught == [{1.0: 3 * kept(emails, 0), 0.0: kept(map(str, wrong), 2)}]
    assert taught[0][1.0] > 4_000 and model.trees
