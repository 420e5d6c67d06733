"""Mixing and chat against their SQL and a plain version."""

import math
import os

import duckdb
import pandas as pd
import pytest
from _brute import words

from playlake.llm import chat, mixing

SF = "/root/testdata/sf0.01"


def _sql(sql, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        con.register(name, rows)
    return con.sql(sql).df()


def _rows(df, columns):
    def clean(x):
        if pd.isna(x):
            return None
        return x if isinstance(x, str) else round(float(x), 6)

    return sorted((tuple(clean(x) for x in r) for r in df[columns].itertuples(index=False)), key=str)


def _plain_targets(sizes, cap=3):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def _mix_rows():
    rows = []
    for i in range(300):
        source = ["a", "b", None, "hot", "hot", "hot", "tiny"][i % 7] if i % 50 else "solo"
        rows.append((i, " ".join(["w"] * (i % 13)) if i % 11 else None, "en", source, 0))
    return rows + [(None, "x y z", "en", "a", 0), (3, "w w w", "en", "hot", 0), (3, "w w w", "en", "hot", 0)]


def test_mix(spark):
    docs = spark.createDataFrame(_mix_rows(), "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 as size", "2 as key", "3 as weight").repartition(3)
    weights = spark.createDataFrame([(1, 2.0), (2, None), (3, -1.0), (4, 0.5), (4, 0.5)], "doc_id long, weight double")
    got = mixing.mix(docs, weights, keep=("source",), ranges=8).toPandas()
    again = mixing.mix(docs.repartition(5), weights, keep=("source",), ranges=4096).toPandas()
    columns = ["doc_id", "size", "source_size", "target", "copies", "taken"]
    assert _rows(got, columns) == _rows(again, columns)  # neither partitions nor ranges matter
    sizes = {}
    for _, text, _, source, _ in _mix_rows():
        sizes[source] = sizes.get(source, 0) + len(words(text))
    want = _plain_targets(sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for source, part in got.groupby("source", dropna=False):
        source = None if source is None or source != source else source
        assert part.target.iloc[0] == pytest.approx(want[source])
        assert abs(part.taken.sum() - want[source]) <= 13
        assert (part.taken <= 3 * part["size"]).all()
        # whole epochs come first: no document is two copies apart from another
        assert part.copies.max() - part.copies.min() <= 1


def test_heavier_documents_are_taken_first(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'w w' as text", "if(id % 4 = 0, 'a', 'b') as source")
    weights = docs.selectExpr("doc_id", "if(doc_id % 8 < 4, 4.0, 1.0) as weight")
    got = mixing.mix(docs, weights, keep=("source",)).where("source = 'b'").toPandas()
    rest = got.target.iloc[0] / got.source_size.iloc[0] - got.copies.min()
    heavy = got[got.doc_id % 8 < 4].copies.mean() - got.copies.min()
    light = got[got.doc_id % 8 >= 4].copies.mean() - got.copies.min()
    # exponential keys: a share f of a class with rate r is in below key x if f = 1 - exp(-r x)
    lo, hi = 0.0, 50.0
    for _ in range(60):
        x = (lo + hi) / 2
        if (2 - math.exp(-4 * x) - math.exp(-x)) / 2 < rest:
            lo = x
        else:
            hi = x
    assert heavy == pytest.approx(1 - math.exp(-4 * x), abs=0.05)
    assert light == pytest.approx(1 - math.exp(-x), abs=0.05)


def test_mix_without_words(spark):
    schema = "doc_id long, text string, source string"
    got = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)).collect()
    assert [(r.taken, r.target) for r in got] == [(0, 0.0), (0, 0.0)]
    assert mixing.mix(spark.createDataFrame([], schema)).collect() == []


TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|> there"), (1, 2, "bob", None), (1, 2, "bob", "x"), (1, 2, "bob", "x"),
    (1, 300, "cy", "é😀"), (1, None, None, "late"), (2, 0, "system", "alone"), (3, 5, "ann", "only"), (None, 1, "ann", "n"),
    (None, 2, "bob", ""),
]


@pytest.mark.parametrize("block", [1, 256])
def test_rotation_equals_sql(spark, block):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as seq", "2 as block")
    got = chat.rotate(turns, block=block).toPandas()
    want = _sql(chat.SQL, conversations=turns.toPandas().astype({"conv_id": "Int64", "turn": "Int64"}))
    assert _rows(got, list(got.columns)) == _rows(want, list(got.columns))


def test_rotation_renders_each_perspective(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    got = chat.rotate(turns).where("conv_id = 1").toPandas().sort_values("seq")
    assert sorted(got.speaker.unique()) == ["ann", "bob", "cy", "unknown"]
    for speaker, part in got.groupby("speaker"):
        whole = "".join(part.rendered)
        assert part.start_char.tolist() == [0, *part.end_char.tolist()[:-1]] and part.end_char.iloc[-1] == len(whole)
        for r in part.itertuples():
            assert (r.role == "assistant") == r.train == (r.name is None and r.role != "system")
            content = whole[r.content_start : r.content_end]
            assert whole[r.content_end :].startswith("<|im_end|>\n") and "<|" not in content
            if r.train:
                assert whole[r.content_start : int(r.mask_end)] == content + "<|im_end|>"
        trained = [r.turn for r in part.itertuples() if r.train]
        assert len(trained) == sum((role or "unknown") == speaker for c, _, role, _ in TURNS if c == 1)
    assert chat.rotate(turns.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op3_byte_dedup", "op7_mix_sources", "op8_rotate_speakers", "op10_word_dedup"])
def test_queries_equal_their_sql(spark, name):
    from playlake.llm import queries

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in os.listdir(d):
        con.sql(f"create view {t.split('.')[0]} as select * from '{d}/{t}'")
    got = queries.queries()[name](spark, d).toPandas()
    want = con.sql(queries.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(got, sorted(got.columns)) == _rows(want, sorted(got.columns))
