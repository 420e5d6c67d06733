"""The pipeline stage by stage, against what each stage is to do with its own input."""

import sys
from pathlib import Path

import numpy as np
import pytest
from _brute import near_dup_classes, words

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from playlake.llm import mixing, pii_boost, quality_llr  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark, tmp_path_factory):
    """Every stage's output as rows, written and read as run() does."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out, frames = [docs.collect()], []
    for at, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("pipeline") / str(at))
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        frames.append(docs)
        out.append(docs.collect())
    return out, frames


def test_stages(results):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "near duplicates", "personal data", "mixing", "packing"]
    _, frames = results
    assert all(f.columns == ["doc_id", "text", "lang", "source", "n_chars"] for f in frames[:-1])


def test_quality_keeps_what_the_model_keeps(spark, results):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = quality_llr.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = {r.doc_id for r in quality_llr.assess(docs, model).where("kept").collect()}
    assert {r.doc_id for r in results[0][1]} == kept and 0 < len(kept) < len(results[0][0])


def test_one_of_each_near_duplicate_group_stays(results):
    before, after = results[0][1], results[0][2]
    classes = near_dup_classes([(r.doc_id, r.text) for r in before], corpus_pipeline.NEAR_PERCENT)
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in classes})
    assert len(after) < len(before)


def test_personal_data_is_replaced(spark, results):
    before, after = ({r.doc_id: r for r in rows} for rows in results[0][2:4])
    assert before.keys() == after.keys()
    left = [r for r in pii_boost.scan(results[1][2], pii_boost.Model()).collect() if r.base]
    assert left == []
    assert any("<EMAIL>" in r.text for r in after.values())
    assert all(after[i].lang == before[i].lang and after[i].n_chars == before[i].n_chars for i in before)


def test_mix_takes_documents_as_often_as_planned(spark, results):
    frame = results[1][2]
    plan = mixing.mix(frame, mixing.quality_weights(spark.read.parquet(f"{SF}/labels.parquet")))
    want = sorted(i for r in plan.collect() for i in [r.doc_id] * r.copies)
    assert sorted(r.doc_id for r in results[0][4]) == want
    texts = {r.doc_id: r.text for r in results[0][3]}
    assert all(r.text == texts[r.doc_id] for r in results[0][4])
    assert sum(len(words(r.text)) for r in results[0][4]) > 0


def test_packing_holds_every_token(results):
    from playlake.llm.packing import Encoder

    encode = Encoder()
    want = sorted(encode(r.text).tolist() for r in results[0][4])
    pieces = results[0][5]
    assert sum(r.length for r in pieces) == sum(map(len, want))
    assert sorted({r.doc_id for r in pieces}) == sorted({r.doc_id for r in results[0][4]})
    fill = {}
    for r in pieces:
        fill[r.sequence_id] = fill.get(r.sequence_id, 0) + r.length
        assert len(bytes(r.ids)) == 4 * r.length
    assert all(n == 2048 or n & (n - 1) == 0 for n in fill.values())
    assert np.array([*fill.values()]).sum() == sum(map(len, want))


def test_run_gives_the_last_stage(spark, results):
    columns = ["doc_id", "start", "length", "doc_tokens"]
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).select(*columns).collect()))
    assert sum(r[2] for r in got) == sum(r.length for r in results[0][5])
    assert {r[0] for r in got} == {r.doc_id for r in results[0][5]}
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_with_nulls_ties_and_clashing_columns(spark, make_docs):
    good = " ".join(f"wort{i % 61}{i}" for i in range(90))
    rows = [(1, good), (2, good + " more"), (None, good), (3, None), (4, ""), (5, "x@y.zz " + good[::-1]), (5, "x@y.zz " + good[::-1]), (6, " \n")]
    docs = make_docs(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF).collect() == [], name
        out.collect()
    kept = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "4", "5", "6"]
    redacted = {r.doc_id: r.text for r in corpus_pipeline.personal_data(spark, docs, SF).collect()}
    assert redacted[5].startswith("<EMAIL> ") and redacted[3] is None
    packed = corpus_pipeline.pack(spark, docs, SF).collect()
    assert sorted(str(r.doc_id) for r in packed if r.start == 0) == sorted(str(i) for i, _ in rows)
    assert corpus_pipeline.pack(spark, docs.limit(0), SF).collect() == []
