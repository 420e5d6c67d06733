"""What the Python workers hold, during a task and after it."""

import numpy as np
import pyarrow as pa
import pytest
from playlake.llm import _ship, near_dup, packing

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def _documents(spark, rows=2000, words=1000):
    """One partition of about 12 MB: many times the bytes of a batch, fewer rows than Spark's limit."""
    return spark.range(0, rows, 1, 1).selectExpr("id as doc_id", f"repeat(concat('w', id, ' '), {words}) as text")


def _batches(docs):
    def run(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "size"])

    return docs.mapInArrow(run, "rows long, size long").collect()


@pytest.mark.parametrize("operator", [packing.pack, near_dup.classes])
def test_batches_are_bounded_in_bytes(spark, operator):
    spark.conf.unset(LIMIT)
    try:
        operator(_documents(spark, 20, 10))
        found = _batches(_documents(spark))
        assert sum(r.rows for r in found) == 2000
        assert max(r.size for r in found) < 1.2 * _ship.BATCH_BYTES
        spark.conf.set(LIMIT, "1m")
        operator(_documents(spark, 20, 10))
        assert spark.conf.get(LIMIT) == "1m"  # the user's own limit stays
    finally:
        spark.conf.unset(LIMIT)


def test_batches_do_not_change_the_packing(spark):
    docs = _documents(spark, 300, 400)

    def rows():
        return [tuple(r) for r in packing.pack(docs).collect()]

    try:
        spark.conf.set(LIMIT, "64k")
        many = rows()
        spark.conf.set(LIMIT, "1g")
        assert many == rows()
    finally:
        spark.conf.unset(LIMIT)


def test_reference_vocabulary_only_when_needed():
    encode = packing.Encoder()
    encode("plain words, and more of them")
    assert "reference" not in vars(encode)
    assert encode("日本語")[:-1].tolist() == encode.reference.encode("日本語", add_special_tokens=False).ids


def test_memory_goes_back_after_a_task(monkeypatch):
    calls = []
    monkeypatch.setattr(_ship, "give_back", lambda: calls.append(1))
    seen = list(_ship.lean(lambda batches: (b for b in batches))(iter([1, 2])))
    assert seen == [1, 2] and calls == [1]
    with pytest.raises(ZeroDivisionError):
        list(_ship.lean(lambda batches: (1 // b for b in batches))(iter([0])))
    assert calls == [1, 1]
    assert _ship.lean_group(lambda table: table)(3) == 3 and calls == [1, 1, 1]


def test_give_back_returns_freed_blocks():
    def resident():
        with open("/proc/self/status") as lines:
            return next(int(x.split()[1]) for x in lines if x.startswith("RssAnon"))

    low = resident()
    blocks = [np.ones(1000) for _ in range(20_000)]  # 160 MB in blocks too small to be mapped alone
    keep = blocks[::400]
    del blocks
    _ship.give_back()
    assert resident() - low < 60_000 and len(keep) == 50
