"""Language identification: language-bitmask n-gram filters.

A text is its bytes, letters in lower case and all other ASCII characters as
spaces; its n-grams are runs of 3 and of 4 bytes. One Bloom filter holds the
n-grams of all languages at once, bit-sliced: each slot has one bit per language,
in words of up to 64 (a row of ``slots`` per 64 languages), and the AND of an n-gram's slots has the bits of all languages that
contain it. A text's hits are counted per language and corrected for the false
positives that the language's share of set bits gives; the language with the
largest corrected share of n-grams is the prediction.

The filter is fitted on a bounded sample (``PER_LANGUAGE`` documents of each
language, chosen by a hash of the id): an n-gram is entered for a language if it
makes up ``MIN_SHARE`` of the language's n-grams (so at most 1/MIN_SHARE per
language and order are) and is not ``RATIO`` times commoner elsewhere. Prediction
runs over every whole text, in the scan's own tasks, without a shuffle.

Languages are rows while fitting (language, n-gram, count) and become bits only in
the last aggregate, so their number is free. The model, which is held by the driver
and broadcast, has 8 MB per 64 languages whatever the size of the corpus.

Defined results
  * null text, empty text or one without a letter: ``und``, score 0; no n-gram
    known: the language with most sample n-grams, score 0; ties: the first
    language by name; null ``doc_id``: not learned from, predicted like any row;
  * nothing to learn from: every prediction is ``und``;
  * repeated rows: equal results; empty table: no rows;
  * extra columns, whatever their names, are not read; neither are lang and
    source when predicting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm import _kernel as k
from playlake.llm._ship import ship

ORDERS = (3, 4)
#: Slots of the filter and hash functions.
SLOTS, HASHES = 1 << 20, 3
PER_LANGUAGE = 3_000
MIN_SHARE = 2e-5
RATIO = 12.0
#: Up to this many languages are counted one by one, more by the bits that are set.
FEW = 16
#: Languages (rows of a few dozen bytes) up to which their table is broadcast.
BROADCAST_LANGUAGES = 100_000
#: Text bytes of one pass; texts times languages whose counts are held at once.
_PASS, _CELLS = 256 << 10, 2_000_000

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = [c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 else 32 for c in range(128)]
_MULTIPLIERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Model:
    """Languages by name, the filter's slots, and each language's false-positive rate."""

    languages: tuple[str, ...]
    slots: np.ndarray
    false_positive: np.ndarray
    default: int = 0


def _codes(folded: np.ndarray, order: int) -> np.ndarray:
    """Every run of ``order`` bytes as one number; the order is part of it."""
    n = len(folded) - order + 1
    code = np.full(max(n, 0), order, np.uint64)
    for i in range(order):
        code = (code << np.uint64(8)) | folded[i : i + n]
    return code


def _places(code: np.ndarray, slots: int, hashes: int) -> Iterator[np.ndarray]:
    shift = np.uint64(64 - (slots.bit_length() - 1))
    for m in _MULTIPLIERS[:hashes]:
        yield ((code * m) >> shift).astype(np.int64)


def held_out(doc_id: Column) -> Column:
    """Documents that are not learned from: crc32 of the id's text leaves 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    slots: int = SLOTS,
    hashes: int = HASHES,
) -> Model:
    """Fit the filter on a bounded sample of the labelled documents that are not held out."""
    spark = docs.sparkSession
    ship(spark)
    known = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")).where(
        F.col("_id").isNotNull() & F.col("_lang").isNotNull() & F.col("_text").isNotNull() & ~held_out(F.col("_id"))
    )
    count = {r["_lang"]: r["n"] for r in known.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = tuple(sorted(count))
    if not languages:
        return Model((), np.zeros((1, slots), np.uint8), np.zeros(0))

    def numbered(values: list, schema: str) -> DataFrame:
        """One row per language; without the hint where a column of many values would make it large."""
        rows = spark.createDataFrame(values, schema)
        return F.broadcast(rows) if len(values) <= BROADCAST_LANGUAGES else rows

    numbers = numbered(
        [(name, i, min(1.0, per_language / count[name])) for i, name in enumerate(languages)],
        "_lang string, language int, share double",
    )
    drawn = F.pmod(F.xxhash64(F.lit("lang"), "_id"), F.lit(1_000_000)) < F.col("share") * 1_000_000
    sample = known.join(numbers, "_lang").where(drawn).select("language", F.col("_text").alias("text"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.asarray(batch.column("language"))
            raw, bounds = k.text_bytes(batch.column("text"))
            for language in np.unique(of):
                parts = []
                for i in np.flatnonzero(of == language):
                    folded = _FOLD[raw[bounds[i] : bounds[i + 1]]]
                    parts += [_codes(folded, order) for order in ORDERS]
                codes, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.record_batch(
                    [pa.array(np.full(len(codes), language, np.int32)), pa.array(codes.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["language", "code", "n"],
                )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.asarray(batch.column("code")).view(np.uint64)
            for at in _places(codes, slots, hashes):
                yield pa.record_batch([batch.column("word"), pa.array(at), batch.column("mask")], names=["word", "slot", "mask"])

    # One row per language and n-gram; languages stay rows until they are bits.
    tallies = sample.mapInArrow(tally, "language int, code long, n long").groupBy("language", "code").agg(F.sum("n").alias("n")).persist()
    try:
        total = np.ones(len(languages))
        for r in tallies.groupBy("language").agg(F.sum("n").alias("n")).collect():
            total[r["language"]] = max(r["n"], 1)
        totals = numbered([(i, float(n)) for i, n in enumerate(total)], "language int, total double")
        rates = tallies.join(totals, "language").select("language", "code", (F.col("n") / F.col("total")).alias("rate"))
        rates = rates.withColumn("most", F.max("rate").over(Window.partitionBy("code")))
        entered = (
            rates.where((F.col("rate") >= MIN_SHARE) & (F.col("rate") * RATIO >= F.col("most")))
            .groupBy("code", F.floor(F.col("language") / 64).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, language % 64)")).alias("mask"))
        )
        # The filter's own words, so at most ``slots`` rows per 64 languages.
        filled = entered.mapInArrow(place, "word int, slot long, mask long").groupBy("word", "slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    finally:
        tallies.unpersist()
    kind = next(t for t, bits in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if min(len(languages), 64) <= bits)
    table = np.zeros((-(-len(languages) // 64), slots), kind)
    table[filled["word"].to_numpy(), filled["slot"].to_numpy()] = filled["mask"].to_numpy().view(np.uint64).astype(kind)
    fill = np.array([np.count_nonzero(table[i // 64] & kind(1 << i % 64)) / slots for i in range(len(languages))])
    return Model(languages, table, fill**hashes, int(np.argmax(total)))


def hits(raw: np.ndarray, bounds: np.ndarray, model: Model, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of each text found per language, and its n-grams."""
    texts, found = len(bounds) - 1, np.zeros((len(bounds) - 1, len(model.languages)), np.int64)
    total = np.zeros(texts, np.int64)
    for a, b in k.slices(bounds, _PASS):
        at = bounds[a : b + 1] - bounds[a]
        folded = _FOLD[raw[bounds[a] : bounds[b]]]
        for order in ORDERS:
            code = _codes(folded, order)
            if not len(code):
                continue
            places = list(_places(code, model.slots.shape[1], hashes))
            # no n-gram reaches into the next text
            last = np.maximum(at[1:] - order + 1, at[:-1])
            total[a:b] += last - at[:-1]
            of_text = None
            for w, words in enumerate(model.slots):
                word = np.bitwise_and.reduce([words[place] for place in places])
                own = range(64 * w, min(64 * w + 64, len(model.languages)))
                if len(model.languages) <= FEW:
                    for i in own:
                        sums = np.zeros(len(code) + 1, np.int64)
                        np.cumsum((word >> word.dtype.type(i % 64)) & word.dtype.type(1), out=sums[1:], dtype=np.int64)
                        found[a:b, i] += sums[np.minimum(last, len(code))] - sums[np.minimum(at[:-1], len(code))]
                    continue
                # many languages: an n-gram is in few of them, so work per set bit
                if of_text is None:
                    of_text = np.repeat(np.arange(b - a), np.diff(at))[: len(code)]
                    inside = np.arange(len(code)) < last[of_text]
                some = np.flatnonzero((word != 0) & inside)
                bits = np.unpackbits(word[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                row, bit = np.nonzero(bits)
                pairs = np.bincount(of_text[some[row]] * 64 + bit, minlength=(b - a) * 64).reshape(b - a, 64)
                found[a:b, own.start : own.stop] += pairs[:, : len(own)]
    return found, total


def predict(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the winner's part of the corrected shares)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # SLOTS words of up to 8 bytes per 64 languages
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        held_out(F.col(id_col)).alias("held_out"),
        F.coalesce(F.regexp_like(F.col(text_col), F.lit(r"\p{L}")), F.lit(False)).alias("letter"),
        F.col(text_col).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, "und"], object)
        for batch in batches:
            raw, bounds = k.text_bytes(batch.column("text"))
            letter = np.asarray(batch.column("letter").cast(pa.uint8())).astype(bool)
            n = batch.num_rows
            best, score = np.full(n, len(m.languages)), np.zeros(n)
            step = max(1, _CELLS // max(1, len(m.languages)))
            for a in range(0, n if m.languages else 0, step):
                own = slice(a, min(a + step, n))
                low = bounds[a]
                found, total = hits(raw[low : bounds[own.stop]], bounds[a : own.stop + 1] - low, m)
                part = found / np.maximum(total, 1)[:, None]
                part = np.clip((part - m.false_positive) / np.maximum(1 - m.false_positive, 1e-9), 0.0, 1.0)
                all_ = part.sum(axis=1)
                first = np.where(all_ > 0, np.argmax(part, axis=1), m.default)
                best[own] = np.where(letter[own], first, len(m.languages))
                score[own] = np.where(letter[own] & (all_ > 0), part.max(axis=1) / np.maximum(all_, 1e-12), 0.0)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names[best].tolist(), pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
