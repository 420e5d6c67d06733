"""Quality rules: hashed n-gram log-likelihood ratio of target against raw text.

Words and word pairs are hashed into ``buckets`` classes. Two multinomials are
counted over them: the raw corpus (every document) and the trusted target (a
bounded sample of documents labelled good). A document's score is the mean, over
its words and word pairs, of log(p_target / p_raw); it passes if the score
reaches ``threshold``. Every document gets a verdict, and the same one on every
run. All work is DataFrame expressions; the only data that leaves the executors
are the two count vectors (``buckets`` numbers each).

Defined results
  * null or empty text, or white space only: no words, all counts 0, fails the
    base rules, not kept;
  * null ``doc_id``: judged like any other row (the text alone decides);
  * repeated rows: each gets its own, equal verdict;
  * empty documents: no rows; no trusted rows (or no labels): all weights 0, so
    every score is 0 and the base rules alone decide;
  * extra columns, whatever their names, are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlake.llm._columns import SPACES, WORD, constant_array, let

BUCKETS = 10_000
#: Most trusted documents that the target multinomial is counted over.
TARGET_SAMPLE = 20_000
#: Mean log ratio that a document must reach: on average its words may be 5 % rarer in the target than in the corpus.
THRESHOLD = -0.05
#: Fixed values of the base rules.
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Model:
    """Log ratio of each bucket, and the threshold on a document's mean."""

    log_ratio: tuple[float, ...]
    threshold: float = THRESHOLD


def words_of(text: Column) -> Column:
    """The words of a text; none if it is null."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _indices(n: Column) -> Column:
    """0 .. n-1 (empty for n < 1)."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _buckets_of(w: Column, buckets: int) -> Column:
    """Bucket of every word, and of every pair of neighbours."""
    low = F.transform(w, F.lower)
    return let(
        low,
        lambda v: F.concat(
            F.transform(v, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int")),
            F.transform(
                _indices(F.size(v) - 1),
                lambda i: F.pmod(F.xxhash64(F.get(v, i), F.get(v, i + 1)), F.lit(buckets)).cast("int"),
            ),
        ),
    )


def _counts(texts: DataFrame, text_col: str, buckets: int) -> DataFrame:
    """How often each bucket occurs; summed on the map side, ``buckets`` rows at most."""
    each = texts.select(F.explode(_buckets_of(words_of(F.col(text_col)), buckets)).alias("bucket"))
    return each.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def trusted_ids(labels: DataFrame, sample: int = TARGET_SAMPLE) -> DataFrame:
    """At most ``sample`` doc_ids labelled quality 1, chosen by hash: the same on every run."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    buckets: int = BUCKETS,
    sample: int = TARGET_SAMPLE,
    threshold: float = THRESHOLD,
    smoothing: float = 1.0,
) -> Model:
    """Count both multinomials and return the log ratios.

    Raw: every document. Target: the documents of at most ``sample`` labelled
    ids, so the id list that is broadcast has a fixed bound (8 bytes each).
    """
    ids = F.broadcast(trusted_ids(labels, sample).withColumnRenamed("doc_id", "_trusted_id"))
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    raw = _counts(text, "_text", buckets)
    target = _counts(text.join(ids, F.col("_id") == F.col("_trusted_id"), "left_semi"), "_text", buckets)
    both = raw.select("bucket", F.col("n").alias("raw_n"), F.lit(0).cast("long").alias("target_n")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("raw_n"), F.col("n").alias("target_n"))
    )
    raw_n, target_n = [0] * buckets, [0] * buckets
    for row in both.groupBy("bucket").agg(F.sum("raw_n").alias("r"), F.sum("target_n").alias("t")).collect():
        raw_n[row["bucket"]], target_n[row["bucket"]] = row["r"], row["t"]
    if not sum(target_n):
        return Model((0.0,) * buckets, threshold)
    import math

    raw_all = sum(raw_n) + smoothing * buckets
    target_all = sum(target_n) + smoothing * buckets
    return Model(
        tuple(
            math.log((t + smoothing) / target_all) - math.log((r + smoothing) / raw_all)
            for r, t in zip(raw_n, target_n, strict=True)
        ),
        threshold,
    )


def _repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    The windows' hashes are sorted once; equal neighbours are repeats. Windows
    that overlap share words, so a window adds at most the distance to the next.
    """
    windows = F.transform(
        _indices(F.size(w) - 2), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    )

    def covered(s: Column) -> Column:
        def start(e: Column, k: Column) -> Column:
            twin = (F.get(s, k - 1)["h"] == e["h"]) | (F.get(s, k + 1)["h"] == e["h"])
            # null | true is true, null | false is null: no neighbour, no twin
            return F.when(twin, e["i"])

        starts = F.sort_array(F.filter(F.transform(s, start), lambda x: x.isNotNull()))
        return let(
            starts,
            lambda p: F.aggregate(
                F.transform(p, lambda x, k: F.coalesce(F.least(F.lit(3), F.get(p, k + 1) - x), F.lit(3))),
                F.lit(0).cast("long"),
                lambda a, x: a + x,
            ),
        )

    def of_windows(h: Column) -> Column:
        tagged = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(tagged, covered))

    return let(windows, of_windows)


def _score(w: Column, model: Model) -> Column:
    weights = constant_array(list(model.log_ratio))
    hashed = _buckets_of(w, len(model.log_ratio))
    return let(
        hashed,
        lambda b: F.when(
            F.size(b) > 0,
            F.aggregate(b, F.lit(0.0), lambda a, x: a + F.get(weights, x)) / F.size(b),
        ).otherwise(F.lit(0.0)),
    )


def verdict(text: Column, model: Model) -> Column:
    """Struct of a text's base counts, score and verdict (see the module's text)."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)

    def judged(w: Column) -> Column:
        base = F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
            _repeated_words(w).alias("n_repeat_words"),
            _score(w, model).alias("score"),
        )

        def with_verdict(b: Column) -> Column:
            failed = (b["n_words"] < MIN_WORDS) | (100 * b["n_repeat_words"] > 50 * b["n_words"])
            return F.struct(
                *(b[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
                failed.alias("base_failed"),
                (~failed & (b["score"] >= model.threshold)).alias("kept"),
                b["score"].alias("score"),
            )

        return let(base, with_verdict)

    return let(words_of(text), judged)


def assess(docs: DataFrame, model: Model, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: its id, counts, score and verdict."""
    return docs.select(F.col(id_col).alias("doc_id"), verdict(F.col(text_col), model).alias("_v")).select("doc_id", "_v.*")


def keep_good(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that pass, with the columns they came with."""
    return docs.where(verdict(F.col(text_col), model)["kept"])
