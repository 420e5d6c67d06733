"""Mixing sources to target weights: Efraimidis-Spirakis sampling.

Each source's target is its weight's share of all words, at most ``MOST_EPOCHS``
times its size (the excess goes to the others by weight). A source is first
taken whole, as often as its target allows; the rest of the target is drawn
without replacement: every document has the key -ln(u) / weight, with u from a
hash of its id and weight from its quality, and documents are taken by
increasing key until their words reach the rest.

The running sum by key is worked out in two levels: sums over key ranges, then, in
the one range where a source's target ends, document by document. So a source
with a third of all rows is never one task's work, and what decides about a
document is one row per source: where its draw ends.

Defined results
  * null or empty text: size 0, taken 0; null source: a source of its own, last;
  * null ``doc_id``: hashed as the empty string; equal keys are ordered by id and
    size, so equal rows are interchangeable and reruns agree;
  * a missing, null or non-positive quality weight counts as 1;
  * no words at all, or an empty table: all targets 0 (no rows);
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playlake.llm._columns import WORD
from playlake.session import shared_dir

#: Fixed values of the mix.
WEIGHT_CYCLE = 3
MOST_EPOCHS = 3
SEED = "mix-1"
#: Key ranges of the two-level running sum.
RANGES = 4096
#: Sources whose figures may be broadcast (about 100 bytes each); beyond, the join is a plain one.
BROADCAST_ROWS = 100_000
#: The same for documents with a weight of their own (16 bytes each).
BROADCAST_WEIGHTS = 1_000_000


def quality_weights(labels: DataFrame) -> DataFrame:
    """Sampling weight by document: 2 if labelled good, 1/2 if labelled bad."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("quality").alias("q"))
        .select("doc_id", F.when(F.col("q") == 1, 2.0).otherwise(0.5).alias("weight"))
    )


def _uniform(doc_id: Column, seed: str) -> Column:
    """A number in (0, 1], fixed by the id: 52 bits of its digest."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1.0) / float(2**52)


def targets(sizes: DataFrame, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Target of each source (``source``, ``source_size``) by weighted shares with a cap.

    Sources fill up together, each at its weight's rate; one that reaches its cap
    stops. In the order in which they would stop, a source is capped if by then
    the words handed out do not exceed all words. One row per source throughout.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("w", (F.row_number().over(by_name) - 1) % WEIGHT_CYCLE + 1).withColumn(
        "cap", most_epochs * F.col("source_size")
    )
    filling = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = filling.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    beyond = filling.rowsBetween(1, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = (
        ranked.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("cap_sum", F.sum("cap").over(upto))
        .withColumn("w_rest", F.coalesce(F.sum("w").over(beyond), F.lit(0)))
        # cap_sum + (cap / w) * w_rest <= total, in whole numbers
        .withColumn("capped", F.col("cap_sum") * F.col("w") + F.col("cap") * F.col("w_rest") <= F.col("total") * F.col("w"))
    )
    left = F.col("total") - F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(everything)
    weights = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("w"))).over(everything)
    return full.select(
        "source",
        "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(left.cast("double") * F.col("w") / weights)
        .alias("target"),
    )


def _keyed(docs: DataFrame, weights: DataFrame | None, columns: tuple[str, str, str], keep: tuple[str, ...], seed: str, ranges: int) -> DataFrame:
    """doc_id, source, size, sampling key and key range of every document, and ``keep`` by number.

    ``weights``: one row per ``_wid``.
    """
    id_col, text_col, source_col = columns
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        *(F.col(c).alias(f"_keep_{i}") for i, c in enumerate(keep)),
    )
    if weights is not None:
        sized = sized.join(weights, F.col("doc_id") == F.col("_wid"), "left").drop("_wid")
    else:
        sized = sized.withColumn("weight", F.lit(1.0))
    weight = F.when(F.col("weight") > 0, F.col("weight")).otherwise(F.lit(1.0))
    keyed = sized.withColumn("key", -F.log(_uniform(F.col("doc_id"), seed)) / weight).drop("weight")
    return keyed.withColumn("range", F.floor((1 - F.exp(-F.col("key"))) * ranges))


def cuts(keyed: DataFrame) -> DataFrame:
    """One row per source: its size, target, whole epochs, and the last place (range, key) that the draw takes.

    Sums over key ranges find the range in which the rest of the target ends;
    only the documents of that range are put in order.
    """
    sizes = keyed.groupBy("source", "range").agg(F.sum("size").alias("n"))
    goal = targets(sizes.groupBy("source").agg(F.sum("n").alias("source_size")))
    goal = goal.withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))

    ahead = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("before_range", F.coalesce(F.sum("n").over(ahead), F.lit(0)))
    starts = starts.join(goal.withColumnRenamed("source", "_gs"), F.col("source").eqNullSafe(F.col("_gs")))
    # the last range that begins within the rest
    border = starts.where(F.col("before_range") <= F.col("rest")).groupBy(F.col("source").alias("_s")).agg(
        F.max(F.struct("range", "before_range", "rest")).alias("b")
    ).select("_s", F.col("b.range").alias("_r"), "b.before_range", "b.rest")
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    last = (
        keyed.select("source", "range", "key", "doc_id", "size")
        .join(border, F.col("source").eqNullSafe(F.col("_s")) & (F.col("range") == F.col("_r")))
        .withColumn("before", F.col("before_range") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        # The document at the border is in if at least half of it fits: no bias either way.
        .where(2 * F.col("before") + F.col("size") <= 2 * F.col("rest"))
        .groupBy(F.col("source").alias("_l"))
        .agg(F.max(F.struct("key", "doc_id", "size")).alias("last"))
    )
    return (
        goal.join(border.select("_s", "_r"), F.col("source").eqNullSafe(F.col("_s")), "left")
        .join(last, F.col("source").eqNullSafe(F.col("_l")), "left")
        .select(F.col("source").alias("_source"), "source_size", "target", "epochs", F.col("_r").alias("last_range"), "last")
    )


def mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    keep: tuple[str, ...] = (),
    seed: str = SEED,
    ranges: int = RANGES,
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, copies, and ``keep``.

    ``copies`` is how often the mix holds the document, ``taken`` its words
    there. ``weights`` has doc_id and weight.
    """
    spark = docs.sparkSession
    shared_dir(spark)  # the checkpoints go there
    columns = (id_col, text_col, source_col)
    if weights is not None:
        weights = weights.groupBy(F.col("doc_id").alias("_wid")).agg(F.max("weight").alias("weight")).checkpoint()
        if weights.count() <= BROADCAST_WEIGHTS:  # then no text is exchanged
            weights = F.broadcast(weights)
    # ids and numbers only, kept so that the texts are read once for them
    keyed = _keyed(docs, weights, columns, (), seed, ranges).checkpoint()
    found = cuts(keyed).checkpoint()
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    rows = _keyed(docs, weights, columns, keep, seed, ranges) if keep else keyed
    placed = rows.join(found, F.col("source").eqNullSafe(F.col("_source")))
    drawn = (F.col("range") < F.col("last_range")) | (
        (F.col("range") == F.col("last_range")) & (F.struct("key", "doc_id", "size") <= F.col("last"))
    )
    copies = F.least(F.col("epochs") + F.when(drawn, 1).otherwise(0), F.lit(MOST_EPOCHS))
    return placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (copies * F.col("size")).cast("long").alias("taken"),
        copies.cast("long").alias("copies"),
        *(F.col(f"_keep_{i}").alias(c) for i, c in enumerate(keep)),
    )


SQL = r"""
WITH weights AS (
  SELECT doc_id, CASE WHEN max(quality) = 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS weight
  FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
keyed AS (
  SELECT d.doc_id, d.source,
         CAST(coalesce(len(regexp_extract_all(d.text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         -ln((CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT)::DOUBLE + 1.0)
             / 4503599627370496.0::DOUBLE) / coalesce(w.weight, 1.0::DOUBLE) AS key
  FROM documents d LEFT JOIN weights w ON d.doc_id = w.doc_id),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM keyed GROUP BY source),
capped AS (
  SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
         sum(3 * source_size) OVER f AS cap_sum,
         sum(w) OVER () - sum(w) OVER f AS w_rest
  FROM ranked
  WINDOW f AS (ORDER BY (3 * source_size)::DOUBLE / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
marked AS (SELECT *, cap_sum * w + cap * w_rest <= total * w AS full_up FROM capped),
goal AS (
  SELECT source, source_size,
         CASE WHEN full_up THEN cap::DOUBLE
              ELSE (total - sum(CASE WHEN full_up THEN cap ELSE 0 END) OVER ())::DOUBLE * w
                   / sum(CASE WHEN full_up THEN 0 ELSE w END) OVER () END AS target
  FROM marked),
rest AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM goal),
placed AS (
  SELECT k.*, r.source_size, r.target, r.epochs, r.target - r.epochs * r.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed k JOIN rest r ON k.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size, source_size, target, CAST(n * size AS BIGINT) AS taken, CAST(n AS BIGINT) AS copies
FROM (SELECT *, least(epochs + CASE WHEN 2 * before + size <= 2 * rest THEN 1 ELSE 0 END, 3) AS n FROM placed)
"""
