"""Chat formatting: multi-party perspective rotation.

Every participant of a conversation gets the dialogue rendered with that speaker
as the assistant and all others as named users; only the assistant's words are
trained on. The result has one row per conversation, perspective and turn (a
segment of the rendered dialogue), with code-point offsets into the whole
rendering, so a conversation of any length is never gathered in one row or task:
offsets are prefix sums in two levels, over blocks of turns and then inside a
block.

Defined results
  * role ``system`` is an instruction, not a participant: rendered as system in
    every perspective, never trained on;
  * null role: the participant ``unknown``; null text: empty content; null
    ``conv_id``: one conversation of its own (all such rows); null turn: after
    all others;
  * two turns with one number, repeated rows: all kept, ordered by role and text;
  * a conversation of system turns alone has no participant and gives no rows;
    an empty table gives none;
  * the markers ``<|im_start|>`` and ``<|im_end|>`` inside a text lose their bars
    (``<im_start>``), so no text can open or close a turn;
  * extra columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed values of the format.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Turn numbers per block of the prefix sums.
BLOCK = 256


def _safe(text: Column) -> Column:
    for marker in (OPEN, CLOSE):
        text = F.replace(text, F.lit(marker), F.lit(marker.replace("|", "")))
    return text


def rotate(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """One row per conversation, participant (``speaker``) and turn.

    ``seq`` counts the conversation's turns from 0. ``rendered`` is this turn's
    segment; segments joined by ``seq`` are the perspective's whole text, in
    which this one covers [start_char, end_char) and its content
    [content_start, content_end). ``train`` is true where the speaker talks: the
    mask covers the content and the closing marker, up to ``mask_end``.
    """
    # Keys without nulls, so that joins and windows hash on the same columns and
    # share one exchange: a null conversation and a null turn number (last) each
    # get a value of their own.
    base = turns.select(
        F.col(conv_col).isNull().alias("_no_conv"),
        F.coalesce(F.col(conv_col), F.lit(0).cast(turns.schema[conv_col].dataType)).alias("_conv"),
        F.col(turn_col).cast("long").alias("turn"),
        _safe(F.coalesce(F.col(role_col), F.lit("unknown"))).alias("name"),
        _safe(F.coalesce(F.col(text_col), F.lit(""))).alias("content"),
    ).withColumn("_block", F.coalesce(F.floor(F.col("turn") / block), F.lit(2**62)))

    # Participants are few and gathered as a set on the map side first. Both
    # sides hash on the conversation; a hot one is split by the skew join.
    conv = ["_no_conv", "_conv"]
    parties = base.where(F.col("name") != "system").groupBy(*conv).agg(F.sort_array(F.collect_set("name")).alias("parties"))
    views = base.join(parties, conv).select(*conv, F.explode("parties").alias("speaker"), "turn", "_block", "name", "content")
    role = (
        F.when(F.col("name") == "system", F.lit("system"))
        .when(F.col("name") == F.col("speaker"), F.lit("assistant"))
        .otherwise(F.lit("user"))
    )
    head = F.concat(
        F.lit(OPEN),
        F.col("role"),
        F.when(F.col("role") == "user", F.concat(F.lit(" name="), F.col("name"))).otherwise(F.lit("")),
        F.lit("\n"),
    )
    segments = (
        views.withColumn("role", role)
        .withColumn("head", head)
        .withColumn("rendered", F.concat("head", "content", F.lit(CLOSE + "\n")))
        .withColumn("size", F.length("rendered").cast("long"))
    )

    # Level one: rows and characters before each block. Level two: inside it.
    view = [*conv, "speaker"]
    before = Window.partitionBy(*view).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        segments.groupBy(*view, "_block")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("chars"))
        .select(
            *view,
            "_block",
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("chars_before"),
        )
    )
    order = (
        Window.partitionBy(*view, "_block")
        .orderBy(F.col("turn").asc_nulls_last(), "name", "content")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    placed = segments.join(blocks, [*view, "_block"]).select(
        "*",
        F.when(~F.col("_no_conv"), F.col("_conv")).alias("conv_id"),
        (F.col("rows_before") + F.count(F.lit(1)).over(order) - 1).alias("seq"),
        (F.col("chars_before") + F.sum("size").over(order) - F.col("size")).alias("start_char"),
    )
    content_start = F.col("start_char") + F.length("head")
    content_end = content_start + F.length("content")
    train = F.col("role") == "assistant"
    return placed.select(
        "conv_id",
        "speaker",
        "seq",
        "turn",
        "role",
        F.when(F.col("role") == "user", F.col("name")).alias("name"),
        "rendered",
        "start_char",
        (F.col("start_char") + F.col("size")).alias("end_char"),
        content_start.alias("content_start"),
        content_end.alias("content_end"),
        train.alias("train"),
        F.when(train, content_end + len(CLOSE)).alias("mask_end"),
    )


SQL = """
WITH base AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn,
         replace(replace(coalesce(role, 'unknown'), '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') AS who,
         replace(replace(coalesce(text, ''), '<|im_start|>', '<im_start>'), '<|im_end|>', '<im_end>') AS content
  FROM conversations),
parties AS (SELECT DISTINCT conv_id, who AS speaker FROM base WHERE who <> 'system'),
views AS (
  SELECT b.conv_id, p.speaker, b.turn, b.who, b.content,
         CASE WHEN b.who = 'system' THEN 'system' WHEN b.who = p.speaker THEN 'assistant' ELSE 'user' END AS role
  FROM base b JOIN parties p ON b.conv_id IS NOT DISTINCT FROM p.conv_id),
headed AS (
  SELECT *, '<|im_start|>' || role || CASE WHEN role = 'user' THEN ' name=' || who ELSE '' END || chr(10) AS head
  FROM views),
segments AS (
  SELECT *, head || content || '<|im_end|>' || chr(10) AS rendered FROM headed),
placed AS (
  SELECT *,
         row_number() OVER w - 1 AS seq,
         CAST(sum(length(rendered)) OVER w AS BIGINT) - length(rendered) AS start_char
  FROM segments
  WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS LAST, who, content ROWS UNBOUNDED PRECEDING))
SELECT conv_id, speaker, seq, turn, role, CASE WHEN role = 'user' THEN who END AS name, rendered, start_char,
       start_char + length(rendered) AS end_char,
       start_char + length(head) AS content_start,
       start_char + length(head) + length(content) AS content_end,
       role = 'assistant' AS train,
       CASE WHEN role = 'assistant' THEN start_char + length(head) + length(content) + 10 END AS mask_end
FROM placed
"""
