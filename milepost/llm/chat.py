"""Chat formatting: the same dialogue from the view of each of its speakers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Turn numbers per row; the rendering of a longer dialogue goes on in the next rows.
PART_TURNS = 64


def _plain(text: Column) -> Column:
    """A text cannot hold a marker: each opening of one gets a space."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def _name(role: Column) -> Column:
    return F.replace(_plain(F.coalesce(role, F.lit("unknown"))), F.lit("\n"), F.lit(" "))


def perspectives(
    turns: DataFrame, narrators: Sequence[str] = ("system",), part_turns: int = PART_TURNS
) -> DataFrame:
    """The rendering of each dialogue for each speaker, in parts: ``conv_id, speaker, part, starts, n_turns, text, mask``.

    Every role but the narrators is a speaker. In a speaker's rendering their turns are the
    assistant's, those of others a user's with the role as name, and narrators keep their role.
    ``mask`` holds the half-open spans (code points of the whole rendering) to train on: the
    assistant's texts with the end marker. Turns are ordered by number, role and text, nulls
    first. Fully repeated rows are one turn. A null text is empty, a null role is the speaker
    ``unknown``, a null ``conv_id`` is one dialogue, a null number comes before part 0 (part
    null). A dialogue without speakers gives no rows, nor does an empty table; other columns
    are ignored.

    A part holds the turns of ``part_turns`` consecutive numbers, so a task's group stays small
    however long the dialogue is. The parts of a dialogue in order are one rendering: ``starts`` is
    where a part begins in it, and spans are counted from its beginning, so whoever cuts windows
    has the system's turn, all context and every span of any length. :func:`whole_dialogues` joins them.
    """
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _name(F.col("role").cast("string")).alias("role"),
        _plain(F.col("text").cast("string")).alias("text"),
    ).distinct()
    speakers = (
        rows.where(~F.col("role").isin(*narrators))
        .select(F.col("conv_id").alias("of"), F.col("role").alias("speaker"))
        .distinct()
    )
    parts = rows.groupBy("conv_id", F.floor(F.col("turn") / part_turns).alias("part")).agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )

    def rendered(t: Column) -> Column:
        own = t.role == F.col("speaker")
        who = F.when(own, "assistant").when(t.role.isin(*narrators), t.role)
        head = F.concat(F.lit(START), F.coalesce(who, F.concat(F.lit("user name="), t.role)), F.lit("\n"))
        return F.struct(own.alias("own"), head.alias("head"), F.concat(t.text, F.lit(END)).alias("body"))

    def add(state: Column, r: Column) -> Column:
        start = state["at"] + F.length(r.head)
        end = start + F.length(r.body)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + 1).alias("at"), F.when(r.own, F.concat(state.spans, span)).otherwise(state.spans).alias("spans")
        )

    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    first = F.struct(F.col("starts").alias("at"), none.alias("spans"))
    mask = F.aggregate("rendered", first, add, lambda s: s.spans)
    cells = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).select(
        "conv_id", "speaker", "part", F.transform("turns", rendered).alias("rendered")
    )
    # A few numbers per part give the places of all, without their texts.
    length = F.aggregate(
        "rendered", F.lit(0).cast("long"), lambda n, r: n + F.length(r.head) + F.length(r.body) + 1
    )
    before = Window.partitionBy("in_conv", "in_speaker").orderBy("in_part").rowsBetween(Window.unboundedPreceding, -1)
    places = cells.select(
        F.col("conv_id").alias("in_conv"), F.col("speaker").alias("in_speaker"), F.col("part").alias("in_part"), length.alias("length")
    ).withColumn("starts", F.coalesce(F.sum("length").over(before), F.lit(0)))
    same = (
        F.col("conv_id").eqNullSafe(F.col("in_conv"))
        & (F.col("speaker") == F.col("in_speaker"))
        & F.col("part").eqNullSafe(F.col("in_part"))
    )
    return (
        cells.join(places, same)
        .select(
            "conv_id",
            "speaker",
            "part",
            "starts",
            F.size("rendered").cast("long").alias("n_turns"),
            F.array_join(F.transform("rendered", lambda r: F.concat(r.head, r.body, F.lit("\n"))), "").alias("text"),
            mask.alias("mask"),
        )
    )


def whole_dialogues(rendered: DataFrame) -> DataFrame:
    """One row per dialogue and speaker, of :func:`perspectives`: all turns, the whole text and all spans.

    For dialogues of a size that a row can hold; of longer ones read the parts in order.
    """
    parts = F.sort_array(F.collect_list(F.struct("starts", "n_turns", "text", "mask")))
    return rendered.groupBy("conv_id", "speaker").agg(parts.alias("parts")).select(
        "conv_id",
        "speaker",
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p.n_turns).alias("n_turns"),
        F.array_join(F.transform("parts", lambda p: p.text), "").alias("text"),
        F.flatten(F.transform("parts", lambda p: p["mask"])).alias("mask"),
    )


#: The spans as text, for comparison.
CHAT_SQL = """
WITH t AS (
  SELECT DISTINCT conv_id, turn,
         replace(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(10), ' ') AS role,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations
), v AS (
  SELECT t.*, s.speaker, t.role = s.speaker AS own, CAST(floor(turn / 64) AS BIGINT) AS part,
         '<|im_start|>' || CASE WHEN t.role = s.speaker THEN 'assistant' WHEN t.role = 'system' THEN 'system'
                           ELSE 'user name=' || t.role END || chr(10) AS head,
         t.text || '<|im_end|>' AS body
  FROM t JOIN (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system') s
       ON t.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body) + 1) OVER (
              PARTITION BY conv_id, speaker ORDER BY turn, role, text) - 1 AS ends
  FROM v
)
SELECT conv_id, speaker, part, (min(ends - length(head) - length(body)))::BIGINT AS starts, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY turn, role, text) AS text,
       string_agg(CASE WHEN own THEN (ends - length(body)) || '-' || ends END, ',' ORDER BY turn, role, text) AS mask
FROM placed GROUP BY conv_id, speaker, part
"""
