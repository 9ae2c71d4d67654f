"""Perspective rotation of dialogues with several speakers.

For every participant of a conversation, the dialogue is rendered with that speaker as ``assistant`` and all others as users with
their names; ``system`` turns stay what they are. The result has a row for each turn of each rendering: the text of the turn as
rendered, where it starts and ends in the whole rendering, and the part of it that is trained on, which is the words of the assistant.
Concatenating the rows of a rendering in order of their start gives the whole; it is left in pieces because a conversation may be of
any length.

A conversation is cut into spans of :data:`SPAN` turn numbers; places are running sums inside a span plus the sums of the spans
before, so a long conversation is spread over tasks.

Places are code points, end exclusive. Defined results: a null role is the speaker ``unknown``; a null text is empty; null and equal
turn numbers go by role, then text; a null turn is before all others; a conversation of system turns only has no participant and no
row; repeated rows are said twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mallflow.llm.frames import stored

SPAN = 256
SYSTEM, UNKNOWN = "system", "unknown"
_OPEN, _SHUT = "<|im_start|>", "<|im_end|>\n"


def _head() -> Column:
    """What stands before the words of a turn."""
    own, system = F.col("speaker") == F.col("participant"), F.col("speaker") == SYSTEM
    shown = F.when(system, F.lit(SYSTEM)).when(own, F.lit("assistant")).otherwise(F.concat(F.lit("user name="), F.col("speaker")))
    return F.concat(F.lit(_OPEN), shown, F.lit("\n"))


def rotate(turns: DataFrame, span: int = SPAN) -> DataFrame:
    """One row per conversation, participant and turn: ``segment``, its ``start`` and ``stop``, ``trained``, and the place of the
    trained words in ``mask_start`` and ``mask_stop`` (null unless trained)."""
    said = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(UNKNOWN)).alias("speaker"),
        F.coalesce("text", F.lit("")).alias("words"),
        F.coalesce(F.floor(F.col("turn") / span), F.lit(-1 << 40)).alias("part"),
    )
    who = stored(said.where(F.col("speaker") != SYSTEM).select("conv_id", F.col("speaker").alias("participant")).distinct(), "participants")
    person = who.select(F.col("conv_id").alias("_conv"), "participant")
    # One row for each speaker of a conversation, so the join makes no more rows than there are to render.
    rows = said.join(person, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    head = _head()
    rows = rows.withColumn("segment", F.concat(head, "words", F.lit(_SHUT))).withColumn("lead", F.length(head).cast("bigint"))
    rows = rows.withColumn("size", F.length("segment").cast("bigint"))
    key = ["conv_id", "participant"]
    parts = rows.groupBy(*key, "part").agg(F.sum("size").alias("size"))
    before = Window.partitionBy(*key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = parts.select(*[F.col(c).alias(f"_{c}") for c in (*key, "part")], F.coalesce(F.sum("size").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy(*key, "part").orderBy(F.col("turn").asc_nulls_first(), "speaker", "words")
    placed = rows.withColumn("within", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in (*key, "part")]
    placed = placed.join(ahead, same[0] & same[1] & same[2]).withColumn("start", F.col("ahead") + F.col("within"))
    own = F.col("speaker") == F.col("participant")
    return placed.select(
        *key,
        "turn",
        "speaker",
        "segment",
        "start",
        (F.col("start") + F.col("size")).alias("stop"),
        own.alias("trained"),
        F.when(own, F.col("start") + F.col("lead")).alias("mask_start"),
        F.when(own, F.col("start") + F.col("lead") + F.length("words")).alias("mask_stop"),
    )


ORACLE_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '{UNKNOWN}') AS speaker, coalesce(text, '') AS words FROM conversations),
who AS (SELECT DISTINCT conv_id, speaker AS participant FROM said WHERE speaker <> '{SYSTEM}'),
shown AS (
  SELECT s.*, w.participant,
         '{_OPEN}' || CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = participant THEN 'assistant'
                           ELSE 'user name=' || speaker END || chr(10) AS head
  FROM said s JOIN who w ON s.conv_id IS NOT DISTINCT FROM w.conv_id),
sized AS (SELECT *, head || words || '<|im_end|>' || chr(10) AS segment FROM shown),
placed AS (
  SELECT *, CAST(coalesce(sum(length(segment)) OVER (
              PARTITION BY conv_id, participant ORDER BY turn NULLS FIRST, speaker, words
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized)
SELECT conv_id, participant, turn, speaker, segment, start, start + length(segment) AS stop, speaker = participant AS trained,
       CASE WHEN speaker = participant THEN start + length(head) END AS mask_start,
       CASE WHEN speaker = participant THEN start + length(head) + length(words) END AS mask_stop
FROM placed
"""
