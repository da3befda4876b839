"""Multi-party perspective rotation of dialogues (chat formatting).

Every dialogue is rendered once for every participant: that speaker's turns
become ``assistant`` turns and count for the loss, the other speakers become
named users, and context speakers (``system``) keep their role.  One output row
is one rendered turn of one perspective; the segments of a perspective in the
order (turn, role, text) concatenate to its training text, and the mask spans
say which characters of a segment are trained on.

There is no grouping of a dialogue into one row or task: a dialogue that holds a
third of all turns is a skewed join side, which adaptive execution splits.

Defined results for odd input
  * null speaker: rendered as a user without a name, never a perspective
  * null text: an empty turn; null turn: kept, sorts first
  * null conversation id: the rows without an id form one conversation
  * an empty speaker name is an ordinary name (rendered without ``name=``)
  * repeated rows are repeated turns; a dialogue of context speakers only has no
    participants and gives no rows; further input columns are left out
  * control tokens inside a text or a name are broken up with a blank, so a turn
    cannot close itself or open another one
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def plain(text: Column) -> Column:
    """``text`` without control tokens."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|", "< |")


def participants(turns: DataFrame, conversation: str, speaker: str,
                 context: Sequence[str] = ("system",)) -> DataFrame:
    """(conversation, perspective): the distinct speakers that are rendered as assistant."""
    return (turns.where(F.col(speaker).isNotNull() & ~F.col(speaker).isin(list(context)))
            .select(F.col(conversation).alias("p_conversation"), F.col(speaker).alias("perspective"))
            .distinct())


def rotate(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role",
           text: str = "text", context: Sequence[str] = ("system",)) -> DataFrame:
    """All perspectives of all dialogues, one row per rendered turn.

    Columns: the conversation and turn columns, ``perspective``, ``speaker``,
    ``chat_role`` (assistant, user or system), ``name`` (of a user), ``segment``
    (the rendered turn), ``mask_start`` and ``mask_end`` (trained characters of the
    segment, end exclusive; null where nothing is trained) and ``trained``.
    """
    own = turns.select(F.col(conversation), F.col(turn), F.col(speaker).alias("speaker"),
                       plain(F.col(text)).alias("body"))
    who = participants(turns, conversation, speaker, context)
    both = own.join(who, F.col(conversation).eqNullSafe(F.col("p_conversation")), "inner")
    trained = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    chat_role = (F.when(trained, F.lit("assistant"))
                 .when(F.col("speaker").isin(list(context)), F.lit("system")).otherwise(F.lit("user")))
    named = F.when(F.col("chat_role") == "user", plain(F.col("speaker"))).otherwise(F.lit(""))
    header = F.concat(F.lit(OPEN), F.col("chat_role"),
                      F.when(F.col("name") != "", F.concat(F.lit(" name="), F.col("name")))
                      .otherwise(F.lit("")), F.lit("\n"))
    return (both.withColumn("trained", trained).withColumn("chat_role", chat_role)
            .withColumn("name", named).withColumn("header", header)
            .select(conversation, turn, "perspective", "speaker", "chat_role", "name",
                    F.concat("header", "body", F.lit(CLOSE + "\n")).alias("segment"),
                    F.when(F.col("trained"), F.length("header").cast("long")).alias("mask_start"),
                    F.when(F.col("trained"), (F.length("header") + F.length("body") + len(CLOSE))
                           .cast("long")).alias("mask_end"),
                    "trained"))


ROTATE_SQL = """
WITH own AS (
  SELECT conv_id, turn, role AS speaker, replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations),
who AS (
  SELECT DISTINCT conv_id, role AS perspective FROM conversations
  WHERE role IS NOT NULL AND role <> 'system'),
b AS (
  SELECT own.conv_id, turn, perspective, speaker, body,
         coalesce(speaker = perspective, false) AS trained,
         CASE WHEN speaker = perspective THEN 'assistant' WHEN speaker = 'system' THEN 'system'
              ELSE 'user' END AS chat_role
  FROM own JOIN who ON own.conv_id IS NOT DISTINCT FROM who.conv_id),
n AS (
  SELECT *, CASE WHEN chat_role = 'user' THEN replace(coalesce(speaker, ''), '<|', '< |') ELSE '' END AS name FROM b),
h AS (
  SELECT *, '<|im_start|>' || chat_role || CASE WHEN name <> '' THEN ' name=' || name ELSE '' END
            || chr(10) AS header FROM n)
SELECT conv_id, turn, perspective, speaker, chat_role, name,
       header || body || '<|im_end|>' || chr(10) AS segment,
       CASE WHEN trained THEN length(header) END AS mask_start,
       CASE WHEN trained THEN length(header) + length(body) + 10 END AS mask_end,
       trained
FROM h"""
