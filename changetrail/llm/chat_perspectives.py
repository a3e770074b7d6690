"""Multi-party dialogues rendered once from each participant's perspective.

For every participant of a conversation the whole dialogue is rendered with that speaker as
the assistant and all others as users named by their role; the mask lists the spans of the
assistant's words and end marks, from which alone a model should learn.

A dialogue comes in parts of ``TURNS`` consecutive turn numbers, one row per part and
perspective, so that a conversation of any length is rendered whole, and without being in one task
if its turn numbers differ; short dialogues have one part. Turns with equal numbers are never parted,
nor are null ones, so a part has no bound where these are many: it must fit into one row. Turns with the same number follow each other by role and
text, repeated rows are rendered as often as they occur. A null turn number counts as -1, a null
role as the speaker ``unknown``, a null text as empty; turns without conv_id form one
conversation. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Turn numbers in one part.
TURNS = 64
# What opens and closes a message; in names and texts, the opening sign is broken up.
ASSISTANT = "<|assistant|>\n"
USER = "<|user name={}|>\n"
END = "<|end|>\n"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame) -> DataFrame:
    """``conv_id, perspective, part, n_turns, text, mask, n_masked`` for every part and speaker.

    ``mask`` is ``start:end`` in code points of the part, end exclusive, comma-joined.
    """
    turn = F.coalesce(F.col("turn").cast("long"), F.lit(-1))
    rows = turns.select(
        F.struct("conv_id").alias("conv"),
        F.floor(turn / TURNS).cast("long").alias("part"),
        turn.alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # which perspectives each part needs: narrow rows, joined before any text moves
    speakers = rows.select("conv", F.col("role").alias("perspective")).distinct()
    parts = rows.select("conv", "part").distinct()
    wanted = parts.join(speakers, "conv")
    dialogue = rows.groupBy("conv", "part").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    )
    user_open, user_close = USER.split("{}")
    own = lambda m: m["role"] == F.col("perspective")
    opening = lambda m: F.when(own(m), F.lit(ASSISTANT)).otherwise(
        F.concat(F.lit(user_open), _plain(F.replace(m["role"], F.lit("\n"), F.lit(" "))), F.lit(user_close))
    )
    messages = F.transform(
        "turns",
        lambda m: F.struct(
            own(m).alias("own"),
            F.char_length(opening(m)).alias("head"),
            F.concat(opening(m), _plain(m["text"]), F.lit(END)).alias("text"),
        ),
    )
    step = lambda acc, m: F.struct(
        (acc["at"] + F.char_length(m["text"])).cast("long").alias("at"),
        F.when(
            m["own"],
            F.concat(
                acc["spans"],
                F.array(
                    F.concat(
                        (acc["at"] + m["head"]).cast("string"),
                        F.lit(":"),
                        (acc["at"] + F.char_length(m["text"])).cast("string"),
                    )
                ),
            ),
        )
        .otherwise(acc["spans"])
        .alias("spans"),
        (acc["masked"] + F.when(m["own"], F.char_length(m["text"]) - m["head"]).otherwise(0))
        .cast("long")
        .alias("masked"),
    )
    start = F.struct(
        F.lit(0).cast("long").alias("at"),
        F.array().cast("array<string>").alias("spans"),
        F.lit(0).cast("long").alias("masked"),
    )
    return (
        dialogue.join(wanted, ["conv", "part"])
        .withColumn("messages", messages)
        .withColumn("sums", F.aggregate("messages", start, step))
        .select(
            F.col("conv.conv_id").alias("conv_id"),
            "perspective",
            "part",
            F.size("turns").cast("long").alias("n_turns"),
            F.array_join(F.transform("messages", lambda m: m["text"]), "").alias("text"),
            F.array_join("sums.spans", ",").alias("mask"),
            F.col("sums.masked").alias("n_masked"),
        )
    )


ORACLE = """
WITH rows AS (
  SELECT conv_id, CAST(floor(coalesce(turn, -1) / 64.0) AS BIGINT) AS part, coalesce(turn, -1) AS turn,
         coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
  FROM conversations
), speakers AS (SELECT DISTINCT conv_id, role AS perspective FROM rows),
messages AS (
  SELECT r.conv_id, s.perspective, r.part, r.turn, r.role, r.text, r.role = s.perspective AS own,
         CASE WHEN r.role = s.perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || replace(replace(r.role, chr(10), ' '), '<|', '< |') || '|>' || chr(10) END AS head,
         replace(r.text, '<|', '< |') || '<|end|>' || chr(10) AS body
  FROM rows r JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id
), placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (
           PARTITION BY conv_id, perspective, part ORDER BY turn, role, text
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop
  FROM messages
)
SELECT conv_id, perspective, part, count(*) AS n_turns,
       string_agg(head || body, '' ORDER BY turn, role, text, stop) AS text,
       coalesce(string_agg(CAST(stop - length(body) AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ','
                           ORDER BY turn, role, text, stop) FILTER (WHERE own), '') AS mask,
       CAST(coalesce(sum(length(body)) FILTER (WHERE own), 0) AS BIGINT) AS n_masked
FROM placed GROUP BY conv_id, perspective, part
"""
