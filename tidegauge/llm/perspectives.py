"""Chat rendering from every participant's point of view.

Each conversation is rendered once per participant, with that speaker as the
assistant, the others as named users, and a mask over the assistant's words and
end marks. A dialogue comes in pages of ``PAGE`` consecutive turn numbers, so
that no row or task ever holds a conversation of unknown length; most dialogues
are one page. Pages in order of (page, part) make up the dialogue.

Only DataFrame functions: turns are grouped by page once, the pages are joined
with the conversation's distinct speakers, and rendered as array expressions.
A hot conversation is spread over its pages, and the join is one that adaptive
execution splits.

A text or name cannot speak for somebody else: ``<|`` in it becomes ``<||``, which is no
mark, and ``|>`` in a name ``||>``. Readers undo this by taking one ``|`` off. The column
``perspective`` holds the name as it is.

Edge cases: a null or empty role is the speaker ``unknown``; a null text is
empty. System turns stay system turns in every rendering and are nobody's
perspective; a conversation of system turns alone has no rendering. Rows without
a conversation id form one conversation; turns without a number come first, on a
page numbered null. Repeated turns are all kept, in the order of their speaker
and text, and a page of more than ``PAGE`` rows is cut into parts. An empty table
gives an empty result. Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = 64
# The marks of the rendering.
SYSTEM, ASSISTANT, END = "<|system|>\n", "<|assistant|>\n", "<|end|>"
NAMED_USER = ("<|user name=", "|>\n")


def without_marks(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def header(speaker: Column, perspective: Column) -> Column:
    name = F.replace(without_marks(speaker), F.lit("|>"), F.lit("||>"))
    named = F.concat(F.lit(NAMED_USER[0]), name, F.lit(NAMED_USER[1]))
    return F.when(speaker == perspective, ASSISTANT).when(speaker == "system", SYSTEM).otherwise(named)


def rendered(turn: Column, perspective: Column) -> Column:
    return F.concat(header(turn["speaker"], perspective), turn["body"], F.lit(END + "\n"))


def masked(turns: Column, perspective: Column) -> Column:
    """[start, end) character offsets of what the assistant says, within a page."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(F.lit(0).alias("at"), empty.alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        begin = state["at"] + F.length(header(turn["speaker"], perspective))
        end = begin + F.length(turn["body"]) + len(END)
        span = F.struct(begin.alias("start"), end.alias("end"))
        own = F.when(turn["speaker"] == perspective, F.concat(state["spans"], F.array(span)))
        return F.struct((end + 1).alias("at"), own.otherwise(state["spans"]).alias("spans"))

    return F.aggregate(turns, start, step, lambda state: state["spans"])


def render_perspectives(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """conversation, perspective, page, part, n_turns, text, mask (spans)."""
    slim = turns.select(
        F.col(conversation).alias("__conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.nullif(F.col(role), F.lit("")), F.lit("unknown")).alias("speaker"),
        without_marks(F.coalesce(F.col(text), F.lit(""))).alias("body"),
        F.floor(F.col(turn) / PAGE).alias("page"),
    )
    in_page = Window.partitionBy("__conv", "page").orderBy("turn", "speaker", "body")
    placed = slim.withColumn("part", F.floor((F.row_number().over(in_page) - 1) / PAGE))
    pages = placed.groupBy("__conv", "page", "part").agg(
        F.array_sort(F.collect_list(F.struct("turn", "speaker", "body"))).alias("turns")
    )
    speakers = (
        slim.filter("speaker <> 'system'").select(F.col("__conv").alias("__own"), F.col("speaker").alias("perspective"))
    ).distinct()
    rotated = pages.join(speakers, F.col("__conv").eqNullSafe(F.col("__own")))
    me = F.col("perspective")
    return rotated.select(
        F.col("__conv").alias(conversation),
        "perspective",
        "page",
        "part",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: rendered(t, me)), "").alias("text"),
        masked(F.col("turns"), me).alias("mask"),
    )


def sql_text(value: str) -> str:
    """A literal whose line breaks are spelled out."""
    return "'" + value.replace("\n", "' || chr(10) || '") + "'"


SQL = f"""
WITH slim AS (
  SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '<||') AS body,
         CAST(floor(turn / {PAGE}) AS BIGINT) AS page
  FROM conversations
),
placed AS (
  SELECT *, CAST(floor((row_number() OVER w - 1) / {PAGE}) AS BIGINT) AS part, row_number() OVER w AS place
  FROM slim WINDOW w AS (PARTITION BY conv_id, page ORDER BY turn NULLS FIRST, speaker, body)
),
speakers AS (
  SELECT DISTINCT conv_id AS own, speaker AS perspective FROM slim WHERE speaker <> 'system'
),
rotated AS (
  SELECT p.*, s.perspective,
         CASE WHEN speaker = perspective THEN {sql_text(ASSISTANT)} WHEN speaker = 'system' THEN {sql_text(SYSTEM)}
              ELSE '{NAMED_USER[0]}' || replace(replace(speaker, '<|', '<||'), '|>', '||>') || {sql_text(NAMED_USER[1])} END AS head
  FROM placed p JOIN speakers s ON p.conv_id IS NOT DISTINCT FROM s.own
),
measured AS (
  SELECT *, length(head) + length(body) + {len(END) + 1} AS wide,
         coalesce(sum(length(head) + length(body) + {len(END) + 1}) OVER (
           PARTITION BY conv_id, perspective, page, part ORDER BY place
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM rotated
)
SELECT conv_id, perspective, page, part, CAST(count(*) AS INTEGER) AS n_turns,
       string_agg(head || body || '{END}' || chr(10), '' ORDER BY place) AS text,
       coalesce(string_agg(CAST(CAST(ahead + length(head) AS BIGINT) AS VARCHAR) || '-' ||
                           CAST(CAST(ahead + wide - 1 AS BIGINT) AS VARCHAR), ',' ORDER BY place)
                FILTER (WHERE speaker = perspective), '') AS mask
FROM measured GROUP BY conv_id, perspective, page, part
"""
